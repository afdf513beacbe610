"""Data curation, evaluation, drift and alerting operators for PySpark."""
