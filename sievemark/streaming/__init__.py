"""Time-window metrics, alert rules and stateful stream operators."""
