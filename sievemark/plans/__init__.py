"""Query catalogue: every operator bound to the given tables, with its SQL."""

from . import alerting, curation, evaluation, logs, selection, scalars, storage, vectors  # noqa: F401
