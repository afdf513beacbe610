"""One-row results as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_value(df: DataFrame, column: str) -> Column:
    """Column of a one-row frame as a scalar subquery: no join, no collect."""
    return df.select(column).scalar()


def one_row(df: DataFrame) -> Column:
    """All columns of a one-row frame as one struct-valued scalar subquery."""
    return df.select(F.struct(*df.columns).alias("row")).scalar()


def share_of_total(counts: DataFrame, column: str) -> Column:
    """``column / sum(column)`` over a small grouped result."""
    return F.col(column) / one_value(counts.agg(F.sum(column).alias("total")), "total")
