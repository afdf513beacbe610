"""Prediction log: recent rows, distributions, counters and label filters."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import LOCAL_ZONE


def since(log: DataFrame, start: datetime | str | None, ts: str = "ts") -> DataFrame:
    """Rows at or after ``start``; everything when it is None. The literal is pushed to the scan."""
    return log if start is None else log.filter(F.col(ts) >= F.lit(start).cast("timestamp"))


def recent(log: DataFrame, now: datetime | str, hours: int = 24, limit: int | None = 1000, ts: str = "ts") -> DataFrame:
    """Last ``hours`` before ``now``, newest first. ``now`` is explicit, so a run can be repeated."""
    start = F.lit(now).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))
    rows = log.filter(F.col(ts) >= start).orderBy(F.desc(ts), "id")
    return rows if limit is None else rows.limit(limit)


def class_distribution(log: DataFrame, start: datetime | str | None = None) -> DataFrame:
    """Rows per predicted class since a time, largest first."""
    return (
        since(log, start).groupBy("predicted_class").agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "predicted_class")
    )


def total(log: DataFrame) -> DataFrame:
    return log.agg(F.count(F.lit(1)).alias("count"))


def label_filter(rows: DataFrame, column: str, include: str | None = None, exclude: str | None = None, anchored: bool = True) -> DataFrame:
    """Keep labels that match ``include`` and do not match ``exclude``.

    Anchored patterns must match the whole label, others any part of it. A pattern
    that does not compile is an error when the plan is built.
    """
    def pattern(text: str) -> str:
        re.compile(text)
        return f"^(?:{text})$" if anchored else text

    if include:
        rows = rows.filter(F.col(column).rlike(pattern(include)))
    if exclude:
        rows = rows.filter(~F.col(column).rlike(pattern(exclude)))
    return rows


def valid_rows(log: DataFrame) -> DataFrame:
    """Rows the log accepts: nothing missing, confidence in [0, 1]."""
    needed = [c for c in ("id", "ts", "predicted_class", "confidence", "latency_ms") if c in log.columns]
    return log.dropna("any", subset=needed).filter(F.col("confidence").between(0.0, 1.0))


def top_series(log: DataFrame, label: str, k: int, value: Column | None = None) -> DataFrame:
    """The ``k`` labels with the largest total (row count unless a value is given)."""
    amount = F.count(F.lit(1)) if value is None else F.sum(value)
    return log.groupBy(label).agg(amount.alias("total")).orderBy(F.desc("total"), label).limit(k)


def hourly_trend(log: DataFrame, k: int = 5, zone: str = LOCAL_ZONE) -> DataFrame:
    """Rows per local hour and class for the ``k`` most frequent classes overall.

    Counted per (hour, class) first, so the top-k filter joins counts and not rows.
    """
    hour = F.date_trunc("hour", F.from_utc_timestamp("ts", zone))
    hourly = log.groupBy(hour.alias("hour"), "predicted_class").agg(F.count(F.lit(1)).alias("count"))
    top = (
        hourly.groupBy("predicted_class").agg(F.sum("count").alias("_total"))
        .orderBy(F.desc("_total"), "predicted_class").limit(k).select("predicted_class")
    )
    # k rows by construction
    return hourly.join(F.broadcast(top), "predicted_class", "left_semi").select("hour", "predicted_class", "count")


def series_count(log: DataFrame, label: str = "predicted_class") -> DataFrame:
    return log.agg(F.countDistinct(label).alias("series"))


def up_summary(sources: DataFrame, up: Column) -> DataFrame:
    """Sources up, total, and ok / warning (one missing) / error."""
    counts = sources.agg(F.count_if(up).alias("up"), F.count(F.lit(1)).alias("total"))
    status = (
        F.when(F.col("up") == F.col("total"), "ok").when(F.col("up") >= F.col("total") - 1, "warning").otherwise("error")
    )
    return counts.withColumn("status", status)


def ratio_mean(log: DataFrame, column: str) -> DataFrame:
    """All-time mean as sum / count, the count clamped to 1."""
    total_sum = F.coalesce(F.sum(column), F.lit(0.0))
    return log.agg((total_sum / F.greatest(F.count(column), F.lit(1))).alias("mean"))


# Fixed cost, cost per prediction and the size of one equivalent.
FIXED_COST, UNIT_COST, EQUIVALENT = 58.0, 0.000005, 50.0


def footprint(log: DataFrame) -> DataFrame:
    """(58 + n · 0.000005) / 50."""
    n = F.count(F.lit(1))
    return log.agg(n.alias("predictions"), ((F.lit(FIXED_COST) + n * UNIT_COST) / EQUIVALENT).alias("equivalents"))


def error_ratio(log: DataFrame, error: Column) -> DataFrame:
    """Errors over requests; no errors count as 0, the denominator is at least 0.001.

    Both sides come from one pass, so neither can be an empty series.
    """
    errors = F.count_if(F.coalesce(error, F.lit(False))).cast("double")
    requests = F.greatest(F.count(F.lit(1)).cast("double"), F.lit(0.001))
    return log.agg((errors / requests).alias("error_ratio"))


def where_active(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left windows that also occur on the right."""
    return left.join(right.select(key).distinct(), key, "left_semi")


def alert_order(alerts: DataFrame) -> DataFrame:
    """Active alerts, firing before pending, then by name."""
    active = alerts.filter(F.col("state").isin("firing", "pending"))
    return active.orderBy(F.col("state") != "firing", "alert")


def store_new(uploads: DataFrame, stored: DataFrame | None, content: Column) -> DataFrame:
    """Each content once, keyed by SHA-256, without what is already stored.

    Copies collapse in a map-side aggregation before the shuffle. Digests that are
    not 64 hex characters are rejected.
    """
    hashed = uploads.withColumn("hash", F.sha2(content, 256)).filter(F.col("hash").rlike("^[0-9a-f]{64}$"))
    unique = hashed.groupBy("hash").agg(F.count(F.lit(1)).alias("uploads"))
    return unique if stored is None else unique.join(stored.select("hash"), "hash", "left_anti")


def top_labels_allowed(labels: Column, allowed: list[str], k: int = 3) -> Column:
    """True when one of the first ``k`` labels is in the allowed set."""
    return F.arrays_overlap(F.slice(labels, 1, k), F.array(*[F.lit(a) for a in allowed]))


