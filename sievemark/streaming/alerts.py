"""Alert rules over window metrics: levels, thresholds, pending/firing, routing, triggers.

Everything here works on an evaluation grid (one row per rule and grid point), whose
size is the observed time span over the step and does not grow with the event rate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .metrics import LONG_WINDOW, MEDIUM_WINDOW, SHORT_WINDOW, seconds, window_mean, windowed

# Default alert rules, as (threshold, required duration, severity).
DEFAULT_RULES = {
    "api_down": (None, "1 minute", "critical"),
    "high_latency_p95": (0.5, "5 minutes", "warning"),
    "high_latency_mean": (0.2, "5 minutes", "warning"),
    "low_mean_confidence": (0.5, "10 minutes", "warning"),
    "no_recent_predictions": (None, "10 minutes", "warning"),
}
# Level bounds as (direction, warning, critical).
DEFAULT_LEVELS = {
    "confidence": ("lower_is_worse", 0.7, 0.5),
    "latency_p95_seconds": ("higher_is_worse", 0.2, 0.5),
    "error_rate": ("higher_is_worse", 0.05, 0.10),
}
# Notification timing and retraining bounds.
DEGRADED_CONFIDENCE = 0.60
COOLDOWN = "12 hours"

RULE_SCHEMA = "alert string, threshold double, for_seconds bigint, severity string"
LEVEL_SCHEMA = "metric string, direction string, warning double, critical double"


def default_rules(spark: SparkSession) -> DataFrame:
    rows = [(name, t, seconds(hold), sev) for name, (t, hold, sev) in DEFAULT_RULES.items()]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def default_levels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(m, *bounds) for m, bounds in DEFAULT_LEVELS.items()], LEVEL_SCHEMA)


def merged(defaults: DataFrame, overrides: DataFrame, key: str) -> DataFrame:
    """Partial overrides on top of defaults; keys the defaults do not know are ignored."""
    fields = [c for c in defaults.columns if c != key]
    present = [c for c in overrides.columns if c in fields]
    renamed = overrides.select(key, *[F.col(c).alias(f"_{c}") for c in present])
    # one row per rule on both sides
    return defaults.join(F.broadcast(renamed), key, "left").select(
        key, *[F.coalesce(f"_{c}", c).alias(c) if c in present else F.col(c) for c in fields]
    )


def level(value: Column, direction: Column, warning: Column, critical: Column) -> Column:
    """unknown / critical / warning / ok; bounds are inclusive, direction-aware."""
    def beyond(bound: Column) -> Column:
        return F.coalesce(F.when(direction == "lower_is_worse", value <= bound).otherwise(value >= bound), F.lit(False))

    known = F.nullif(value, F.lit(float("nan"))).isNotNull() & direction.isNotNull()
    return (
        F.when(~known, "unknown").when(beyond(critical), "critical").when(beyond(warning), "warning").otherwise("ok")
    )


def metric_levels(metrics: DataFrame, levels: DataFrame) -> DataFrame:
    """Adds ``level`` to (metric, value, …) rows; a metric without bounds is unknown."""
    # one row per metric name
    joined = metrics.join(F.broadcast(levels), "metric", "left")
    return joined.withColumn(
        "level", level(F.col("value"), F.col("direction"), F.col("warning"), F.col("critical"))
    ).drop("direction", "warning", "critical")


def above(points: DataFrame, column: str, threshold: float) -> DataFrame:
    """Adds ``active``: strictly above the threshold; no data is not active."""
    return points.withColumn("active", F.coalesce(F.col(column) > threshold, F.lit(False)))


def below(points: DataFrame, column: str, threshold: float) -> DataFrame:
    """Adds ``active``: strictly below the threshold; no data is not active."""
    return points.withColumn("active", F.coalesce(F.col(column) < threshold, F.lit(False)))


def grid(events: DataFrame, step: str = "1 minute", ts: str = "ts") -> DataFrame:
    """Evaluation times from the first to the last event, one row per step.

    Days are laid out first and each day is cut into steps by its own task.
    """
    size = seconds(step)
    span = events.agg(
        F.floor(F.unix_timestamp(F.min(ts)) / size).alias("lo"), F.floor(F.unix_timestamp(F.max(ts)) / size).alias("hi")
    ).filter("lo IS NOT NULL")
    per_day = max(1, 86400 // size)
    blocks = span.select(
        "lo", "hi", F.explode(F.sequence(F.expr(f"lo div {per_day}"), F.expr(f"hi div {per_day}"))).alias("block")
    ).repartition("block")
    points = F.sequence(
        F.greatest(F.col("lo"), F.col("block") * per_day), F.least(F.col("hi"), F.col("block") * per_day + per_day - 1)
    )
    return blocks.select(F.explode(points).alias("i")).select(F.timestamp_seconds(F.col("i") * size).alias("at"))


def absent(events: DataFrame, duration: str = SHORT_WINDOW, step: str = "1 minute", ts: str = "ts") -> DataFrame:
    """Grid times ``at`` with no event in the ``duration`` bins up to and including ``at``."""
    seen = windowed(events, {"n": F.lit(1)}, [], duration, step, ts)
    last_bin = F.col("end") - F.make_dt_interval(secs=F.lit(seconds(step)))
    return grid(events, step, ts).join(seen.select(last_bin.alias("at")), "at", "left_anti")


def stalled(
    events: DataFrame, request: Column, prediction: Column, length: str = MEDIUM_WINDOW, step: str = "1 minute", ts: str = "ts"
) -> DataFrame:
    """Windows with requests; ``active`` when they hold no prediction."""
    sums = windowed(
        events, {"requests": F.when(request, 1).otherwise(0), "predictions": F.when(prediction, 1).otherwise(0)},
        [], length, step, ts,
    )
    return sums.withColumn("active", (F.col("requests") > 0) & (F.col("predictions") == 0))


def held(points: DataFrame, hold_seconds: int, step_seconds: int, by: list[str] = [], at: str = "at") -> DataFrame:
    """Pending → firing: adds ``since`` and ``state`` to the grid points where ``active`` holds.

    Any false or missing point resets. Consecutive true points share the difference of
    grid number and row number, which names the run.
    """
    true_points = points.filter("active")
    number = F.floor(F.unix_timestamp(at) / step_seconds)
    order = Window.partitionBy(*by).orderBy(at)
    runs = true_points.withColumn("_run", number - F.row_number().over(order))
    runs = runs.withColumn("since", F.min(at).over(Window.partitionBy(*by, "_run"))).drop("_run")
    elapsed = F.unix_timestamp(at) - F.unix_timestamp("since")
    return runs.withColumn("state", F.when(elapsed >= hold_seconds, "firing").otherwise("pending"))


def inhibit(alerts: DataFrame, name: str = "alert", at: str = "at") -> DataFrame:
    """Drop warnings while a critical alert of the same name is active at the same time."""
    warning, critical = F.col("severity") == "warning", F.col("severity") == "critical"
    kept = alerts.filter(warning).join(alerts.filter(critical).select(name, at).distinct(), [name, at], "left_anti")
    return kept.select(*alerts.columns).unionByName(alerts.filter(~warning))


def watchdog(
    log: DataFrame, threshold: float = DEGRADED_CONFIDENCE, length: str = LONG_WINDOW, step: str = "1 hour",
    column: str = "confidence", ts: str = "ts", by: list[str] = [],
) -> DataFrame:
    """Hourly check: ``degraded`` when the window mean is at or below the threshold.

    A window without values is not degraded.
    """
    means = window_mean(log, column, length, step, ts, by)
    return means.withColumn("degraded", F.coalesce(F.col("mean") <= threshold, F.lit(False)))


#: Cooldowns to a time block of ``cooled_triggers``.
BLOCK_COOLDOWNS = 64


def block_exits(times: np.ndarray, hold: int) -> np.ndarray:
    """For each of the sorted times of a block: when the next trigger may follow if one falls there.

    Only times of later cooldown slots are pointed to, so slots are filled from the last one.
    """
    following = np.searchsorted(times, times + hold)
    out = times + hold
    slots = times // hold
    starts = np.r_[np.flatnonzero(np.r_[True, slots[1:] != slots[:-1]]), len(times)]
    for a, z in zip(starts[-2::-1], starts[:0:-1], strict=True):
        inside = following[a:z] < len(times)
        out[a:z][inside] = out[following[a:z][inside]]
    return out


def cooled_triggers(candidates: DataFrame, by: list[str], at: str = "at", cooldown: str = COOLDOWN) -> DataFrame:
    """Candidates that trigger: the last trigger is at least ``cooldown`` ago. Whole seconds; NULL is a key.

    Time is cut into blocks of 64 cooldowns, and a block of a key is a group of its own, bounded
    by its seconds. A block is first reduced to a function: for every candidate that could be
    its first trigger (those of its first cooldown, and the first after it), when the block
    lets the next trigger follow. The functions of a key are applied in time order, and each
    block is then walked from its true first trigger. A key without gaps so spreads over tasks.
    """
    hold = seconds(cooldown)
    span = hold * BLOCK_COOLDOWNS
    kinds = {f.name: f.dataType.simpleString() for f in candidates.schema.fields if f.name in by}
    keys = [f"_k{i}" for i in range(len(by))]
    timed = candidates.filter(F.col(at).isNotNull()).select(
        *[F.col(c).cast("string").alias(k) for c, k in zip(by, keys, strict=True)], F.unix_timestamp(at).alias("_s")
    ).distinct().withColumn("_block", F.floor(F.col("_s") / span))
    schema = ", ".join([*[f"{k} string" for k in keys], "_block bigint"])

    def reduce(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        times = np.sort(rows["_s"].to_numpy())
        exits = block_exits(times, hold)
        entries = np.searchsorted(times, int(key[-1]) * span + hold) + 1
        return pd.DataFrame({**dict(zip([*keys, "_block"], key, strict=True)), "_entry": times[:entries], "_exit": exits[:entries]})

    def chain(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, free, last = None, None, None
        for frame in frames:
            rows = []
            for *key, block, entry, leave in frame.itertuples(index=False):
                if current != key:
                    current, free, last = key, None, None
                if block != last and (free is None or entry >= free):
                    rows.append((*key, block, entry))
                    free, last = leave, block
            if rows:
                yield pd.DataFrame(rows, columns=[*keys, "_block", "_entry"])

    def walk(key: tuple, rows: pd.DataFrame, first: pd.DataFrame) -> pd.DataFrame:
        times, kept = np.sort(rows["_s"].to_numpy()), []
        i = int(np.searchsorted(times, first["_entry"].iloc[0])) if len(first) else len(times)
        while i < len(times):
            kept.append(times[i])
            i = int(np.searchsorted(times, times[i] + hold))
        return pd.DataFrame({**dict(zip([*keys, "_block"], key, strict=True)), "_s": np.array(kept, np.int64)})

    grouped = timed.groupBy(*keys, "_block")
    functions = grouped.applyInPandas(reduce, f"{schema}, _entry bigint, _exit bigint")
    ordered = functions.repartition(*keys) if keys else functions.coalesce(1)
    first = ordered.sortWithinPartitions(*keys, "_block", "_entry").mapInPandas(chain, f"{schema}, _entry bigint")
    walked = grouped.cogroup(first.groupBy(*keys, "_block")).applyInPandas(walk, f"{schema}, _s bigint")
    return walked.select(*[F.col(k).cast(kinds[c]).alias(c) for c, k in zip(by, keys, strict=True)], F.timestamp_seconds("_s").alias(at))
