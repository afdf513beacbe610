"""Time-window metrics. The same functions serve batch tables and streams.

On a batch table, events are first reduced to bins of one slide and the bins are
spread over the windows that contain them: every event is shuffled at most once, as
part of a count. On a stream the window is applied to the events themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Latency bucket bounds (seconds), window lengths, watermark.
LATENCY_BOUNDS = [0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5]
SHORT_WINDOW, MEDIUM_WINDOW, LONG_WINDOW = "5 minutes", "10 minutes", "6 hours"
WATERMARK = "10 minutes"

UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(duration: str) -> int:
    """``"5 minutes"`` → 300."""
    number, unit = duration.split()
    return int(number) * UNIT_SECONDS[unit.rstrip("s")]


def windowed(
    events: DataFrame,
    sums: dict[str, Column],
    by: list[str] = [],
    length: str = SHORT_WINDOW,
    slide: str | None = None,
    ts: str = "ts",
    watermark: str = WATERMARK,
) -> DataFrame:
    """Sums per sliding window and label: columns ``start``, ``end``, ``by…``, ``sums…``.

    Windows without any event do not appear.
    """
    step = slide or length
    totals = [F.sum(expr).alias(name) for name, expr in sums.items()]
    if events.isStreaming:
        marked = events.withWatermark(ts, watermark)
        grouped = marked.groupBy(F.window(ts, length, step), *by).agg(*totals)
        return grouped.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, *sums)
    bins = events.groupBy(F.window(ts, step).alias("_bin"), *by).agg(*totals)
    count = seconds(length) // seconds(step)
    if count * seconds(step) != seconds(length):
        raise ValueError(f"{length} is not a multiple of {step}")
    first = F.col("_bin.start") - F.make_dt_interval(secs=F.lit(seconds(length) - seconds(step)))
    starts = F.sequence(first, F.col("_bin.start"), F.make_dt_interval(secs=F.lit(seconds(step))))
    spread = bins.select(F.explode(starts).alias("start"), *by, *sums) if count > 1 else bins.select(
        F.col("_bin.start").alias("start"), *by, *sums
    )
    grouped = spread.groupBy("start", *by).agg(*[F.sum(n).alias(n) for n in sums]) if count > 1 else spread
    end = F.col("start") + F.make_dt_interval(secs=F.lit(seconds(length)))
    return grouped.select("start", end.alias("end"), *by, *sums)



def rate(events: DataFrame, by: list[str], length: str = SHORT_WINDOW, slide: str = "1 minute", ts: str = "ts") -> DataFrame:
    """Events per second over a sliding window, per label."""
    counted = windowed(events, {"n": F.lit(1)}, by, length, slide, ts)
    return counted.withColumn("rate", F.col("n") / float(seconds(length)))


def request_rate(events: DataFrame, length: str = SHORT_WINDOW, slide: str = "1 minute", ts: str = "ts") -> DataFrame:
    """Total events per second over a sliding window."""
    return rate(events, [], length, slide, ts)


def counter_increase(samples: DataFrame, series: list[str], value: str = "value", ts: str = "ts") -> DataFrame:
    """Adds ``increase`` to counter samples: the step from the previous sample of the series;
    after a reset (the value falls) the new value itself. The first sample has none; of
    samples with equal times the smaller value comes first.

    A series is split by day; the last sample of the day before is carried over.
    """
    daily = samples.withColumn("_day", F.to_date(ts))
    keys = [*series, "_day"]
    last = daily.groupBy(*keys).agg(F.max(F.struct(ts, value)).alias("_last")).withColumn(
        "_carried", F.lag(F.col("_last")[value]).over(Window.partitionBy(*series).orderBy("_day"))
    ).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_carried")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = F.lag(value).over(Window.partitionBy(*keys).orderBy(ts, value))
    joined = daily.withColumn("_inside", inside).join(last, same).withColumn("_previous", F.coalesce("_inside", "_carried"))
    previous = F.col("_previous")
    step = F.when(F.col(value) < previous, F.col(value)).otherwise(F.col(value) - previous)
    return joined.withColumn("increase", F.coalesce(step, F.lit(0.0))).select(*samples.columns, "increase")


def counter_rate(
    samples: DataFrame, series: list[str], by: list[str], length: str = SHORT_WINDOW, slide: str = "1 minute",
    value: str = "value", ts: str = "ts",
) -> DataFrame:
    """Per-second rate of reset-aware counters, without extrapolation at the window borders."""
    steps = counter_increase(samples, series, value, ts)
    summed = windowed(steps, {"increase": F.col("increase")}, by, length, slide, ts)
    return summed.withColumn("rate", F.col("increase") / float(seconds(length)))


def bucket_sums(latency_seconds: Column, bounds: list[float] = LATENCY_BOUNDS) -> dict[str, Column]:
    """Cumulative bucket indicators ``le_0 … le_k`` and ``le_inf`` for :func:`windowed`."""
    cells = {f"le_{i}": F.when(latency_seconds <= b, 1).otherwise(0) for i, b in enumerate(bounds)}
    return {**cells, "le_inf": F.when(latency_seconds.isNotNull(), 1).otherwise(0)}


def latency_buckets(events: DataFrame, latency_seconds: Column, length: str, slide: str | None = None, ts: str = "ts", by: list[str] = []) -> DataFrame:
    """Cumulative latency counts per window, one column per bound."""
    return windowed(events, bucket_sums(latency_seconds), by, length, slide, ts)


def buckets_long(buckets: DataFrame, keys: list[str], bounds: list[float] = LATENCY_BOUNDS) -> DataFrame:
    """(keys, le, count) with ``+Inf`` as the last bound."""
    cells = [F.struct(F.lit(f"{b:g}").alias("le"), F.col(f"le_{i}").alias("count")) for i, b in enumerate(bounds)]
    cells.append(F.struct(F.lit("+Inf").alias("le"), F.col("le_inf").alias("count")))
    return buckets.select(*keys, F.explode(F.array(*cells)).alias("_c")).select(*keys, "_c.le", "_c.count")


def bucket_quantile(q: float, bounds: list[float] = LATENCY_BOUNDS) -> Column:
    """Quantile from cumulative bucket columns by linear interpolation inside the bucket.

    NULL without observations; a quantile in the open last bucket gives the last bound.
    """
    rank = F.lit(q) * F.col("le_inf")
    result = None
    for i, bound in enumerate(bounds):
        low = bounds[i - 1] if i else 0.0
        below = F.col(f"le_{i - 1}") if i else F.lit(0)
        inside = F.lit(low) + (bound - low) * (rank - below) / F.nullif(F.col(f"le_{i}") - below, F.lit(0))
        hit = F.col(f"le_{i}") >= rank
        result = F.when(hit, F.coalesce(inside, F.lit(low))) if result is None else result.when(hit, F.coalesce(inside, F.lit(low)))
    return F.when(F.col("le_inf") > 0, result.otherwise(F.lit(bounds[-1])))


def latency_quantiles(
    events: DataFrame, latency_seconds: Column, length: str = SHORT_WINDOW, slide: str = "1 minute", ts: str = "ts"
) -> DataFrame:
    """p50, p95, p99 per window."""
    buckets = latency_buckets(events, latency_seconds, length, slide, ts)
    return buckets.select(
        "start", "end", *[bucket_quantile(q).alias(n) for n, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))]
    )


def window_mean(
    events: DataFrame, column: str, length: str = SHORT_WINDOW, slide: str = "1 minute", ts: str = "ts", by: list[str] = []
) -> DataFrame:
    """Mean of a column per window as Δsum / Δcount; NULL without values."""
    present = F.when(F.col(column).isNotNull(), 1).otherwise(0)
    sums = windowed(events, {"total": F.col(column), "n": present}, by, length, slide, ts)
    return sums.select("start", "end", *by, "n", (F.col("total") / F.nullif(F.col("n"), F.lit(0))).alias("mean"))


def error_rate(
    events: DataFrame, error: Column, length: str = SHORT_WINDOW, slide: str = "1 minute", ts: str = "ts"
) -> DataFrame:
    """Errors over requests per window; the request rate is at least 0.001 per second."""
    flag = F.when(F.coalesce(error, F.lit(False)), 1).otherwise(0)
    sums = windowed(events, {"errors": flag, "requests": F.lit(1)}, [], length, slide, ts)
    span = float(seconds(length))
    ratio = (F.col("errors") / span) / F.greatest(F.col("requests") / span, F.lit(0.001))
    return sums.withColumn("error_rate", ratio)


def live_metrics(
    log: DataFrame, now: str, error: Column, latency_seconds: Column, length: str = SHORT_WINDOW, ts: str = "ts"
) -> DataFrame:
    """One row at ``now``: rps, p50, p95, p99, error rate, all-time total and mean confidence."""
    span = float(seconds(length))
    end = F.lit(now).cast("timestamp")
    inside = (F.col(ts) > end - F.make_dt_interval(secs=F.lit(seconds(length)))) & (F.col(ts) <= end)
    bad = F.coalesce(error, F.lit(False))
    cells = {n: F.sum(F.when(inside, c).otherwise(0)).alias(n) for n, c in bucket_sums(latency_seconds).items()}
    base = log.filter(F.col(ts) <= end).agg(
        *cells.values(),
        F.count_if(inside).alias("requests"),
        F.count_if(inside & bad).alias("errors"),
        F.count(F.lit(1)).alias("total_predictions"),
        (F.coalesce(F.sum("confidence"), F.lit(0.0)) / F.greatest(F.count("confidence"), F.lit(1))).alias("confidence_avg"),
    )
    return base.select(
        (F.col("requests") / span).alias("rps"),
        *[bucket_quantile(q).alias(n) for n, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))],
        ((F.col("errors") / span) / F.greatest(F.col("requests") / span, F.lit(0.001))).alias("error_rate"),
        "total_predictions",
        "confidence_avg",
    )


def idle_to_used_percent(idle_rates: DataFrame, by: list[str]) -> DataFrame:
    """100 − mean idle rate × 100 over the cores of a host."""
    return idle_rates.groupBy(*by).agg((F.lit(100.0) - F.avg("rate") * 100.0).alias("cpu_used_percent"))


def used_percent(available: Column, size: Column) -> Column:
    """(1 − available / size) × 100; NULL without a size."""
    return (F.lit(1.0) - available / F.nullif(size, F.lit(0))) * 100.0
