"""Exact order statistics on the 64-bit images of doubles; nothing runs before the action.

A wanted rank is found by radix selection: a histogram of the leading 16 bits, then one of
the next 24 bits for the few prefixes that hold a wanted rank, then one of the last 24. What
is shuffled are histogram rows, their number bounded by the digits whatever the values are.
Moments ride on the first histogram.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordinals import from_ordinal, ordinal

DIGIT = 24
LEADING = 48
#: Bits below the cells of ``cumulative``.
CELL = 24


def over(by: list[str], order: str = "") -> str:
    """SQL window over the groups of ``by``; with an order, of the rows before the current one."""
    parts = f"PARTITION BY {', '.join(by)} " if by else ""
    return f"OVER ({parts}{f'ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING' if order else ''})"


def leading_histogram(df: DataFrame, value: Column, by: list[str], extra: dict[str, Column] | None = None) -> DataFrame:
    """Rows by leading digit ``d`` (NULL: no value) with count and moments; ``extra`` are counting aggregates."""
    rows = df.withColumn("_x", F.nullif(value.cast("double"), F.lit(float("nan")))).withColumn("_k", ordinal(F.col("_x")))
    parts = {"n": "count(_x)", "mean": "avg(_x)", "var": "var_pop(_x)", "min": "min(_x)", "max": "max(_x)"}
    return rows.groupBy(*by, F.expr(f"shiftright(_k, {LEADING})").alias("d")).agg(
        *[F.expr(e).alias(n) for n, e in parts.items()], *[c.alias(n) for n, c in (extra or {}).items()]
    )


def moments(histogram: DataFrame, by: list[str], extra: list[str]) -> DataFrame:
    """count, mean, std (sample), min and max from the parts, and sums of ``extra``."""
    parts = histogram.selectExpr("*", f"sum(n * mean) {over(by)} / nullif(sum(n) {over(by)}, 0) AS _mean")
    figures = {
        "count": "sum(n)", "mean": "max(_mean)", "min": "min(min)", "max": "max(max)",
        "std": "CASE WHEN sum(n) > 1 THEN sqrt(sum(CASE WHEN n > 0 THEN n * (var + (mean - _mean) * (mean - _mean)) END) / (sum(n) - 1)) END",
    }
    return parts.groupBy(*by).agg(*[F.expr(e).alias(n) for n, e in figures.items()], *[F.sum(c).alias(c) for c in extra])


def selected(keys: DataFrame, histogram: DataFrame, probs: list[float], by: list[str]) -> DataFrame:
    """(_by…, total, rank, value) of the ranks (from 0) next to each quantile, by radix selection.

    ``keys`` has the images ``k``, ``histogram`` their count ``n`` by leading digit ``d``.
    """
    held = (
        "filter(transform(items, i -> struct(i.rank AS rank, i.within - before AS within)), i -> i.within >= 0 AND i.within < n) AS items"
    )
    positions = [f"{f}({q!r}D * (total - 1))" for q in probs for f in ("floor", "ceil")]
    groups = [f"_{c}" for c in by]
    renamed = [f"{c} AS _{c}" for c in by]
    found = histogram.filter("d IS NOT NULL").selectExpr(
        *renamed, "d AS prefix", "n", f"coalesce(sum(n) {over(by, 'd')}, 0) AS before", f"sum(n) {over(by)} AS total"
    )
    found = found.selectExpr("*", f"transform(array_distinct(array({', '.join(positions)})), r -> struct(r AS rank, r AS within)) AS items")
    found = found.selectExpr(*groups, "total", "prefix", held).filter("size(items) > 0")
    for shift in range(LEADING - DIGIT, -1, -DIGIT):
        same = " AND ".join([f"shiftright(k, {shift + DIGIT}) = prefix", *[f"{c} <=> _{c}" for c in by]])
        digit = F.expr(f"shiftright(k, {shift}) & {(1 << DIGIT) - 1}").alias("d")
        # a row for each wanted rank at most: their number is the caller's
        counts = keys.join(F.broadcast(found), F.expr(same)).groupBy(*groups, "total", "prefix", "items", digit).agg(F.expr("count(1)").alias("n"))
        counts = counts.selectExpr("*", f"coalesce(sum(n) {over([*groups, 'prefix'], 'd')}, 0) AS before")
        found = counts.selectExpr(*groups, "total", f"shiftleft(prefix, {DIGIT}) + d AS prefix", held).filter("size(items) > 0")
    return found.selectExpr(*groups, "total", "prefix", "explode(items.rank) AS rank").select(
        *groups, "total", "rank", from_ordinal(F.col("prefix")).alias("value")
    )


def interpolated(found: DataFrame, probs: dict[str, float], by: list[str]) -> DataFrame:
    """Linear quantiles from the selected ranks."""
    result = []
    for name, q in probs.items():
        position = f"{q!r}D * (total - 1)"
        low, high = (f"max(CASE WHEN rank = {f}({position}) THEN value END)" for f in ("floor", "ceil"))
        part = f"max({position} - floor({position}))"
        result.append(F.expr(f"CASE WHEN {low} = {high} THEN {low} ELSE {low} + ({high} - {low}) * {part} END").alias(name))
    return found.groupBy(*[f"_{c}" for c in by]).agg(*result)


def keyed(df: DataFrame, value: Column, by: list[str]) -> DataFrame:
    return df.select(*by, ordinal(value).alias("k")).filter("k IS NOT NULL")


def quantiles(df: DataFrame, value: Column, probs: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Exact, linearly interpolated quantiles: one row, or one for each group of ``by`` (few groups)."""
    by = by or []
    row = summarise(df, value, probs, by)
    return row.select(*by, *probs)


def summarise(
    df: DataFrame, value: Column, probs: dict[str, float], by: list[str] | None = None, extra: dict[str, Column] | None = None
) -> DataFrame:
    """count, mean, std, min, max, quantiles and ``extra`` counts of one column; NULL and NaN are left out of the figures."""
    by = by or []
    histogram = leading_histogram(df, value, by, extra)
    q = interpolated(selected(keyed(df, value, by), histogram, list(probs.values()), by), probs, by)
    base = moments(histogram, by, list(extra or {}))
    names = ["count", "mean", "std", "min", "max", *(extra or {})]
    if not by:
        return base.withColumn("_q", q.select(F.struct(*probs)).scalar()).selectExpr(*names, *[f"_q.{p}" for p in probs])
    same = F.expr(" AND ".join(f"{c} <=> _{c}" for c in by))
    return base.join(q, same, "left").select(*by, *names, *probs)


def describe(df: DataFrame, value: Column, by: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles, max of one column (NULL and NaN left out)."""
    row = summarise(df, value, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, by)
    return row.select(*(by or []), "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def cumulative(counts: DataFrame, value: str, weights: list[str]) -> DataFrame:
    """One row per value with, per weight ``w``: ``w``, ``w_cum`` (itself included), ``w_total``, and ``next_value``.

    ``counts`` has one row per distinct value. Prefix sums run over a trie of the images: in
    cells of 24 low bits, over the cells of one leading digit, and over the leading digits,
    so that no window holds more than 2^24 rows whatever the values are.
    """
    images = counts.select(F.col(value).alias("value"), ordinal(F.col(value)).alias("k"), *weights).filter(F.col("k").isNotNull())
    images = images.withColumn("cell", F.shiftright("k", CELL))
    inside = Window.partitionBy("cell").orderBy("k")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = images.select(
        "cell", "value", F.lead("value").over(inside).alias("_next"), *weights, *[F.sum(w).over(running).alias(f"{w}_run") for w in weights]
    )
    cells = images.groupBy("cell").agg(F.min("value").alias("_low"), *[F.sum(w).alias(w) for w in weights])
    cells = cells.withColumn("top", F.shiftright("cell", LEADING - CELL))
    within = Window.partitionBy("top").orderBy("cell")
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(
        "cell", "top", F.lead("_low").over(within).alias("_next_low"), *[F.coalesce(F.sum(w).over(earlier), F.lit(0)).alias(f"{w}_in") for w in weights]
    )
    order = Window.orderBy("top")
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tops = cells.groupBy("top").agg(F.min("_low").alias("_least"), *[F.sum(w).alias(w) for w in weights]).select(
        "top", F.lead("_least").over(order).alias("_next_least"),
        *[F.coalesce(F.sum(w).over(before), F.lit(0)).alias(f"{w}_off") for w in weights], *[F.sum(w).over(whole).alias(f"{w}_total") for w in weights],
    )
    # at most 65,536 leading digits
    placed = offsets.join(F.broadcast(tops), "top")
    return values.join(placed, "cell").select(
        "value", F.coalesce("_next", "_next_low", "_next_least").alias("next_value"), *weights,
        *[(F.col(f"{w}_run") + F.col(f"{w}_in") + F.col(f"{w}_off")).alias(f"{w}_cum") for w in weights], *[f"{w}_total" for w in weights],
    )
