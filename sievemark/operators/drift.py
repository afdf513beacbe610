"""Drift between a reference and a current prediction log.

Both logs are tagged with their side and reduced together to one index: distinct values with
their number on either side. The index is made by one aggregation with map-side combine and
merges by addition; chi-square, Jensen-Shannon, KS, Wasserstein, PSI and the moments are all
read from it, so no test goes back to the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.gamma import chi_square_tail
from ..functions.text import decimal_comma
from . import distribution
from .baseline import CONFIDENCE_EDGES
from .small import one_row

# Verdict thresholds, significance level, floor of an empty PSI bin.
DRIFT_SHARE_THRESHOLD = 0.5
MIN_CURRENT_ROWS = 200
SIGNIFICANCE = 0.05
PSI_FLOOR = 1e-4
KS_TERMS = 100


def sides(reference: DataFrame, current: DataFrame | None, columns: list[str]) -> DataFrame:
    """Union of both logs with a boolean ``is_current``.

    Without ``current`` the first log is both: it has the column already, and is read once.
    """
    if current is None:
        return reference.select(*columns, "is_current")
    return reference.select(*columns, F.lit(False).alias("is_current")).unionByName(
        current.select(*columns, F.lit(True).alias("is_current"))
    )


def index(reference: DataFrame, current: DataFrame | None, *columns: str) -> DataFrame:
    """Distinct values of the columns with their rows on either side: ``r`` and ``c``."""
    return sides(reference, current, list(columns)).groupBy(*columns).agg(
        F.count_if(~F.col("is_current")).alias("r"), F.count_if("is_current").alias("c")
    )


def reduced(counts: DataFrame, column: str, numeric: bool = False) -> DataFrame:
    """The index of one of its columns: ``value``, ``r``, ``c``. A numeric column loses NULL and NaN."""
    value = F.nullif(F.col(column).cast("double"), F.lit(float("nan"))) if numeric else F.col(column)
    rows = counts.select(value.alias("value"), "r", "c")
    rows = rows.filter("value IS NOT NULL") if numeric else rows
    return rows.groupBy("value").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))


def align_classes(reference: DataFrame, current: DataFrame, label: str = "predicted_class") -> DataFrame:
    """(class, n_reference, n_current), 0 on the side that lacks the class; NULL is a class."""
    return index(reference, current, label).select(label, F.col("r").alias("n_reference"), F.col("c").alias("n_current"))


def chi_square_of(classes: DataFrame) -> DataFrame:
    """Statistic, degrees of freedom and p-value from the index of a categorical column."""
    whole = classes.withColumn("_t", one_row(classes.agg(F.sum("r").cast("double").alias("r"), F.sum("c").cast("double").alias("c"))))
    figures = whole.selectExpr("r", "c", "_t.r AS tr", "_t.c AS tc", "(r + c) * _t.r / nullif(_t.r + _t.c, 0) AS er", "(r + c) * _t.c / nullif(_t.r + _t.c, 0) AS ec")
    stat = figures.agg(
        F.expr("sum(CASE WHEN tr > 0 AND tc > 0 THEN (r - er) * (r - er) / er + (c - ec) * (c - ec) / ec END)").alias("statistic"),
        F.expr("CAST(count(1) - 1 AS INT)").alias("df"),
    )
    return stat.withColumn("p_value", chi_square_tail(F.col("statistic"), F.col("df")))


def chi_square(reference: DataFrame, current: DataFrame | None = None, label: str = "predicted_class") -> DataFrame:
    """Chi-square of the class distribution: statistic, degrees of freedom, p-value."""
    return chi_square_of(reduced(index(reference, current, label), label))


def ks_p_value(statistic: Column, n: Column, m: Column) -> Column:
    """Two-sided asymptotic p-value of the two-sample statistic (Kolmogorov series)."""
    lam = statistic * F.sqrt(n * m / F.nullif(n + m, F.lit(0.0)))
    terms = F.sequence(F.lit(1), F.lit(KS_TERMS))
    series = F.aggregate(
        terms,
        F.lit(0.0),
        lambda s, k: s + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    # below 0.2 the p-value is 1 to double precision and the series converges slowly
    return F.when(lam < 0.2, F.lit(1.0)).when(lam.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), series * 2.0)))


GAP = "abs(r_cum / nullif(r_total, 0) - c_cum / nullif(c_total, 0))"


def ks_of(values: DataFrame) -> DataFrame:
    """Statistic and p-value from the index of a numeric column."""
    stat = distribution.cumulative(values, "value", ["r", "c"]).agg(
        F.expr(f"max({GAP})").alias("statistic"),
        F.expr("CAST(max(r_total) AS DOUBLE)").alias("n"), F.expr("CAST(max(c_total) AS DOUBLE)").alias("m"),
    )
    return stat.select("statistic", ks_p_value(F.col("statistic"), F.col("n"), F.col("m")).alias("p_value"))


def ks(reference: DataFrame, current: DataFrame | None = None, column: str = "confidence") -> DataFrame:
    """Two-sample Kolmogorov-Smirnov: largest gap of the empirical distributions, p-value."""
    return ks_of(reduced(index(reference, current, column), column, numeric=True))


def moments_of(values: DataFrame) -> DataFrame:
    """rn, rm, rs and cn, cm, cs: number, mean and sample std of either side, one row."""
    means = one_row(values.agg(F.expr("sum(r * value) / nullif(sum(r), 0)").alias("r"), F.expr("sum(c * value) / nullif(sum(c), 0)").alias("c")))
    spread = "CASE WHEN sum({0}) > 1 THEN sqrt(sum({0} * (value - m.{0}) * (value - m.{0})) / (sum({0}) - 1)) END"
    return values.withColumn("m", means).agg(*[
        F.expr(e).alias(n) for side in "rc"
        for n, e in ((f"{side}n", f"coalesce(sum({side}), 0)"), (f"{side}m", f"max(m.{side})"), (f"{side}s", spread.format(side)))
    ])


def wasserstein_of(values: DataFrame) -> DataFrame:
    """Distance, and the same divided by the reference standard deviation, from the index of a numeric column."""
    width = "coalesce(next_value - value, 0.0D)"
    distance = distribution.cumulative(values, "value", ["r", "c"]).agg(F.expr(f"sum({GAP} * {width})").alias("distance"))
    return distance.withColumn("_m", one_row(moments_of(values))).selectExpr("distance", "distance / nullif(_m.rs, 0.0D) AS normed")


def wasserstein(reference: DataFrame, current: DataFrame | None = None, column: str = "confidence") -> DataFrame:
    """1-D Wasserstein distance, and the same divided by the reference standard deviation."""
    return wasserstein_of(reduced(index(reference, current, column), column, numeric=True))


def jensen_shannon_of(classes: DataFrame) -> DataFrame:
    """Divergence (base 2, 0 to 1) and its root, the distance, from the index of a categorical column."""
    tot = one_row(classes.agg(F.sum("r").alias("r"), F.sum("c").alias("c")))
    shares = classes.withColumn("_t", tot).selectExpr("r / nullif(_t.r, 0) AS p", "c / nullif(_t.c, 0) AS q")
    parts = [f"CASE WHEN {x} > 0 THEN {x} * log2({x} / ((p + q) / 2.0D)) ELSE 0.0D END" for x in "pq"]
    total = shares.agg(F.expr(f"greatest(sum({' + '.join(parts)}) / 2.0D, 0.0D)").alias("divergence"))
    return total.selectExpr("divergence", "sqrt(divergence) AS distance")


def jensen_shannon(reference: DataFrame, current: DataFrame | None = None, label: str = "predicted_class") -> DataFrame:
    """Jensen-Shannon divergence (base 2, 0 to 1) and its root, the distance."""
    return jensen_shannon_of(reduced(index(reference, current, label), label))


def psi_of(values: DataFrame, edges: list[float] = CONFIDENCE_EDGES) -> DataFrame:
    """Population stability index over fixed bins, from the index of a numeric column."""
    terms = []
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        inside = f"value >= {low!r}D AND value {'<=' if i == len(edges) - 2 else '<'} {high!r}D"
        p, q = (f"greatest(coalesce(sum(CASE WHEN {inside} THEN {s} END), 0) / nullif(sum({s}), 0), {PSI_FLOOR!r}D)" for s in "rc")
        terms.append(f"({q} - {p}) * ln({q} / {p})")
    return values.agg(F.expr(" + ".join(terms)).alias("psi"))


def psi(
    reference: DataFrame, current: DataFrame | None = None, column: str = "confidence", edges: list[float] = CONFIDENCE_EDGES
) -> DataFrame:
    """Population stability index over fixed bins; an empty bin counts as ``PSI_FLOOR``."""
    return psi_of(reduced(index(reference, current, column), column, numeric=True), edges)


def summary_of(counts: DataFrame) -> DataFrame:
    """``summary`` from the joint index of class and confidence."""
    classes = reduced(counts, "predicted_class")
    sizes = classes.agg(
        F.expr("coalesce(sum(c), 0)").alias("n_current"), F.expr("coalesce(sum(r), 0)").alias("n_reference"),
        F.expr("count_if(c > 0 AND value IS NOT NULL)").alias("n_current_classes"), F.expr("count_if(r > 0 AND value IS NOT NULL)").alias("n_reference_classes"),
    )
    return sizes.withColumn("_m", one_row(moments_of(reduced(counts, "confidence", numeric=True)))).selectExpr(
        "n_current", "n_reference", "_m.cm AS confidence_current_mean", "_m.rm AS confidence_reference_mean",
        "_m.cs AS confidence_current_std", "_m.rs AS confidence_reference_std", "n_current_classes", "n_reference_classes",
    )


def summary(reference: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """Sizes, number of named classes, mean and sample std of the confidence, both sides, one row."""
    return summary_of(index(reference, current, "predicted_class", "confidence"))


def side_by_side(reference: DataFrame, current: DataFrame, label: str = "predicted_class", column: str = "confidence") -> DataFrame:
    """Descriptive statistics, one row per side and column.

    The numeric column has mean, std, min, quartiles and max; the class column the number of
    its values, the most frequent one (the smaller of two) and how often it occurs.
    """
    both = sides(reference, current, [label, column]).withColumn("side", F.expr("CASE WHEN is_current THEN 'current' ELSE 'reference' END"))
    numbers = distribution.describe(both, F.col(column), ["side"]).withColumn("column", F.lit(column))
    counts = both.filter(F.col(label).isNotNull()).groupBy("side", F.col(label).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    texts = counts.groupBy("side").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), F.max("n").alias("freq"),
        F.min_by("value", F.struct(-F.col("n"), "value")).alias("top"),
    ).withColumn("column", F.lit(label))
    return numbers.unionByName(texts, allowMissingColumns=True)


def drift_share(*flags: Column) -> Column:
    """Share of drifted columns; unknown flags are left out, NULL when all are."""
    known = F.array_compact(F.array(*[f.cast("double") for f in flags]))
    total = F.aggregate(known, F.lit(0.0), lambda s, x: s + x)
    return F.when(F.size(known) > 0, total / F.size(known))


def verdict(
    n_current: Column,
    dataset_drift: Column,
    share: Column,
    threshold: float = DRIFT_SHARE_THRESHOLD,
    minimum: int = MIN_CURRENT_ROWS,
) -> Column:
    """no_data / insufficient / drift / stable, in this order; the flag beats the share."""
    detected = F.coalesce(dataset_drift, share >= threshold, F.lit(False))
    return (
        F.when(n_current == 0, "no_data")
        .when(n_current < minimum, "insufficient")
        .when(detected, "drift")
        .otherwise("stable")
    )


def trend_text(cur_mean: Column, ref_mean: Column, cur_std: Column, ref_std: Column) -> Column:
    """Sentence on the change of mean and spread; NULL when a mean is missing."""
    # The sentence parts of the report.
    direction = F.when(cur_mean < ref_mean, "plus basse").otherwise("comparable ou plus haute")
    dispersion = F.when(cur_std > ref_std, "plus dispersée").otherwise("aussi stable")
    spread = F.concat(
        F.lit(" et "), dispersion, F.lit(" (écart-type "), decimal_comma(cur_std), F.lit(" contre "),
        decimal_comma(ref_std), F.lit(")"),
    )
    text = F.concat(
        F.lit("Confiance moyenne en production : "), decimal_comma(cur_mean), F.lit(", contre "),
        decimal_comma(ref_mean), F.lit(" en référence. Elle est "), direction,
        F.coalesce(spread, F.lit("")),
        F.lit(", ce qui est cohérent avec des images de terrain plus variées."),
    )
    return F.when(cur_mean.isNotNull() & ref_mean.isNotNull(), text)


# Test methods by column kind and their thresholds.
CATEGORICAL_METHODS = {"chi_square": SIGNIFICANCE, "jensen_shannon": 0.1}
NUMERIC_METHODS = {"ks": SIGNIFICANCE, "wasserstein": 0.1, "psi": 0.2}


def drift_of(values: DataFrame, column: str, method: str, threshold: float | None = None) -> DataFrame:
    """One row (column, method, score, threshold, drifted) from the index of a column."""
    tests = {
        "chi_square": (chi_square_of, "p_value"), "ks": (ks_of, "p_value"), "jensen_shannon": (jensen_shannon_of, "distance"),
        "wasserstein": (wasserstein_of, "normed"), "psi": (psi_of, "psi"),
    }
    if method not in tests:
        raise ValueError(f"unknown drift method {method!r}")
    run, field = tests[method]
    bound = {**CATEGORICAL_METHODS, **NUMERIC_METHODS}[method] if threshold is None else threshold
    score = F.col(field)
    drifted = score < bound if field == "p_value" else score >= bound
    return run(values).select(
        F.lit(column).alias("column"), F.lit(method).alias("method"), score.alias("score"),
        F.lit(float(bound)).alias("threshold"), drifted.alias("drifted"),
    )


def column_drift(reference: DataFrame, current: DataFrame, column: str, method: str, threshold: float | None = None) -> DataFrame:
    """One row (column, method, score, threshold, drifted) for a chosen method."""
    return drift_of(reduced(index(reference, current, column), column, method in NUMERIC_METHODS), column, method, threshold)


def drift_job(
    reference: DataFrame,
    current: DataFrame | None = None,
    categorical: str = "chi_square",
    numeric: str = "ks",
    require_rows: bool = False,
) -> DataFrame:
    """Baseline, recent window, tests and verdict as one summary row, from one joint index of both logs.

    ``require_rows`` asks at once whether the window is empty and raises, as a scheduled job
    should; otherwise nothing runs here and the verdict is ``no_data``.
    """
    if require_rows and (reference.filter("is_current") if current is None else current).isEmpty():
        raise ValueError("no predictions in the window")
    counts = index(reference, current, "predicted_class", "confidence")
    cat = one_row(drift_of(reduced(counts, "predicted_class"), "predicted_class", categorical))
    num = one_row(drift_of(reduced(counts, "confidence", numeric=True), "confidence", numeric))
    base = summary_of(counts).withColumn("_cat", cat).withColumn("_num", num)
    share = drift_share(F.col("_cat.drifted"), F.col("_num.drifted"))
    flagged = base.withColumn("share_of_drifted_columns", share).withColumn(
        "dataset_drift", F.col("share_of_drifted_columns") >= DRIFT_SHARE_THRESHOLD
    )
    return flagged.select(
        "n_current", "n_reference", "n_current_classes", "n_reference_classes",
        F.col("_cat.score").alias("class_score"), F.col("_num.score").alias("confidence_score"),
        "dataset_drift", "share_of_drifted_columns",
        "confidence_current_mean", "confidence_reference_mean",
        "confidence_current_std", "confidence_reference_std",
        verdict(F.col("n_current"), F.col("dataset_drift"), F.col("share_of_drifted_columns")).alias("status"),
        trend_text(
            F.col("confidence_current_mean"), F.col("confidence_reference_mean"),
            F.col("confidence_current_std"), F.col("confidence_reference_std"),
        ).alias("confidence_trend"),
    )
