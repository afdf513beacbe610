"""Similarity scores, the score filter and its reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors
from . import distribution
from .curate import nan_to_null
from .ranking import top_n_per_class
from .small import one_row

# Fixed values of the score filter: threshold, reason names, sweep, panel size.
SCORE_THRESHOLD = 0.03
REASON_LOW_SCORE = "low_score"
REASON_UNREADABLE = "unreadable"
SWEEP_THRESHOLDS = [-0.05, 0.0, 0.05, 0.1, 0.15]
PANEL_SIZE = 20
HISTOGRAM_BINS = 60
QUANTILES = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95}


def prompt_scores(features: DataFrame, positive: DataFrame, negative: DataFrame, vec: str = "vec") -> DataFrame:
    """Best cosine to the positive and to the negative prompts, and the difference.

    Prompts are a handful of vectors by definition and travel as one array each.
    Unreadable items (NULL vector) get NULL scores.
    """
    pos = positive.agg(F.collect_list(vectors.normalise(F.col(vec))).alias("_pos"))
    neg = negative.agg(F.collect_list(vectors.normalise(F.col(vec))).alias("_neg"))
    # one row, attached once
    unit = features.withColumn("_unit", vectors.normalise(F.col(vec))).join(F.broadcast(pos.join(neg)))
    scored = unit.withColumn(
        "score_positive", vectors.best_dot("_unit", "_pos")
    ).withColumn("score_negative", vectors.best_dot("_unit", "_neg"))
    return scored.withColumn("score_final", F.col("score_positive") - F.col("score_negative")).drop(
        "_unit", "_pos", "_neg", vec
    )


def readable(scores: DataFrame) -> DataFrame:
    return scores.filter(nan_to_null(F.col("score_final")).isNotNull())


def unreadable(scores: DataFrame) -> DataFrame:
    return scores.filter(nan_to_null(F.col("score_final")).isNull())


def passed(scores: DataFrame, threshold: float = SCORE_THRESHOLD) -> DataFrame:
    return scores.filter(nan_to_null(F.col("score_final")) >= threshold)


def failed(scores: DataFrame, threshold: float = SCORE_THRESHOLD) -> DataFrame:
    return scores.filter(nan_to_null(F.col("score_final")) < threshold)


def with_flag(scores: DataFrame, threshold: float = SCORE_THRESHOLD) -> DataFrame:
    """Adds ``passed``; an unreadable row does not pass."""
    return scores.withColumn("passed", F.coalesce(nan_to_null(F.col("score_final")) >= threshold, F.lit(False)))


def exclusions(scores: DataFrame, threshold: float, model: str) -> DataFrame:
    """Ledger of the rows that did not pass, with reason and rounded scores."""
    score = nan_to_null(F.col("score_final"))
    low = score < threshold
    lost = scores.filter(low | score.isNull())
    return lost.select(
        "item", "species", F.when(low, REASON_LOW_SCORE).otherwise(REASON_UNREADABLE).alias("reason"),
        F.lit(float(threshold)).alias("threshold"), F.lit(model).alias("model"),
        *[F.when(low, F.round(c, 4)).alias(c) for c in ("score_positive", "score_negative", "score_final")],
    )


def reason_page(ledger: DataFrame, reason: str | None, limit: int = 200) -> DataFrame:
    """First page of the ledger, optionally for one reason, in item order."""
    rows = ledger if reason is None else ledger.filter(F.col("reason") == reason)
    return rows.orderBy("item", "species").limit(limit)


def score_stats(scores: DataFrame, threshold: float = SCORE_THRESHOLD) -> DataFrame:
    """Counts, min, max, mean, sample std and quantiles (4 decimals)."""
    score = nan_to_null(F.col("score_final"))
    counts = {
        "total": F.count(F.lit(1)), "passed": F.count_if(score >= threshold), "failed": F.count_if(score < threshold),
    }
    row = distribution.summarise(scores, score, QUANTILES, extra=counts)
    return row.select(
        F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("count", F.lit(0)).alias("valid"),
        F.coalesce(F.col("total") - F.col("count"), F.lit(0)).alias("unreadable"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("passed", "failed")],
        *[F.round(c, 4).alias(c) for c in ("min", "max", "mean", "std", *QUANTILES)],
    )


def class_pass(scores: DataFrame, threshold: float = SCORE_THRESHOLD) -> DataFrame:
    """total / kept / excluded per class in one aggregation."""
    kept = F.count_if(nan_to_null(F.col("score_final")) >= threshold)
    return scores.groupBy("species").agg(
        F.count(F.lit(1)).alias("total"), kept.alias("kept"), (F.count(F.lit(1)) - kept).alias("excluded")
    )


def kept_by_join(scores: DataFrame, kept: DataFrame) -> DataFrame:
    """The same report from two tables: all scores and an already filtered manifest. NULL is a class."""
    totals = scores.groupBy("species").agg(F.count(F.lit(1)).alias("total"))
    kept_counts = kept.groupBy(F.col("species").alias("_species")).agg(F.count(F.lit(1)).alias("kept"))
    return totals.join(kept_counts, F.col("species").eqNullSafe(F.col("_species")), "left").select(
        "species",
        "total",
        F.coalesce("kept", F.lit(0)).alias("kept"),
        (F.col("total") - F.coalesce("kept", F.lit(0))).alias("excluded"),
    )


def cleaning_update(scores: DataFrame, before_rows: DataFrame, threshold: float = SCORE_THRESHOLD) -> DataFrame:
    """Report row after the score filter, recomputed from the tables.

    Running it twice gives the same row. ``before_rows`` are the raw observations.
    """
    score = nan_to_null(F.col("score_final"))
    ok = score >= threshold
    raw = before_rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    return scores.agg(
        F.count(F.lit(1)).alias("before_total"),
        F.count_if(ok).alias("after_total"),
        F.countDistinct(F.when(ok, F.col("species"))).alias("after_classes"),
        F.count_if(score < threshold).alias("excluded_by_score"),
        F.count_if(score.isNull()).alias("excluded_unreadable"),
    ).withColumn("excluded_total", raw - F.col("after_total"))


def threshold_sweep(scores: DataFrame, thresholds: list[float] = SWEEP_THRESHOLDS) -> DataFrame:
    """Passing count and percent (1 decimal) per threshold, in one aggregate."""
    score = nan_to_null(F.col("score_final"))
    counts = scores.agg(
        F.count(score).alias("valid"),
        F.array(*[
            F.struct(F.lit(float(t)).alias("threshold"), F.count_if(score >= t).alias("passed")) for t in thresholds
        ]).alias("steps"),
    )
    return counts.select("valid", F.explode("steps").alias("s")).select(
        "s.threshold", "s.passed", F.round(F.col("s.passed") * 100.0 / F.col("valid"), 1).alias("percent")
    )


def equal_width_histogram(scores: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts on ``bins`` equal-width bins between min and max, last bin closed; empty bins kept."""
    score = nan_to_null(F.col("score_final"))
    valid = scores.filter(score.isNotNull())
    span = one_row(valid.agg(F.min("score_final").alias("lo"), F.max("score_final").alias("hi")))
    placed = valid.select(
        F.least(
            F.floor((F.col("score_final") - span["lo"]) / (span["hi"] - span["lo"]) * bins), F.lit(bins - 1)
        ).cast("bigint").alias("bin")
    )
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    grid = scores.sparkSession.range(bins).withColumnRenamed("id", "bin")
    width = (span["hi"] - span["lo"]) / bins
    return grid.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (span["lo"] + F.col("bin") * width).alias("low"),
        (span["lo"] + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def quantile_marks(scores: DataFrame) -> DataFrame:
    """(mark, value): the quantiles that are marked in a histogram of the scores, 3 decimals."""
    row = distribution.quantiles(scores, F.col("score_final"), QUANTILES)
    marks = F.array(*[F.struct(F.lit(n).alias("mark"), F.round(n, 3).alias("value")) for n in QUANTILES])
    return row.select(F.explode(marks).alias("m")).select("m.*")


def panels(scores: DataFrame, threshold: float = SCORE_THRESHOLD, size: int = PANEL_SIZE) -> DataFrame:
    """Highest, lowest and nearest-to-threshold rows, ties by item; one pass, each task sends ``size`` rows a panel."""
    valid = readable(scores).select("item", "species", "score_final")
    score = F.col("score_final")
    orders = {"top": -score, "bottom": score, "borderline": F.abs(score - threshold)}
    each = F.array(*[F.struct(F.lit(n).alias("panel"), o.alias("_order")) for n, o in orders.items()])
    rows = valid.withColumn("_p", F.explode(each)).select("_p.panel", "item", "species", "score_final", "_p._order")
    return top_n_per_class(rows, "panel", size, "_order", "item", name="_rank").drop("_order", "_rank")
