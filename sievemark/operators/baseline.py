"""Baseline of a prediction log: per class, global figures, confidence histogram."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import distribution
from .small import share_of_total

# Histogram edges of the confidence baseline.
CONFIDENCE_EDGES = [0.0, 0.5, 0.7, 0.8, 0.9, 0.95, 0.99, 1.0]


def class_baseline(predictions: DataFrame) -> DataFrame:
    """count, share, mean/min/max confidence per predicted class, largest first."""
    stats = predictions.groupBy("predicted_class").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("confidence").alias("confidence_mean"),
        F.min("confidence").alias("confidence_min"),
        F.max("confidence").alias("confidence_max"),
    )
    return stats.withColumn("share", share_of_total(stats, "count")).orderBy(F.desc("count"), "predicted_class")


def global_baseline(predictions: DataFrame) -> DataFrame:
    """Accuracy (when ``correct`` exists), mean and P10/P50/P95 confidence; 0.0 when empty."""
    probs = {"confidence_p10": 0.10, "confidence_p50": 0.50, "confidence_p95": 0.95}
    extra = {"right": F.count_if("correct"), "known": F.count("correct")} if "correct" in predictions.columns else {}
    row = distribution.summarise(predictions, F.col("confidence"), probs, extra=extra)
    accuracy = F.col("right") / F.nullif(F.col("known"), F.lit(0)) if extra else F.lit(None).cast("double")
    zero = F.lit(0.0)
    return row.select(
        F.coalesce(accuracy, zero).alias("top1_accuracy"), F.coalesce("mean", zero).alias("confidence_mean"),
        *[F.coalesce(p, zero).alias(p) for p in probs],
    )


def edge_counts(value: Column, edges: list[float], weight: Column | None = None) -> list[Column]:
    """One conditional count per bucket: half-open, the last one closed."""
    last = len(edges) - 2
    counts = []
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        inside = (value >= low) & ((value <= high) if i == last else (value < high))
        counts.append(F.count_if(inside if weight is None else inside & weight))
    return counts


def edge_histogram(df: DataFrame, column: str, edges: list[float] = CONFIDENCE_EDGES) -> DataFrame:
    """bucket, low, high, count, share on fixed edges; empty buckets are kept.

    One pass without a shuffle key: every bucket is a conditional count.
    """
    value = F.nullif(F.col(column), F.lit(float("nan")))
    entries = [
        F.struct(
            F.lit(f"[{low:.2f}, {high:.2f})").alias("bucket"),
            F.lit(low).alias("low"),
            F.lit(high).alias("high"),
            count.alias("count"),
        )
        for low, high, count in zip(edges, edges[1:], edge_counts(value, edges))
    ]
    one = df.agg(F.count(value).alias("n"), F.array(*entries).alias("b"))
    share = F.when(F.col("n") > 0, F.col("s.count") / F.col("n")).otherwise(F.lit(0.0))
    return one.select("n", F.explode("b").alias("s")).select("s.*", share.alias("share"))


def expand_counts(classes: DataFrame, chunk: int = 100_000) -> DataFrame:
    """Rebuild ``count`` rows per class, each with the class mean as confidence.

    Kept for compatibility: it loses the spread inside a class. Counts are cut into
    chunks that spread over tasks, so one huge class is not expanded in one task.
    """
    chunks = classes.select(
        "predicted_class",
        F.col("confidence_mean").alias("confidence"),
        F.col("count").alias("_n"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.expr(f"(count - 1) div {chunk}"), F.lit(0)))).alias("_chunk"),
    ).filter("_n > 0")
    size = F.least(F.lit(chunk), F.col("_n") - F.col("_chunk") * chunk).cast("int")
    return chunks.repartition("predicted_class", "_chunk").select(
        "predicted_class", "confidence", F.explode(F.sequence(F.lit(1), size)).alias("_i")
    ).drop("_i")
