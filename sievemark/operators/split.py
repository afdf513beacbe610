"""Stratified and group-wise train/val/test splits with exact quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import seeded_md5
from .ranking import on_class, quota_cutoffs, within

# Default ratios, seed and split order.
TRAIN_RATIO = 0.70
VAL_RATIO = 0.15
SEED = 42
SPLITS = ["train", "val", "test"]


def largest_remainder(counts: DataFrame, label: str, size: Column, part: Column, name: str) -> DataFrame:
    """Share ``part`` of ``sum(size)`` over classes: floors, then one unit each to the
    largest fractional parts (ties by class name). One row per class."""
    whole = Window.partitionBy()
    exact = size * part / F.sum(size).over(whole)
    staged = counts.withColumn("_floor", F.floor(exact)).withColumn("_frac", exact - F.floor(exact))
    left = part - F.sum("_floor").over(whole)
    place = F.row_number().over(Window.partitionBy().orderBy(F.desc("_frac"), label))
    return staged.withColumn(name, (F.col("_floor") + F.when(place <= left, 1).otherwise(0)).cast("bigint")).drop(
        "_floor", "_frac"
    )


def split_quotas(
    class_counts: DataFrame, label: str, train_ratio: float = TRAIN_RATIO, val_ratio: float = VAL_RATIO
) -> DataFrame:
    """(class, n, train, val, test) from (class, n); the order of the double arithmetic matters."""
    test_ratio = 1.0 - train_ratio - val_ratio
    if test_ratio < 0.01:
        raise ValueError(f"train={train_ratio} and val={val_ratio} leave no test share")
    held = val_ratio + test_ratio
    total = F.sum("n").over(Window.partitionBy())
    sized = class_counts.select(label, F.col("n").cast("bigint").alias("n")).withColumn(
        "_held", F.ceil(total.cast("double") * F.lit(held))
    )
    sized = sized.withColumn("_test", F.ceil(F.col("_held").cast("double") * F.lit(1.0 - val_ratio / held)))
    sized = largest_remainder(
        sized.withColumn("_train", total - F.col("_held")), label, F.col("n").cast("double"), F.col("_train"), "train"
    )
    sized = sized.withColumn("_rest", (F.col("n") - F.col("train")).cast("double"))
    sized = largest_remainder(sized, label, F.col("_rest"), F.col("_held") - F.col("_test"), "val")
    return sized.select(label, "n", "train", "val", (F.col("n") - F.col("train") - F.col("val")).alias("test"))


def group_quotas(
    group_counts: DataFrame, label: str, train_ratio: float = TRAIN_RATIO, val_ratio: float = VAL_RATIO
) -> DataFrame:
    """Per class: ``int(train·n)``, ``int(val·n)``, the rest to test."""
    n = F.col("n").cast("double")
    return group_counts.select(
        label,
        "n",
        F.floor(n * F.lit(train_ratio)).alias("train"),
        F.floor(n * F.lit(val_ratio)).alias("val"),
    ).withColumn("test", F.col("n") - F.col("train") - F.col("val"))


def assign_splits(df: DataFrame, label: str, digest: Column, tie: str, quotas: DataFrame, hashed: DataFrame | None = None) -> DataFrame:
    """Adds ``split``. Rows are compared with two md5 cuts per class and never shuffled.

    ``hashed`` is the frame the cuts are taken from when it differs from ``df``
    (distinct groups instead of rows); it needs the same label, digest and tie.
    """
    cuts = quotas.select(
        label, F.col("train").alias("cut_train"), (F.col("train") + F.col("val")).alias("cut_val")
    )
    edges = quota_cutoffs(df if hashed is None else hashed, label, digest, tie, cuts)
    key = F.col(tie)
    split = (
        F.when(within(F.col("cut_train"), digest, key), "train")
        .when(within(F.col("cut_val"), digest, key), "val")
        .otherwise("test")
    )
    return on_class(df, edges, label, how="left").withColumn("split", split).drop("cut_train", "cut_val")


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    seed: int = SEED,
    train_ratio: float = TRAIN_RATIO,
    val_ratio: float = VAL_RATIO,
) -> DataFrame:
    """Stratified split with exact per-class quotas; ``key`` is unique per row. NULL is a class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    quotas = split_quotas(counts, label, train_ratio, val_ratio)
    return assign_splits(df, label, seeded_md5(seed, F.col(key)), key, quotas)


def group_split(
    df: DataFrame,
    label: str,
    group: str,
    seed: int = SEED,
    train_ratio: float = TRAIN_RATIO,
    val_ratio: float = VAL_RATIO,
) -> DataFrame:
    """Split whole groups, class by class; a class shuffles with seed + class index. NULL is a class, the first.

    The split of a row follows from its group's md5, so rows are not joined with groups.
    """
    groups = df.select(label, group).distinct()
    counts = groups.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    indexed = (
        counts.withColumn("_class_idx", F.row_number().over(Window.partitionBy().orderBy(label)) - 1)
    )
    quotas = group_quotas(indexed, label, train_ratio, val_ratio)
    idx = indexed.select(label, "_class_idx")
    digest = F.md5(F.concat_ws(":", (F.col("_class_idx") + seed).cast("string"), F.col(group)))
    return assign_splits(on_class(df, idx, label), label, digest, group, quotas, on_class(groups, idx, label)).drop("_class_idx")


def split_stats(split_rows: DataFrame, label: str) -> DataFrame:
    """Rows per class and split, zeros kept, with a total column."""
    return (
        split_rows.groupBy(label).pivot("split", SPLITS).agg(F.count(F.lit(1))).na.fill(0, SPLITS)
        .withColumn("total", F.col("train") + F.col("val") + F.col("test"))
    )


def split_totals(split_rows: DataFrame) -> DataFrame:
    return split_rows.groupBy("split").agg(F.count(F.lit(1)).alias("count"))


def stratification_percent(stats: DataFrame, label: str) -> DataFrame:
    """Split percent per class, 1 decimal."""
    return stats.select(
        label, "total", *[F.round(F.col(s) * 100.0 / F.col("total"), 1).alias(f"{s}_pct") for s in SPLITS]
    )


def stratification_range(percent: DataFrame) -> DataFrame:
    """Smallest and largest percent over classes, per split."""
    return percent.agg(
        *[agg(f"{s}_pct").alias(f"{s}_{name}") for s in SPLITS for name, agg in (("min", F.min), ("max", F.max))]
    )


def group_summary(split_rows: DataFrame, label: str, group: str) -> DataFrame:
    """Distinct groups and rows per (split, class).

    Groups are counted after grouping by group, so that one class does not keep a set of them.
    """
    per_group = split_rows.groupBy("split", label, group).agg(F.count(F.lit(1)).alias("_rows"))
    return per_group.groupBy("split", label).agg(
        F.count(F.lit(1)).alias("groups"), F.sum("_rows").alias("rows")
    )


def group_totals(summary: DataFrame) -> DataFrame:
    """Groups, rows and classes per split from :func:`group_summary`."""
    return summary.groupBy("split").agg(
        F.sum("groups").alias("groups"), F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("classes")
    )


def leaking_groups(split_rows: DataFrame, group: str) -> DataFrame:
    """Groups that occur in more than one split; must be empty."""
    spread = split_rows.groupBy(group).agg(F.min("split").alias("lo"), F.max("split").alias("hi"))
    return spread.filter("lo < hi").select(group)


def coverage_gaps(source: DataFrame, split_rows: DataFrame, key: str) -> DataFrame:
    """Keys of the source without a split, and split keys without a source row (multiset)."""
    lost = source.select(key).exceptAll(split_rows.select(key)).select(key, F.lit("lost").alias("side"))
    extra = split_rows.select(key).exceptAll(source.select(key)).select(key, F.lit("extra").alias("side"))
    return lost.unionByName(extra)
