"""Profiles of tables and files: counts, imbalance, missing values, descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import distribution


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, largest first, ties by value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), column)


def imbalance(counts: DataFrame, label: str) -> DataFrame:
    """Total, classes, smallest and largest class, and their ratio (1 decimal)."""
    by_size = F.struct("count", label)
    # the largest class with the smallest name wins a tie, as the smallest one does
    largest = F.struct(F.lit(0) - F.col("count"), F.col(label))
    return counts.agg(
        F.sum("count").alias("total"),
        F.count(F.lit(1)).alias("classes"),
        F.min_by(label, by_size).alias("min_class"),
        F.min("count").alias("min_count"),
        F.min_by(label, largest).alias("max_class"),
        F.max("count").alias("max_count"),
        F.round(F.max("count") / F.min("count"), 1).alias("imbalance_ratio"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) for the columns that have any."""
    missing = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return missing.unpivot([], df.columns, "column", "nulls").filter("nulls > 0")


def describe(df: DataFrame, column: Column) -> DataFrame:
    """count, mean, std, min, quartiles and max, all exact."""
    return distribution.describe(df, column)


def describe_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per text column: count, distinct values, most frequent value and its count.

    One shuffle on (column, value) after map-side counting; ties go to the smaller value.
    """
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("p")).select("p.*").filter("value IS NOT NULL")
    counts = pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(F.lit(0) - F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def level_counts(df: DataFrame, levels: list[str]) -> DataFrame:
    """Rows per value of each level separately (grouping sets, one scan)."""
    grouped = df.groupingSets([[F.col(c)] for c in levels], *levels).agg(
        F.count(F.lit(1)).alias("count"), *[F.grouping(c).alias(f"_g_{c}") for c in levels]
    )
    level = F.coalesce(*[F.when(F.col(f"_g_{c}") == 0, F.lit(c)) for c in levels])
    value = F.coalesce(*[F.when(F.col(f"_g_{c}") == 0, F.col(c).cast("string")) for c in levels])
    return grouped.select(level.alias("level"), value.alias("value"), "count")


def size_stats(files: DataFrame, size: str) -> DataFrame:
    """Smallest, largest, integer mean and total size."""
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.min(size).alias("min_size"),
        F.max(size).alias("max_size"),
        F.expr(f"sum({size}) div count({size})").alias("mean_size"),
        F.sum(size).alias("total_size"),
    )


def extension_counts(files: DataFrame, path: str) -> DataFrame:
    """Files per lower-case extension (empty without one), largest group first."""
    extension = F.lower(F.regexp_extract(F.col(path), r"\.([A-Za-z0-9]+)$", 1))
    return files.groupBy(extension.alias("extension")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "extension")


def dimension_counts(files: DataFrame, width: str, height: str, corrupt: Column) -> DataFrame:
    """Readable files per ``WxH``, largest group first, with the number of corrupt files on the row of NULL dimensions."""
    dims = F.when(~corrupt, F.concat_ws("x", width, height))
    return files.groupBy(dims.alias("dimensions")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "dimensions")


def duplicate_groups(df: DataFrame, digest: Column, key: str) -> DataFrame:
    """Members of groups of identical content: (digest, member, group_size).

    Members stay rows, one per copy, so that a group may hold any number of them;
    only digests seen more than once are joined back.
    """
    hashed = df.select(digest.alias("digest"), F.col(key).alias("member"))
    repeated = hashed.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size")).filter("group_size > 1")
    return hashed.join(repeated, "digest")


def duplicate_totals(df: DataFrame, digest: Column) -> DataFrame:
    """Number of duplicate groups and of rows inside them."""
    sizes = df.groupBy(digest.alias("digest")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return sizes.agg(
        F.count(F.lit(1)).alias("duplicate_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows")
    )
