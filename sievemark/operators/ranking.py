"""Ranks and quota cuts by seeded md5 order inside classes of any size.

``row_number`` over one class would put the class in one task. The order is by
md5, whose leading hex digits split a class into buckets that keep the order:

* :func:`class_rank` ranks inside (class, bucket) and adds the bucket offset;
* :func:`quota_cutoffs` finds the md5 value at a wanted rank by sorting only the
  buckets that hold a cut, so that selecting the first *k* rows of a class needs
  no shuffle of the class at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import BUCKET_DIGITS, md5_bucket


def on_class(df: DataFrame, table: DataFrame, *names: str, how: str = "inner") -> DataFrame:
    """Join with a class-level table on the named columns, which both sides have; NULL is a class like any other."""
    renamed = table.withColumnsRenamed({c: f"_on_{c}" for c in names})
    same = F.lit(True)
    for c in names:
        same = same & F.col(c).eqNullSafe(F.col(f"_on_{c}"))
    return df.join(renamed, same, how).drop(*[f"_on_{c}" for c in names])


def bucket_offsets(hashed: DataFrame, label: str) -> DataFrame:
    """(class, bucket) → rows in the bucket and rows of the class before it."""
    before = Window.partitionBy(label).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (
        hashed.groupBy(label, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    )


def class_rank(
    df: DataFrame, label: str, digest: Column, tie: str, digits: int = BUCKET_DIGITS, name: str = "rank"
) -> DataFrame:
    """1-based rank of every row inside its class, by ``(digest, tie)``."""
    hashed = df.withColumn("_h", digest).withColumn("_bucket", md5_bucket(F.col("_h"), digits))
    inside = Window.partitionBy(label, "_bucket").orderBy("_h", tie)
    offsets = bucket_offsets(hashed, label).drop("_n")
    return (
        on_class(hashed.withColumn("_in", F.row_number().over(inside)), offsets, label, "_bucket")
        .withColumn(name, F.col("_in") + F.col("_before"))
        .drop("_h", "_bucket", "_in", "_before")
    )


def quota_cutoffs(
    df: DataFrame, label: str, digest: Column, tie: str, cuts: DataFrame, digits: int = BUCKET_DIGITS
) -> DataFrame:
    """Per class, the ``(digest, tie)`` pair at each wanted rank.

    ``cuts`` holds one row per class and one integer column per cut; the result
    replaces each with a struct, NULL when the cut is 0. ``tie`` must be unique
    inside the class. Cuts above the class size are an error of the caller.
    """
    names = [c for c in cuts.columns if c != label]
    hashed = df.select(
        label, F.col(tie).alias("_tie"), digest.alias("_h")
    ).withColumn("_bucket", md5_bucket(F.col("_h"), digits))
    wanted = cuts.select(
        label,
        F.explode(F.array(*[F.struct(F.lit(n).alias("_cut"), F.col(n).cast("bigint").alias("_rank")) for n in names])).alias("_c"),
    ).select(label, "_c.*")
    spots = (
        on_class(bucket_offsets(hashed, label), wanted, label)
        .filter((F.col("_before") < F.col("_rank")) & (F.col("_rank") <= F.col("_before") + F.col("_n")))
        .select(label, "_bucket", "_cut", (F.col("_rank") - F.col("_before")).alias("_want"))
    )
    inside = Window.partitionBy(label, "_bucket").orderBy("_h", "_tie")
    near = on_class(hashed, spots.select(label, "_bucket").distinct(), label, "_bucket", how="left_semi")
    edges = (
        on_class(near.withColumn("_in", F.row_number().over(inside)), spots, label, "_bucket")
        .filter(F.col("_in") == F.col("_want"))
        .groupBy(label)
        .pivot("_cut", names)
        .agg(F.first(F.struct("_h", "_tie")))
    )
    return edges


def within(cut: Column, digest: Column, tie: Column) -> Column:
    """True when a row lies at or before a cut of :func:`quota_cutoffs`."""
    return F.coalesce(F.struct(digest.alias("_h"), tie.alias("_tie")) <= cut, F.lit(False))


def first_k_per_class(
    df: DataFrame, label: str, digest: Column, tie: str, takes: DataFrame, digits: int = BUCKET_DIGITS
) -> DataFrame:
    """The first ``take`` rows of each class in md5 order; ``takes`` is (class, take)."""
    cuts = quota_cutoffs(df, label, digest, tie, takes.select(label, "take"), digits)
    return (
        on_class(df, cuts.withColumnRenamed("take", "_take"), label)
        .filter(within(F.col("_take"), digest, F.col(tie)))
        .select(*df.columns)
    )


def top_n_per_class(df: DataFrame, label: str, n: int, *order: Column | str, name: str = "rank") -> DataFrame:
    """First ``n`` rows per class for a small fixed ``n``.

    The rank filter becomes a group limit before the shuffle, so a huge class
    sends only ``n`` rows per input task.
    """
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(label).orderBy(*order)))
    return ranked.filter(F.col(name) <= n)
