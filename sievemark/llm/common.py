"""What several operators of this subpackage share: written intermediate tables, prefix sums, words."""

from __future__ import annotations

import hashlib
from math import isqrt

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import workspace

#: A word is a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends here, any executor can be lost."""
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")


def unit_hash(seed: int, *parts: Column) -> Column:
    """Uniform in (0, 1) from 52 bits of md5 over ``seed:part1:…``; NULL parts are left out."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def row_unit(seed: int, id: Column, text: Column) -> Column:
    """:func:`unit_hash` of the id; rows without an id are told apart by their text, so that they do not share a value."""
    return unit_hash(seed, F.coalesce(id.cast("string"), F.concat(F.lit("text:"), F.xxhash64(text).cast("string"))))


def balanced_buckets(rows: int) -> int:
    """About sqrt(rows) buckets of sqrt(rows) rows: neither a bucket nor the bucket table gets large."""
    return max(1, isqrt(max(rows, 0)))


def prefix_sum(df: DataFrame, group: list[str], bucket: str, order: list, value: str, name: str) -> DataFrame:
    """Sum of ``value`` over the rows of the group that come earlier, by ``(bucket, order)``.

    Rows are sorted inside (group, bucket) only; one row per bucket carries the sum of
    the buckets before it. A group that holds most rows is spread over its buckets.
    NULL is a group of its own.
    """
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    renamed = {g: f"_g{i}" for i, g in enumerate(group)}
    sums = df.groupBy(*[F.col(g).alias(a) for g, a in renamed.items()], F.col(bucket).alias("_b")).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*renamed.values()).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_offset", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    same = F.col(bucket) == F.col("_b")
    for g, a in renamed.items():
        same = same & F.col(g).eqNullSafe(F.col(a))
    local = df.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (
        local.join(offsets, same).withColumn(name, F.col("_local") + F.col("_offset"))
        .drop("_local", "_offset", "_b", *renamed.values())
    )


class WordHashes(dict):
    """Word (bytes) → 64-bit blake2b value, remembered; cleared when it holds ``limit`` words."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes, hashed: bytes | None = None) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word if hashed is None else hashed, digest_size=8).digest(), "little")
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, elementwise (fixed values: the splitmix64 multipliers)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
