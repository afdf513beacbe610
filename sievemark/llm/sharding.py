"""Proportional stratified interleaving: every shard holds the mixture of the whole.

Rows are ranked in seeded random order within their source; row ``r`` of ``n`` has the
fractional rank ``(2r - 1) / 2n``. Sorted by it, the sources interleave in proportion, and
the order is cut into shards whose counts differ by one at most (law ``rows``).
NULL is a source of its own, NULL text has no bytes, repeated rows get neighbouring
ranks, rows without an id are placed by their text, columns besides those named are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import balanced_buckets, prefix_sum, row_unit, written

SHARDS = 24
SEED = 29
ROW_BYTES = 8


def shards(docs: DataFrame, *, n_shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, text_crc32, shard, slot for every row.

    Ranks and positions come from sorted buckets with offsets, so that neither a source
    nor the whole table is sorted in one task.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = written(
        docs.select(
            "doc_id", "source", (F.octet_length(text) + F.lit(ROW_BYTES)).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), row_unit(seed, F.col("doc_id"), F.col("text")).alias("_u"), F.lit(1).cast("bigint").alias("_one"),
        ), "shards",
    )
    rows = base.count()
    buckets = balanced_buckets(rows)
    ties = ["doc_id", "text_crc32", "size"]
    base = base.withColumn("_bucket", F.floor(F.col("_u") * buckets))
    ranked = prefix_sum(base, ["source"], "_bucket", ["_u", *ties], "_one", "_rank")
    sizes = base.groupBy(F.col("source").alias("_source")).agg(F.count(F.lit(1)).alias("_n"))
    placed = (
        ranked.join(sizes, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_fraction", (2 * F.col("_rank") + 1).cast("double") / (2 * F.col("_n")).cast("double"))
        .withColumn("_slice", F.floor(F.col("_fraction") * buckets))
        .select("doc_id", "source", "size", "text_crc32", "_u", "_one", "_fraction", "_slice")
    )
    order = ["_fraction", F.col("source").asc_nulls_last(), "_u", *ties]
    position = prefix_sum(placed, [], "_slice", order, "_one", "_position")
    total, count = F.lit(rows).cast("bigint"), F.lit(n_shards).cast("bigint")
    shard = F.expr("_position * _count div greatest(_total, 1)")
    first = F.expr("(_shard * _total + _count - 1) div _count")
    return (
        position.withColumn("_total", total).withColumn("_count", count).withColumn("_shard", shard)
        .select("doc_id", "source", "size", "text_crc32", F.col("_shard").cast("int").alias("shard"), (F.col("_position") - first).alias("slot"))
    )
