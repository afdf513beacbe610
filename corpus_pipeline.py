"""Corpus pipeline: language ID, near-duplicates, benchmark decontamination, mixing, sharding.

Each stage takes all that its predecessor kept, written as Parquet and read again. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.llm import decontaminate, langid, mixing, neardup, sharding
from sievemark.llm.common import documents, written

#: A document goes when no language reaches this mean probability, or when it has no letter.
LEAST_LANG_SCORE = 0.3

#: Rows without an id take part in the near-duplicate stage under one from their text, above this.
NULL_IDS = 1 << 61


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; rows without text or letters go."""
    said = langid.predict(docs.select(F.struct(*docs.columns).alias("row"), "text"), langid.fit(docs))
    return said.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANG_SCORE)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity of 0.8 or more).

    Of rows that repeat the id of a kept document within its group, one stays. Rows whose id is
    NULL join groups too and come after all others: one stays if no row of its group has an id,
    and equal texts are one document.
    """
    number = F.coalesce(F.col("doc_id"), F.lit(NULL_IDS) + F.pmod(F.xxhash64("text"), F.lit(NULL_IDS)))
    found = neardup.near_duplicates(docs.select(number.alias("doc_id"), "text")).filter("kept")
    chosen = found.groupBy("component", "doc_id").agg(F.min("text_hash").alias("_hash")).select(F.col("doc_id").alias("_id"), "_hash")
    keyed = docs.select(F.struct(*docs.columns).alias("row"), number.alias("_number"), F.xxhash64("text").alias("_text"))
    linked = keyed.join(chosen, (F.col("_number") == F.col("_id")) & (F.col("_text") == F.col("_hash")), "left_semi")
    return linked.dropDuplicates(["_number", "_text"]).select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    marked = decontaminate.matched(docs.select(F.struct(*docs.columns).alias("row"), "text"), benchmark)
    return marked.filter(F.size("hits") == 0).select("row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: rows as often as the targets of their sources take them."""
    return mixing.mixed_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, text_crc32, shard and slot of every row of the mixture."""
    return sharding.shards(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("mixture", mixture), ("sharding", shard),
]

#: Two stages have no SQL form; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder before the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
