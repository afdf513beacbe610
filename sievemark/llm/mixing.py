"""Mixing sources to target weights: Efraimidis-Spirakis order, whole epochs before a part of one.

Each document gets an exponential key ``-ln(u) / weight`` (u from its id), so that the
order by key is a weighted sample without replacement at every length. A source whose
target is above its size is taken whole first; the rest is the start of that order.
Column functions only. Rows with NULL source form a source of their own, sorted last;
NULL and empty texts have size 0, take part and count 0. Rows that repeat an id share
u; those of one weight follow each other, by size and text. A NULL id takes u from the text. Columns besides those named are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, balanced_buckets, prefix_sum, row_unit, written

SOURCE_WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
SEED = 17
TYPICAL_WORD = 6.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def quality_weight(chars: Column, words: Column) -> Column:
    """In (0.05, 1]: near 1 for words of about six characters, lower for runs of symbols or fragments."""
    mean = F.when(words > 0, chars / words).otherwise(F.lit(0.0))
    return F.greatest(F.lit(0.05), 1.0 / (1.0 + F.abs(mean - TYPICAL_WORD) / TYPICAL_WORD))


def key_bucket(key: Column, rows: int) -> Column:
    """Order-preserving bucket of an exponential key on a logarithmic scale.

    A weight shifts the logarithm of a key and leaves its spread, so that no bucket holds more
    than about sqrt(rows) / e of ``rows`` keys, whatever their weights are.
    """
    return F.floor(F.log(key) * balanced_buckets(rows))


def source_targets(sizes: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple = SOURCE_WEIGHTS) -> DataFrame:
    """(source, source_size) → with ``target``: ``share`` of all sizes by weight, at most ``most`` times the size.

    What a full source cannot take is shared again by weight. Sources in the order of
    ``most * size / weight`` fill up one after the other. The level left for the others rises
    as long as sources fill and falls after that, so its maximum is the one that holds. One
    row per source; no iteration.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    weighed = sizes.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int")))
    capped = weighed.withColumn("_cap", F.col("source_size") * F.lit(most)).withColumn("_ratio", F.col("_cap") / F.col("_w"))
    filling = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("_cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        / F.sum("_w").over(filling.rowsBetween(0, Window.unboundedFollowing))
    )
    levelled = capped.withColumn("_level", level)
    target = F.least(F.col("_cap"), F.max("_level").over(everything) * F.col("_w"))
    return levelled.withColumn("target", target).select("source", "source_size", "target")


def mix(
    docs: DataFrame, *, weight: Column | None = None, share: float = SHARE, most: float = MOST,
    source_weights: tuple = SOURCE_WEIGHTS, seed: int = SEED, keep: list[str] | None = None,
) -> DataFrame:
    """doc_id, source, size, source_size, target, times, taken: how often the mix takes each row.

    ``weight`` is a column over ``docs`` in (0, 1]; NULL or lower values count as 0.05. ``keep`` names further
    columns of ``docs`` to carry (they go through one shuffle). A row enters the last, partial epoch
    when the middle of its words lies below what is left of the target, so that a source
    misses its target by half a document at most.
    """
    words = word_count(F.col("text"))
    weight = weight if weight is not None else quality_weight(F.coalesce(F.length("text"), F.lit(0)), words)
    key = -F.log(row_unit(seed, F.col("doc_id"), F.col("text"))) / F.greatest(F.coalesce(weight.cast("double"), F.lit(0.05)), F.lit(0.05))
    extra = [F.struct(*[F.col(c) for c in keep]).alias("_kept")] if keep else []
    base = written(
        docs.select("doc_id", "source", words.alias("size"), key.alias("_key"), F.xxhash64("text").alias("_tie"), *extra), "mix"
    )
    base = base.withColumn("_bucket", key_bucket(F.col("_key"), base.count()))
    order = ["_key", "doc_id", "size", "_tie"]
    placed = prefix_sum(base, ["source"], "_bucket", order, "size", "_before")
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, share, most, source_weights).withColumnRenamed("source", "_source")
    joined = placed.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - F.col("_epochs") * F.col("source_size")
    partly = (2 * F.col("_before") + F.col("size") < 2 * rest).cast("bigint")
    return (
        joined.withColumn("_epochs", epochs.cast("bigint")).withColumn("times", F.col("_epochs") + partly)
        .select("doc_id", "source", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"), *(["_kept"] if keep else []))
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: the rows of ``docs``, each as often as :func:`mix` takes it."""
    chosen = mix(docs, keep=docs.columns, **options).filter(F.col("times") > 0)
    return chosen.select("_kept", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("_kept.*")
