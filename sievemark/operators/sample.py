"""Reproducible samples: per class, round robin, stratified, rebalanced, weighted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash60, seeded_md5
from .ranking import class_rank, first_k_per_class, on_class, top_n_per_class

SEED = 42
DRAWS_PER_COPY = 10_000


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def sample_per_class(df: DataFrame, label: str, key: str, n: int, seed: int = SEED) -> DataFrame:
    """``n`` random rows of every class, by one md5 cut per class at any ``n``."""
    takes = class_sizes(df, label).select(label, F.least(F.col("n"), F.lit(n)).alias("take"))
    return first_k_per_class(df, label, seeded_md5(seed, F.col(key)), key, takes)


def first_per_class(df: DataFrame, label: str, order: str, n: int) -> DataFrame:
    """First ``n`` rows of every class in the given order, with ``rank``."""
    return top_n_per_class(df, label, n, order)


def round_robin(df: DataFrame, label: str, key: str, n: int, seed: int = SEED) -> DataFrame:
    """``n`` rows cycling over the classes, random inside a class, without repeats."""
    digest = seeded_md5(seed, F.col(key))
    ranked = class_rank(sample_per_class(df, label, key, n, seed), label, digest, key)
    return ranked.orderBy("rank", seeded_md5(seed, F.col(label)), label).limit(n)


def stratified_takes(sizes: DataFrame, total: int) -> DataFrame:
    """(class, n, take): proportional, at least half of an even share, at most the class."""
    whole = Window.partitionBy()
    floor_take = F.greatest(F.lit(1), F.floor(F.floor(F.lit(total) / F.count(F.lit(1)).over(whole)) / 2))
    proportional = F.bround(F.col("n") / F.sum("n").over(whole) * total)
    return sizes.withColumn("take", F.least(F.greatest(floor_take, proportional), F.col("n")).cast("bigint"))


def stratified_sample(df: DataFrame, label: str, key: str, total: int, seed: int = SEED) -> DataFrame:
    """About ``total`` rows, proportional to class size with a floor for rare classes."""
    takes = stratified_takes(class_sizes(df, label), total)
    return first_k_per_class(df, label, seeded_md5(seed, F.col(key)), key, takes)


def rebalance(
    df: DataFrame, label: str, key: str, high: int = 900, low: int = 850, seed: int = SEED
) -> DataFrame:
    """Per class: more than ``high`` rows are sampled to ``high``; fewer than ``low`` are
    drawn ``low`` times with replacement; others stay. ``draw`` numbers the copies.

    Draw ``i`` of a class takes rank ``hash(seed:class:i) mod n + 1``, so the result
    does not depend on the partitioning. Only classes below ``low`` rows are ranked.
    """
    sizes = class_sizes(df, label)
    digest = seeded_md5(seed, F.col(key))
    out = [*df.columns, "draw"]
    keep = on_class(df, sizes.filter(F.col("n").between(low, high)).select(label), label, how="left_semi")
    down = first_k_per_class(df, label, digest, key, sizes.filter(F.col("n") > high).select(label, F.lit(high).alias("take")))
    small = sizes.filter(F.col("n") < low)
    ranked = on_class(df, small.select(label), label, how="left_semi").withColumn(
        "_rank", F.row_number().over(Window.partitionBy(label).orderBy(digest, key))
    )
    draws = small.select(label, "n", F.explode(F.sequence(F.lit(1), F.lit(low))).alias("draw"))
    pick = F.pmod(hash60(F.concat_ws(":", F.lit(str(seed)), F.col(label), F.col("draw").cast("string"))), F.col("n"))
    drawn = draws.select(label, F.col("draw").cast("bigint").alias("draw"), (pick + 1).alias("_rank"))
    up = on_class(ranked, drawn, label, "_rank")
    none = F.lit(0).cast("bigint").alias("draw")
    return keep.select(*df.columns, none).unionByName(down.select(*df.columns, none)).unionByName(up.select(*out))


def number_copies(df: DataFrame, key: str, order: str, name: str = "copy") -> DataFrame:
    """0 for the first occurrence of a key, 1, 2, … for the repeats, in the given order.

    A key may repeat without bound, so the order column is cut into ranges: rows are
    numbered inside (key, range) and the counts of earlier ranges are added.
    """
    span = F.lit(100_000)
    chunked = df.withColumn("_chunk", F.floor(F.col(order) / span))
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        chunked.groupBy(key, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    )
    inside = Window.partitionBy(key, "_chunk").orderBy(order)
    return (
        chunked.withColumn("_in", F.row_number().over(inside) - 1)
        .join(offsets, [key, "_chunk"])
        .withColumn(name, F.col("_in") + F.col("_off"))
        .drop("_chunk", "_in", "_off")
    )


def suffix_copies(df: DataFrame, key: str, order: str, extension: str = ".jpg", name: str = "unique_name") -> DataFrame:
    """``x.jpg, x_1.jpg, x_2.jpg`` for repeats of ``x.jpg``."""
    stem = F.replace(F.col(key), F.lit(extension), F.lit(""))
    suffixed = F.concat(stem, F.lit("_"), F.col("copy").cast("string"), F.lit(extension))
    return number_copies(df, key, order).withColumn(
        name, F.when(F.col("copy") == 0, F.col(key)).otherwise(suffixed)
    ).drop("copy")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Row weight 1 / class count; NULL is a class."""
    sizes = class_sizes(df, label)
    return on_class(df, sizes, label).withColumn("weight", F.lit(1.0) / F.col("n")).drop("n")


def weighted_sample(df: DataFrame, label: str, key: str, draws: int | None = None, seed: int = SEED) -> DataFrame:
    """Draws with replacement, every class equally likely; adds ``draw``.

    Weight 1/class-count gives each class the same mass, so a draw picks a class and
    then a rank inside it, both by hash of the draw number. A rare class is drawn
    often per row: its rows are copied over ``_salt`` so that no join key carries
    more than about ``DRAWS_PER_COPY`` draws.
    """
    by_label = Window.partitionBy().orderBy(label)
    classes = (
        class_sizes(df, label)
        .withColumn("_idx", F.row_number().over(by_label) - 1)
        .withColumn("_k", F.count(F.lit(1)).over(Window.partitionBy()))
        .withColumn("_all", F.sum("n").over(Window.partitionBy()))
    )
    head = classes.select("_k", "_all").first()
    if head is None:
        return df.withColumn("draw", F.lit(0).cast("bigint")).limit(0)
    total = head["_all"] if draws is None else draws
    per_row = F.lit(total) / head["_k"] / F.col("n")
    classes = classes.withColumn("_salts", F.ceil(per_row / DRAWS_PER_COPY).cast("bigint"))
    number = F.col("id").cast("string")
    picked = (
        df.sparkSession.range(total)
        .withColumn("_idx", F.pmod(hash60(F.concat(F.lit(f"{seed}:c:"), number)), F.lit(head["_k"])).cast("int"))
        .join(classes, "_idx")
        .select(
            F.col("id").alias("draw"),
            label,
            (F.pmod(hash60(F.concat(F.lit(f"{seed}:r:"), number)), F.col("n")) + 1).alias("_rank"),
            F.pmod(F.col("id"), F.col("_salts")).alias("_salt"),
        )
    )
    rows = on_class(class_rank(df, label, seeded_md5(seed, F.col(key)), key, name="_rank"), classes.select(label, "_salts"), label)
    rows = rows.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_salts") - 1))).drop("_salts")
    return on_class(rows, picked, label, "_rank", "_salt").select(*df.columns, "draw")
