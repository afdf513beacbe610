"""Curation of labelled observations: filters, deduplication, conflicts, funnel.

Column roles are passed by name; defaults are the names of the observation table:
``ord`` (arrival order), ``item`` (content key), ``species`` (label), ``confidence``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Fixed value: the minimum identification confidence of the default policy.
MIN_CONFIDENCE = 92


def nan_to_null(column: Column) -> Column:
    """Spark orders NaN above every number, so NaN must not reach a threshold."""
    return F.nullif(column, F.lit(float("nan")))


def members(observations: DataFrame, reference: DataFrame, column: str = "species") -> DataFrame:
    """Rows whose label is in the reference set."""
    wanted = reference.select(column).distinct()
    return observations.join(wanted, column, "left_semi")


def confident(observations: DataFrame, minimum: float = MIN_CONFIDENCE, column: str = "confidence") -> DataFrame:
    """Rows at or above the threshold; missing confidence is dropped."""
    return observations.filter(nan_to_null(F.col(column).cast("double")) >= minimum)


def keep_first(rows: DataFrame, key: str = "item", order: str = "ord") -> DataFrame:
    """First row per key in arrival order, as an aggregation with map-side combine.

    A key that holds a large part of the rows is reduced before the shuffle.
    """
    others = [c for c in rows.columns if c != key]
    first = rows.groupBy(key).agg(F.min_by(F.struct(*others), F.col(order)).alias("_first"))
    return first.select(key, "_first.*").select(*rows.columns)


def conflicting_items(observations: DataFrame, key: str = "item", label: str = "species") -> DataFrame:
    """Items carrying more than one label; NULL labels do not count.

    The extremes of the labels' 64-bit hashes decide it: no distinct set per item, numeric buffers.
    """
    hashed = F.when(F.col(label).isNotNull(), F.xxhash64(label))
    spread = observations.groupBy(key).agg(F.min(hashed).alias("_lo"), F.max(hashed).alias("_hi"))
    return spread.filter(F.col("_lo") < F.col("_hi")).select(key)


def without_conflicts(
    rows: DataFrame, observations: DataFrame, key: str = "item", label: str = "species"
) -> DataFrame:
    """Drop items that the unfiltered observations label in more than one way."""
    return rows.join(conflicting_items(observations, key, label), key, "left_anti")


def existing(rows: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Rows whose file is present."""
    return rows.join(files.select(key), key, "left_semi")


def missing(rows: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Rows whose file is absent."""
    return rows.join(files.select(key), key, "left_anti")


def manifest(rows: DataFrame, key: str = "item", label: str = "species") -> DataFrame:
    """(item, species) sorted by species then item."""
    return rows.select(F.col(key).alias("item"), F.col(label).alias("species")).orderBy("species", "item")


def item_states(
    observations: DataFrame,
    reference: DataFrame,
    files: DataFrame,
    file_key: str,
    minimum: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Everything the funnel needs in one row per item and one shuffle on the item.

    ``n_all``, ``n_member``, ``n_pass`` count rows; ``ord``/``species`` are those of
    the first passing row; ``conflict`` and ``present`` are flags. An item that
    holds a large part of the table is combined before the shuffle. Labels go through the
    aggregation as 64-bit hashes, so that with a numeric ``ord`` and ``file_key`` its buffers are
    numbers and it needs no sort; the name comes back from the table of labels.
    """
    wanted = reference.select("species").distinct().withColumn("_member", F.lit(True))
    member = F.coalesce(F.col("_member"), F.lit(False))
    passing = member & F.coalesce(nan_to_null(F.col("confidence").cast("double")) >= minimum, F.lit(False))
    flagged = observations.join(wanted, "species", "left").select(
        "item", F.when(F.col("species").isNotNull(), F.xxhash64("species")).alias("_label"), "ord",
        F.col(file_key).alias("_file"), member.alias("_m"), passing.alias("_p")
    )
    kept = F.when(F.col("_p"), F.col("ord"))
    items = flagged.groupBy("item").agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count_if("_m").alias("n_member"),
        F.count_if("_p").alias("n_pass"),
        F.min(kept).alias("ord"), F.min_by("_label", kept).alias("_label"), F.min_by("_file", kept).alias("_file"),
        (F.min("_label") < F.max("_label")).alias("conflict"),
    )
    names = observations.select("species").distinct().select(F.xxhash64("species").alias("_label"), "species")
    present = files.select(F.col(file_key).alias("_file")).distinct().withColumn("_present", F.lit(True))
    return (
        items.select(
            "item", "n_all", "n_member", "n_pass", F.coalesce("conflict", F.lit(False)).alias("conflict"), "ord", "_label", "_file"
        )
        .join(names, "_label", "left")
        .join(present, "_file", "left")
        .withColumn("present", F.coalesce("_present", F.lit(False)))
        .drop("_file", "_label", "_present")
    )


def curated(states: DataFrame) -> DataFrame:
    """Manifest rows that survive every step of :func:`item_states`."""
    return states.filter((F.col("n_pass") > 0) & ~F.col("conflict") & F.col("present")).select("item", "species")


def funnel_counts(states: DataFrame) -> DataFrame:
    """One row with the count after each step."""
    kept = F.col("n_pass") > 0
    clean = kept & ~F.col("conflict")
    return states.agg(
        F.coalesce(F.sum("n_all"), F.lit(0)).alias("all_rows"),
        F.coalesce(F.sum("n_member"), F.lit(0)).alias("member"),
        F.coalesce(F.sum("n_pass"), F.lit(0)).alias("confident"),
        F.count_if(kept).alias("deduplicated"),
        F.count_if(clean).alias("unconflicted"),
        F.count_if(clean & F.col("present")).alias("present"),
    )


def funnel(counts: DataFrame) -> DataFrame:
    """Ordered step report (step, name, count, removed) from :func:`funnel_counts`."""
    names = counts.columns
    steps = [
        F.struct(
            F.lit(i).cast("bigint").alias("step"),
            F.lit(name).alias("name"),
            F.col(name).alias("count"),
            (F.col(names[i - 1]) - F.col(name) if i else F.lit(0).cast("bigint")).alias("removed"),
        )
        for i, name in enumerate(names)
    ]
    return counts.select(F.explode(F.array(*steps)).alias("s")).select("s.*")


# Reason names of the exclusion report, by the step that removes the rows.
STEP_REASONS = {
    "member": "not_in_reference",
    "confident": "low_confidence",
    "deduplicated": "duplicate_item",
    "unconflicted": "label_conflict",
    "present": "missing_file",
}


def exclusion_reasons(counts: DataFrame) -> DataFrame:
    """Rows lost per reason, with a ``total`` row; the reasons add up to the total."""
    report = funnel(counts).filter("step > 0")
    names = F.create_map(*[F.lit(x) for pair in STEP_REASONS.items() for x in pair])
    reasons = report.select(names[F.col("name")].alias("reason"), F.col("removed").alias("count"))
    total = counts.select(F.lit("total").alias("reason"), (F.col("all_rows") - F.col("present")).alias("count"))
    return reasons.unionByName(total)
