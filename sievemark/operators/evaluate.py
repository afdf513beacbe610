"""Evaluation of predictions: confusion, per-class report, macro F1, parity, joins with truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors
from .ranking import on_class
from .small import one_value


def accuracy(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.avg((F.col("y_true") == F.col("y_pred")).cast("double")).alias("accuracy"))


def confusion_counts(pairs: DataFrame) -> DataFrame:
    """(y_true, y_pred, n): at most classes² rows; everything below starts from it."""
    return pairs.groupBy("y_true", "y_pred").agg(F.count(F.lit(1)).alias("n"))


def label_counts(confusion: DataFrame) -> DataFrame:
    """tp, predicted and support per label over the union of true and predicted labels."""
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("y_true").alias("label"), hit.alias("tp"), zero.alias("predicted"), F.col("n").alias("support")),
        F.struct(F.col("y_pred").alias("label"), zero.alias("tp"), F.col("n").alias("predicted"), zero.alias("support")),
    )
    return (
        confusion.select(F.explode(sides).alias("s")).select("s.*").groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "predicted", "support")])
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def per_label(confusion: DataFrame) -> DataFrame:
    """precision, recall, f1 (0 when undefined) and support per label."""
    counts = label_counts(confusion)
    return counts.select(
        "label",
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(F.lit(2.0) * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
    )


def f1_macro(pairs: DataFrame) -> DataFrame:
    """Unweighted mean of per-label F1."""
    return per_label(confusion_counts(pairs)).agg(F.avg("f1").alias("f1_macro"))


def class_report(pairs: DataFrame) -> DataFrame:
    """Rows per label plus ``accuracy``, ``macro avg`` and ``weighted avg``."""
    confusion = confusion_counts(pairs)
    labels = per_label(confusion)
    scores = ("precision", "recall", "f1")
    rows = labels.select(F.col("label").cast("string").alias("label"), *scores, "support")
    macro = labels.agg(
        *[F.avg(c).alias(c) for c in scores], F.sum("support").alias("support")
    ).select(F.lit("macro avg").alias("label"), "*")
    weighted = labels.agg(
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in scores],
        F.sum("support").alias("support"),
    ).select(F.lit("weighted avg").alias("label"), "*")
    hits = F.sum(F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)) / F.sum("n")
    overall = confusion.agg(
        *[hits.alias(c) for c in scores], F.sum("n").alias("support")
    ).select(F.lit("accuracy").alias("label"), "*")
    return rows.unionByName(overall).unionByName(macro).unionByName(weighted)


# Divisor of each normalisation of a confusion matrix.
NORMALISATIONS = {"true": "_row", "pred": "_column", "all": "_all", "none": None}


def confusion_grid(pairs: DataFrame) -> DataFrame:
    """(y_true, y_pred, n, _row, _column, _all) over the full label × label grid, from one count of the pairs.

    Pairs with a NULL label are not part of the matrix. The grid has a row for each pair of
    labels; totals are windows over it, so that the pairs are not counted again.
    """
    confusion = confusion_counts(pairs.filter(F.col("y_true").isNotNull() & F.col("y_pred").isNotNull()))
    labels = confusion.select(F.explode(F.array("y_true", "y_pred")).alias("label")).distinct()
    every = labels.agg(F.sort_array(F.collect_list("label")).alias("labels")).scalar()
    grid = labels.select(F.col("label").alias("y_true"), F.explode(every).alias("y_pred"))
    full = grid.join(confusion, ["y_true", "y_pred"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rows = full.withColumn("_row", F.sum("n").over(Window.partitionBy("y_true")))
    whole = rows.groupBy("y_true").agg(F.max("_row").alias("_row")).agg(F.sum("_row").alias("_all"))
    return rows.withColumn("_column", F.sum("n").over(Window.partitionBy("y_pred"))).withColumn("_all", one_value(whole, "_all"))


def normalised(grid: DataFrame, kinds: list[str]) -> DataFrame:
    """(kind, y_true, y_pred, n, value) for each normalisation; an empty row or column gives 0."""
    def value(kind: str) -> Column:
        by = NORMALISATIONS[kind]
        return F.col("n").cast("double") if by is None else _ratio(F.col("n"), F.col(by))

    each = F.array(*[F.struct(F.lit(k).alias("kind"), value(k).alias("value")) for k in kinds])
    return grid.select("y_true", "y_pred", "n", F.explode(each).alias("e")).select("e.kind", "y_true", "y_pred", "n", "e.value")


def confusion_matrix(pairs: DataFrame, normalize: str | None = "true") -> DataFrame:
    """(y_true, y_pred, n, value) over the full label × label grid.

    ``normalize`` is ``true`` (row), ``pred`` (column), ``all`` or None; an empty row
    or column gives 0. Works on the counts, at most one row per label pair.
    """
    kind = "none" if normalize is None else normalize
    if kind not in NORMALISATIONS:
        raise ValueError(f"unknown normalisation {normalize!r}")
    return normalised(confusion_grid(pairs), [kind]).drop("kind")


def class_errors(pairs: DataFrame, label) -> DataFrame:
    """Wrong predictions of one true class."""
    return pairs.filter((F.col("y_true") == label) & (F.col("y_pred") != F.col("y_true")))


def label_index(labels: DataFrame, column: str) -> DataFrame:
    """Distinct sorted labels → dense 0-based index; one row per class."""
    return labels.select(column).distinct().filter(F.col(column).isNotNull()).withColumn(
        "label_idx", F.row_number().over(Window.partitionBy().orderBy(column)) - 1
    )


def check_class_count(index: DataFrame, expected: int) -> DataFrame:
    """One row telling whether the number of classes is the expected one."""
    return index.agg(F.count(F.lit(1)).alias("classes")).withColumn(
        "matches", F.col("classes") == F.lit(expected)
    )


def with_label_index(rows: DataFrame, index: DataFrame, column: str) -> DataFrame:
    """Map the label of every row through a shared index; a row without a label, or with an unknown one, keeps NULL."""
    return on_class(rows, index, column, how="left")


def remap_labels(pairs: DataFrame, mapping: DataFrame, source: str, target: str) -> DataFrame:
    """Replace true and predicted label by the group the mapping gives; a label it does not know becomes NULL."""
    small = mapping.select(source, target)
    true_side = small.select(F.col(source).alias("y_true"), F.col(target).alias("_t"))
    pred_side = small.select(F.col(source).alias("y_pred"), F.col(target).alias("_p"))
    return (
        on_class(on_class(pairs, true_side, "y_true", how="left"), pred_side, "y_pred", how="left")
        .drop("y_true", "y_pred").withColumnsRenamed({"_t": "y_true", "_p": "y_pred"})
    )


def chained_mapping(classes: DataFrame, class_key: str, groups: DataFrame, group_key: str, target: str) -> DataFrame:
    """class → group → group index as one mapping (two joins of class-level tables)."""
    return classes.join(groups.select(group_key, target), group_key).select(class_key, target)


def truth_report(predictions: DataFrame, truth: DataFrame, key: str) -> DataFrame:
    """processed, correct and skipped (prediction without truth) in one row."""
    joined = predictions.join(truth, key, "left")
    return joined.agg(
        F.count("y_true").alias("processed"),
        F.count_if(F.col("y_true") == F.col("y_pred")).alias("correct"),
        F.count_if(F.col("y_true").isNull()).alias("skipped"),
    )


def skipped_items(predictions: DataFrame, truth: DataFrame, key: str) -> DataFrame:
    return predictions.join(truth.select(key), key, "left_anti").select(key)


def parity(left: DataFrame, right: DataFrame, key: str, eps: float = 1e-6) -> DataFrame:
    """Per item ``OK`` when both sides name the same class within ``eps``; a missing side is FAIL."""
    a = left.select(key, F.col("predicted_class").alias("left_class"), F.col("confidence").alias("left_confidence"))
    b = right.select(key, F.col("predicted_class").alias("right_class"), F.col("confidence").alias("right_confidence"))
    delta = F.abs(F.col("left_confidence") - F.col("right_confidence"))
    ok = F.coalesce((F.col("left_class") == F.col("right_class")) & (delta <= eps), F.lit(False))
    return a.join(b, key, "full_outer").withColumn("delta", delta).withColumn(
        "status", F.when(ok, "OK").otherwise("FAIL")
    )


def parity_totals(compared: DataFrame) -> DataFrame:
    return compared.agg(
        F.count_if(F.col("status") == "OK").alias("ok"), F.count_if(F.col("status") == "FAIL").alias("fail")
    )


def output_parity(left: DataFrame, right: DataFrame, key: str, vec: str, tolerance: float = 1e-4) -> DataFrame:
    """Largest and mean per-sample maximum difference of two outputs, and whether all agree."""
    joined = left.select(key, F.col(vec).alias("a")).join(right.select(key, F.col(vec).alias("b")), key)
    return joined.select(vectors.max_abs_diff(F.col("a"), F.col("b")).alias("d")).agg(
        F.max("d").alias("max_abs_diff"),
        F.avg("d").alias("mean_abs_diff"),
        F.bool_and(F.col("d") < tolerance).alias("all_match"),
    )


def release_gate(pairs: DataFrame, minimum_f1: float) -> DataFrame:
    """Macro F1 against the release threshold."""
    return f1_macro(pairs).withColumn("released", F.col("f1_macro") >= minimum_f1)
