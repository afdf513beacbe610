"""NULL is a class of its own in splits, samples and joins; no row is lost."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from sievemark.operators import evaluate, ranking, sample, split

CLASSES = ["a"] * 60 + ["b"] * 30 + [None] * 40


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, c, f"g{i // 2}") for i, c in enumerate(CLASSES)], "id long, label string, grp string")


def counts(df, *columns):
    return Counter(tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect())


def test_stratified_split(rows):
    got = counts(split.stratified_split(rows, "label", "id"), "label", "split")
    assert sum(got.values()) == len(CLASSES) and sum(n for (c, _), n in got.items() if c is None) == 40
    assert {s for c, s in got if c is None} == {"train", "val", "test"} and got[None, "train"] == 28


def test_group_split(rows):
    done = split.group_split(rows, "label", "grp")
    got = counts(done, "label", "split")
    assert sum(got.values()) == len(CLASSES) and (got[None, "train"], got[None, "val"], got[None, "test"]) == (28, 6, 6)
    assert split.leaking_groups(done, "grp").count() == 0


def test_samples(rows):
    assert counts(sample.sample_per_class(rows, "label", "id", 7), "label") == {"a": 7, "b": 7, None: 7}
    assert counts(sample.round_robin(rows, "label", "id", 9), "label") == {"a": 3, "b": 3, None: 3}
    assert counts(sample.stratified_sample(rows, "label", "id", 26), "label") == {"a": 12, "b": 6, None: 8}
    assert counts(sample.rebalance(rows, "label", "id", high=50, low=35), "label") == {"a": 50, "b": 35, None: 40}
    weights = {r.label: r.weight for r in sample.class_weights(rows, "label").collect()}
    assert weights == {"a": 1 / 60, "b": 1 / 30, None: 1 / 40} and sample.class_weights(rows, "label").count() == len(CLASSES)
    drawn = counts(sample.weighted_sample(rows, "label", "id", 300), "label")
    assert sum(drawn.values()) == 300 and min(drawn.values()) > 60 and None in drawn


def test_ranks(rows):
    ranked = ranking.class_rank(rows, "label", F.md5(F.col("id").cast("string")), "id").filter("label IS NULL")
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 41))


def test_label_index_and_remap(spark, rows):
    index = evaluate.label_index(rows, "label")
    got = counts(evaluate.with_label_index(rows, index, "label"), "label", "label_idx")
    assert got == {("a", 0): 60, ("b", 1): 30, (None, None): 40}
    pairs = spark.createDataFrame([(1, "a", "b"), (2, "a", "z"), (3, None, "a")], "id long, y_true string, y_pred string")
    mapping = spark.createDataFrame([("a", "x"), ("b", "y")], "cls string, grp string")
    done = {r.id: (r.y_true, r.y_pred) for r in evaluate.remap_labels(pairs, mapping, "cls", "grp").collect()}
    assert done == {1: ("x", "y"), 2: ("x", None), 3: (None, "x")}


def test_confusion_matrix(spark):
    pairs = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "a"), (None, "a"), ("a", None)], "y_true string, y_pred string")
    got = {(r.kind, r.y_true, r.y_pred): (r.n, r.value) for r in evaluate.normalised(evaluate.confusion_grid(pairs), ["true", "pred", "all", "none"]).collect()}
    assert len(got) == 4 * 9
    assert got["true", "a", "b"] == (1, 0.5) and got["pred", "a", "a"] == (1, 0.5) and got["all", "c", "a"] == (1, 1 / 3)
    assert got["true", "b", "a"] == (0, 0.0) and got["pred", "a", "c"] == (0, 0.0) and got["none", "a", "a"] == (1, 1.0)
    with pytest.raises(ValueError):
        evaluate.confusion_matrix(pairs, "x")
