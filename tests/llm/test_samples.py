"""Bounded learning samples and scores that leave the user's columns alone."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievemark.llm import quality_rules, toxicity


def test_one_id_over_most_rows_sends_one_row(spark):
    docs = spark.range(3000).select(
        F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text")
    )
    labels = spark.createDataFrame([(7, 1), (2500, 0), (2600, 1)], "doc_id long, toxic int")
    rows = toxicity.labelled_sample(docs, labels, "toxic", None, 100, 1, ["text"]).collect()
    assert sorted((r.doc_id, r.y) for r in rows) == [(7, 1), (2500, 0), (2600, 1)]
    again = toxicity.labelled_sample(docs.repartition(5), labels, "toxic", None, 100, 1, ["text"]).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_null_text_of_a_labelled_id(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (2, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int")
    rows = toxicity.labelled_sample(docs, labels, "toxic", None, 100, 1, ["text"]).collect()
    assert sorted((r.doc_id, r.text or "") for r in rows) == [(1, ""), (2, "x")]


def test_rules_against_numpy(spark):
    """The column expression gives what the rules say, evaluated in numpy; a column ``_stats`` stays."""
    rng = np.random.default_rng(4)
    texts = [" ".join("".join(rng.choice(list("abcdefghij.,!A1")) for _ in range(rng.integers(1, 9))) for _ in range(rng.integers(0, 40))) for _ in range(300)]
    labels = [int(len(t) > 90) for t in texts]
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, _stats int")
    known = spark.createDataFrame(list(enumerate(labels)), "doc_id long, quality int")
    model = quality_rules.fit(docs, known)
    stats = quality_rules.statistics(F.coalesce("text", F.lit("")))
    values = docs.select("doc_id", *[c.alias(n) for n, c in stats.items()]).orderBy("doc_id").collect()
    x = np.array([[float(r[n]) for n in stats] for r in values])
    total = np.full(len(x), model.bias)
    for rule, weight in zip(model.rules, model.weights, strict=True):
        total += weight * rule.holds(x, list(stats))
    got = quality_rules.predict(docs, model).orderBy("doc_id").collect()
    assert [r.score for r in got] == pytest.approx(list(1 / (1 + np.exp(-total))))
    assert all(r._stats == 5 for r in got) and len(model.rules) > 0


def test_toxicity_score_from_the_weights(spark):
    """Scores recomputed feature by feature from the weights."""
    docs = [f"{w} text number {i} with words {w}" for i in range(60) for w in ("good", "vile")]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int("vile" in t)) for i, t in enumerate(docs)], "doc_id long, toxic int")
    weights = toxicity.fit(df, labels)
    by_index = dict(zip(weights.index.tolist(), weights.value.tolist(), strict=True))
    hashes = toxicity.WordHashes(), toxicity.Beginnings()
    for r in toxicity.predict(df, weights).collect():
        total = weights.bias + sum(by_index.get(int(i), 0.0) for i in np.unique(toxicity.features(r.text, hashes)))
        assert r.score == pytest.approx(1 / (1 + np.exp(-total)), rel=1e-6)
