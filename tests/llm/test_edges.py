"""Each operator on an empty table, and on NULLs, blanks, long texts, repeats and clashing columns."""

import zlib

import corpus_pipeline
import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sievemark.llm import decontaminate, langid, licenses, mixing, neardup, quality_rules, queries, secrets, sharding, topk, toxicity
from sievemark.llm.common import row_unit, unit_hash

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, size int, node string, hits int, "
    "_key int, _text string, _before int, row int, rank int, y int, spans string, _stats int"
)
WORDS = "the quick brown fox jumps over a lazy dog while seven wizards box quietly near old rivers".split()


def text(n, seed=0):
    return " ".join(WORDS[(i * i + seed * 7 + i // 5) % len(WORDS)] + str((i + seed) % 11) for i in range(n))


ROWS = [
    (1, text(40), "en", "a"), (1, text(40), "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, " \t\n", "fr", "b"),
    (None, text(30, 1), None, "b"), (None, None, None, None), (5, "one", "en", None), (6, text(60000, 2), "fr", "c"),
    (7, text(40), "en", "b"), (8, text(39) + " extra", "de", "b"), (9, "!!! ### 123 ---", "en", "c"), (10, "é ñ ü ß 漢字 😀", "fr", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, len(r[1] or ""), *([None] * 12)) for r in ROWS], SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, " ".join(text(40).split()[5:30])), (2, None), (3, ""), (None, "one"), (4, "漢字 😀")], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 1), (5, 0, 0), (6, None, 0), (7, 1, 1), (8, 0, 0), (None, 1, 1), (8, 0, 1), (8, 0, 0)], "doc_id long, quality int, toxic int")


def test_empty_tables(spark, empty, benchmark, labels):
    no_labels = labels.limit(0)
    assert licenses.licenses(empty).count() == 0
    assert langid.predict(empty, langid.fit(empty)).count() == 0
    assert neardup.near_duplicates(empty).count() == 0
    assert toxicity.predict(empty, toxicity.fit(empty, no_labels)).count() == 0
    assert decontaminate.occurrences(empty, benchmark).count() == 0
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 2 == 0).count() == 0
    assert secrets.scan(empty).count() == 0
    assert quality_rules.predict(empty, quality_rules.fit(empty, no_labels)).count() == 0
    assert mixing.mix(empty).count() == 0 and mixing.mixed_rows(empty).columns == empty.columns
    assert sharding.shards(empty).count() == 0


def test_empty_benchmark_and_labels(docs, benchmark, labels):
    assert decontaminate.occurrences(docs, benchmark.limit(0)).count() == 0
    for module in (toxicity, quality_rules):
        scores = {r["score"] for r in module.predict(docs, module.fit(docs, labels.limit(0))).collect()}
        assert scores == {0.0}


def test_licenses(spark, docs):
    assert licenses.licenses(docs).count() == 0
    more = spark.createDataFrame([(1, "x y\nReleased under the MIT License.\n\nz"), (2, "# Licensed under the\n# Apache License, Version 2.0\n"), (None, "Licensed under CC BY 4.0.")], "doc_id long, text string")
    got = {(r["doc_id"], r["license"]): (r["dice"], r["units"]) for r in licenses.licenses(more).collect()}
    assert got[(1, "MIT")] == (1.0, 1) and (2, "Apache-2.0") in got and (None, "CC-BY-4.0") in got


def test_license_size_bound_loses_nothing():
    found = licenses.anchors(licenses.TEMPLATES, 0.8)
    for _, t in licenses.TEMPLATES:
        grams = licenses.template_bigrams(t)
        untouched = [g for g in grams if not set(g.split()) & set(found)]
        assert 2 * len(untouched) / (len(untouched) + len(grams)) < 0.8


def test_langid(spark, docs):
    model = langid.fit(docs)
    got = langid.predict(docs, model).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert 0 <= r["score"] <= 1
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
    same = {(r["lang_pred"], r["score"]) for r in got if r["doc_id"] in (1, 7)}
    assert len(same) == 1
    none = langid.predict(docs, langid.fit(docs.withColumn("lang", F.lit(None).cast("string")))).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in none] == [("und", 0.0)]


def test_neardup(docs):
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert [r["component_id"] for r in by[1] + by[7] + by[8]] == [1, 1, 1, 1] and not by[7][0]["kept"] and not by[8][0]["kept"]
    for i in (2, 3, 4):
        assert (by[i][0]["n_shingles"], by[i][0]["component_id"], by[i][0]["kept"]) == (0, i, True)
    assert all(r["component_id"] is None and r["kept"] for r in by[None]) and by[5][0]["n_shingles"] == 1


def test_scores_of_classifiers(docs, labels):
    for module, label in ((toxicity, "toxic"), (quality_rules, "quality")):
        got = module.predict(docs, module.fit(docs, labels, label=label)).select("doc_id", "text", "score", "predicted").collect()
        assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
        assert len({r["score"] for r in got if not r["text"]}) == 1


def test_decontamination(docs, benchmark):
    got = {(r["doc_id"], r["item_id"], r["errors"]) for r in decontaminate.occurrences(docs, benchmark).collect()}
    assert {(1, 1, 0), (7, 1, 0), (8, 1, 0), (10, 4, 0)} <= got and not any(i in (2, 3, None) for _, i, _ in got)
    marked = decontaminate.matched(docs, benchmark, column="hits")
    assert marked.count() == len(ROWS)


def test_topk(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.5], 1), (2, [0.5, 0.5], 2), (3, None, 1), (4, [None, 1.0], 1), (5, [nan, 1.0], 1), (6, [inf, 0.0], 1),
            (7, [1.0], 1), (None, [1.0, 1.0], 1), (8, [-1.0, 0.2], 1), (9, [], 1)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int"), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 65536), (0, 2, 2, 32768), (0, 3, 8, -65536)]


def test_topk_of_an_id_with_several_vectors(spark):
    """Rows are ranked as in the SQL: copies of one id with other vectors keep their places."""
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), *[(1, [2.0, i / 8]) for i in range(7)], *[(i, [1.0, i / 8]) for i in range(2, 9)], (8, [0.5, 0.5])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(vectors, F.col("vec_id") % 50 == 0).collect()
    embeddings = pd.DataFrame(rows, columns=["vec_id", "embedding"])
    with duckdb.connect() as con:
        want = con.register("embeddings", embeddings).execute(queries.OP6_SQL).fetchall()
    assert len(want) == 5 and sorted(map(tuple, got)) == sorted(want)


def test_secrets(spark, docs):
    assert secrets.scan(docs).count() == len(ROWS)
    line = 'login token = "abcdefghijkl0" '
    rows = [(1, "😀" + line * 3), (2, "é" * 7 + "AKIA" + "A" * 14 + " user_id=bob12 " + "x" * 500 + " Zz9" * 3), (3, "token=secret:abcdefghijklmnop"), (4, (line + "0123456789abcdef ") * 3000),
            (5, "client_id: bob77 https://h.example/x key " + "aB3" * 12 + " password=abcdefghijklm"), (6, "https://h.example/x client_id: bob77")]
    got = {r["doc_id"]: r for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).select("*", secrets.joined(F.col("spans")).alias("s")).collect()}
    assert got[1]["s"].split(",")[0] == "assign:7:29" and got[1]["n_assign"] == 3
    assert got[2]["s"] == "access:7:25" and got[3]["s"] == "" and got[6]["s"] == ""
    assert got[4]["n_assign"] == 3000 and got[4]["n_hex"] == 3000
    assert [s.split(":")[0] for s in got[5]["s"].split(",")] == ["identifier", "endpoint", "token", "assign"]
    last = got[4]["spans"][-1]
    assert rows[3][1][last["start"] : last["end"]] == "0123456789abcdef"


def test_mixing(docs):
    got = mixing.mix(docs).collect()
    assert len(got) == len(ROWS) and all(r["taken"] == r["times"] * r["size"] and 0 <= r["times"] <= 2 for r in got)
    sizes = {None: 1, "a": 80, "b": 110, "c": 60000 + 4 + 6}
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["times"] for r in got)


def test_mixing_targets(spark):
    """Water level by hand: repeat the sharing until no source is above its bound."""
    sizes = {None: 50, "a": 10, "b": 500, "c": 300, "d": 7, "e": 0}
    frame = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
    weights = dict(zip(["a", "b", "c", "d", "e", None], [5, 2, 1, 5, 2, 1]))
    total, full = 1.5 * sum(sizes.values()), {}
    while True:
        level = (total - sum(full.values())) / sum(w for s, w in weights.items() if s not in full)
        over = {s: 2.0 * sizes[s] for s in sizes if s not in full and level * weights[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
    assert got == pytest.approx({s: full.get(s, level * weights[s]) for s in sizes})


@pytest.mark.parametrize("weight", [0.05, 1.0])
def test_mixing_buckets_stay_small(spark, weight):
    keys = spark.range(20000).select((-F.log(unit_hash(mixing.SEED, F.col("id"))) / weight).alias("key"))
    assert keys.groupBy(mixing.key_bucket(F.col("key"), 20000)).count().agg(F.max("count")).first()[0] < 141


def test_rows_without_an_id_are_spread(spark):
    rows = spark.range(500).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("a").alias("source"))
    assert rows.select(row_unit(1, F.col("doc_id"), F.col("text"))).distinct().count() == 500
    assert sum(r["taken"] for r in mixing.mix(rows).collect()) == 1500
    assert len({r["shard"] for r in sharding.shards(rows).collect()}) == sharding.SHARDS


def test_near_duplicates_without_an_id(spark):
    copies = [(None, text(60)), (None, text(60)), (None, text(59) + " end"), (3, text(60) + " end"), (None, text(60, 5)), (None, text(60, 5)), (9, text(50, 8))]
    frame = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in copies], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_duplicates(spark, frame, "")
    assert out.columns == frame.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out.collect()) == sorted([(3, text(60) + " end"), (0, text(60, 5)), (9, text(50, 8))])


def test_sharding(docs):
    got = sharding.shards(docs, n_shards=4).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert r["size"] >= 8
    sizes = [sorted(x["slot"] for x in got if x["shard"] == s) for s in range(4)]
    assert all(s == list(range(len(s))) for s in sizes) and max(map(len, sizes)) - min(map(len, sizes)) <= 1
    assert {r["text_crc32"] for r in got if r["doc_id"] in (2, 3)} == {0}
    assert {r["text_crc32"] for r in got if r["doc_id"] == 5} == {zlib.crc32(b"one")}


def test_every_stage_takes_edges(spark, docs, empty, tmp_path, benchmark):
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    for frame in (docs, empty):
        current = frame
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, current, str(tmp_path))
            if name != "sharding":
                assert out.columns == frame.columns
            current = out.cache()
            current.count()


def test_langid_learns_every_language(spark, monkeypatch):
    """More languages than FULL_LANGS: each is in the sample, though some have one document, and the sample keeps its bound."""
    seen = {}

    def train(windows, labels, langs, **options):
        seen.update(langs=langs, labels=set(labels), windows=len(windows))
        return langid.Model(langs)

    monkeypatch.setattr(langid, "train", train)
    rows = [(1000 * k + i, text(30, k), f"l{k:03d}") for k in range(90) for i in range(1 if k % 3 else 40)]
    got = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), docs_per_lang=3)
    assert got.langs == [f"l{k:03d}" for k in range(90)] and seen["labels"] == set(range(90))
    assert seen["windows"] <= (2 * langid.FULL_LANGS * 3 + 90) * langid.WINDOWS_PER_DOC
