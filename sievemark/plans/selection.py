"""Splits, samples, weights and set checks (tables: documents)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..bindings import Tables
from ..functions import text
from ..operators import curate, evaluate, sample, split
from .prelude import sql
from .registry import query


def docs(t: Tables):
    return t.raw("documents").select("doc_id", "lang")


def strat(t: Tables):
    return split.stratified_split(docs(t), "lang", "doc_id")


def grouped(t: Tables):
    rows = t.documents.select("doc_id", "lang", F.concat_ws("::", "lang", "item").alias("group_id"))
    return split.group_split(rows, "lang", "group_id")


@query("win_strat_split", sql("split", "SELECT doc_id, lang, split FROM split"))
def _(t: Tables):
    return strat(t).select("doc_id", "lang", "split")


@query("agg_split_stats", sql("split", """SELECT lang, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val,
count(*) FILTER (split = 'test') AS test, count(*) AS total FROM split GROUP BY lang"""))
def _(t: Tables):
    return split.split_stats(strat(t), "lang")


@query("agg_strat_check", sql("split", """SELECT min(a) AS train_min, max(a) AS train_max, min(b) AS val_min, max(b) AS val_max,
min(c) AS test_min, max(c) AS test_max FROM (SELECT round(count(*) FILTER (split = 'train') * 100.0::DOUBLE / count(*), 1) AS a,
round(count(*) FILTER (split = 'val') * 100.0::DOUBLE / count(*), 1) AS b,
round(count(*) FILTER (split = 'test') * 100.0::DOUBLE / count(*), 1) AS c FROM split GROUP BY lang)"""))
def _(t: Tables):
    return split.stratification_range(split.stratification_percent(split.split_stats(strat(t), "lang"), "lang"))


@query("src_manifest", sql("split", "SELECT split, CAST(doc_id AS VARCHAR) AS path, lang AS label FROM split WHERE split = 'test'"))
def _(t: Tables):
    from ..sources import readers

    rows = strat(t).select("split", F.col("doc_id").cast("string").alias("path"), F.col("lang").alias("label"))
    return readers.manifest_split(rows, "test")


@query("win_group_split", sql("gsplit", "SELECT doc_id, group_id, split FROM gsplit"))
def _(t: Tables):
    return grouped(t).select("doc_id", "group_id", "split")


@query("agg_group_summary", sql("gsplit", 'SELECT split, lang, count(DISTINCT group_id) AS groups, count(*) AS "rows" FROM gsplit GROUP BY 1, 2'))
def _(t: Tables):
    return split.group_summary(grouped(t), "lang", "group_id")


@query("agg_group_totals", sql("gsplit", 'SELECT split, count(DISTINCT group_id) AS groups, count(*) AS "rows", count(DISTINCT lang) AS classes FROM gsplit GROUP BY 1'))
def _(t: Tables):
    return split.group_totals(split.group_summary(grouped(t), "lang", "group_id"))


@query("set_disjoint_check", sql("gsplit", """SELECT (SELECT count(*) FROM (SELECT group_id FROM gsplit GROUP BY 1 HAVING count(DISTINCT split) > 1)) AS leaking,
(SELECT count(*) FROM (SELECT doc_id FROM documents EXCEPT ALL SELECT doc_id FROM gsplit)) AS lost,
(SELECT count(*) FROM (SELECT doc_id FROM gsplit EXCEPT ALL SELECT doc_id FROM documents)) AS extra"""))
def _(t: Tables):
    rows = grouped(t)
    gaps = split.coverage_gaps(docs(t), rows, "doc_id")
    leaking = split.leaking_groups(rows, "group_id").agg(F.count(F.lit(1)).alias("n")).scalar()
    return gaps.agg(
        leaking.alias("leaking"),
        F.count_if(F.col("side") == "lost").alias("lost"),
        F.count_if(F.col("side") == "extra").alias("extra"),
    )


@query("win_sample_per_class", """SELECT doc_id, lang FROM documents
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) <= 7""")
def _(t: Tables):
    return sample.sample_per_class(docs(t), "lang", "doc_id", 7)


@query("win_first_per_class", """SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rank FROM documents
QUALIFY rank <= 4""")
def _(t: Tables):
    return sample.first_per_class(docs(t), "lang", "doc_id", 4)


@query("win_round_robin", """SELECT doc_id, lang, rank FROM (SELECT doc_id, lang,
row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS rank FROM documents)
ORDER BY rank, md5('42:' || lang), lang LIMIT 30""")
def _(t: Tables):
    return sample.round_robin(docs(t), "lang", "doc_id", 30)


@query("win_strat_sample", """SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS r,
count(*) OVER (PARTITION BY lang) AS n, count(*) OVER () AS total FROM documents)
JOIN (SELECT count(DISTINCT lang) AS k FROM documents) ON true
WHERE r <= least(greatest(greatest(1, (100 // k) // 2), round_even(n / total * 100, 0)), n)""")
def _(t: Tables):
    return sample.stratified_sample(docs(t), "lang", "doc_id", 100)


@query("win_rebalance", """WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS rk,
count(*) OVER (PARTITION BY lang) AS n FROM documents),
s AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang HAVING count(*) < 140),
d AS (SELECT lang, n, CAST(unnest(range(1, 141)) AS BIGINT) AS draw FROM s)
SELECT doc_id, lang, CAST(0 AS BIGINT) AS draw FROM r WHERE n BETWEEN 140 AND 300 OR (n > 300 AND rk <= 300)
UNION ALL SELECT r.doc_id, r.lang, d.draw FROM d JOIN r ON r.lang = d.lang
AND r.rk = ('0x' || substr(md5('42:' || d.lang || ':' || d.draw), 1, 15))::BIGINT % d.n + 1""")
def _(t: Tables):
    # bounds at which the small test scales have classes on every branch
    return sample.rebalance(docs(t), "lang", "doc_id", high=300, low=140)


@query("win_dup_suffix", """SELECT doc_id, CASE WHEN c = 0 THEN item || '.jpg' ELSE item || '_' || c || '.jpg' END AS unique_name FROM (
SELECT doc_id, md5(text) AS item, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) - 1 AS c FROM documents)""")
def _(t: Tables):
    rows = t.documents.select("doc_id", F.concat("item", F.lit(".jpg")).alias("image"))
    return sample.suffix_copies(rows, "image", "doc_id").select("doc_id", "unique_name")


@query("win_class_weights", "SELECT doc_id, lang, round(1.0::DOUBLE / count(*) OVER (PARTITION BY lang), 9) AS weight FROM documents")
def _(t: Tables):
    return sample.class_weights(docs(t), "lang").select("doc_id", "lang", F.round("weight", 9).alias("weight"))


@query("win_weighted_sample", """WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS rk FROM documents),
s AS (SELECT lang, count(*) AS n, row_number() OVER (ORDER BY lang) - 1 AS idx, count(*) OVER () AS k FROM documents GROUP BY lang),
d AS (SELECT unnest(range((SELECT count(*) FROM documents))) AS draw)
SELECT r.doc_id, r.lang, d.draw FROM d JOIN s ON s.idx = ('0x' || substr(md5('42:c:' || d.draw), 1, 15))::BIGINT % s.k
JOIN r ON r.lang = s.lang AND r.rk = ('0x' || substr(md5('42:r:' || d.draw), 1, 15))::BIGINT % s.n + 1""")
def _(t: Tables):
    return sample.weighted_sample(docs(t), "lang", "doc_id")


@query("win_sort", "SELECT doc_id, lang, source FROM documents ORDER BY source, lang, doc_id")
def _(t: Tables):
    return t.raw("documents").select("doc_id", "lang", "source").orderBy("source", "lang", "doc_id")


@query("set_union", sql("split", "SELECT split, count(*) AS count FROM split GROUP BY split"))
def _(t: Tables):
    rows = strat(t)
    parts = [rows.filter(F.col("split") == s) for s in split.SPLITS]
    return split.split_totals(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query("set_intersect", sql("obs reference", """SELECT item FROM (SELECT item FROM obs GROUP BY item HAVING count(DISTINCT species) > 1
INTERSECT SELECT item FROM obs WHERE species IN (SELECT species FROM reference) AND confidence >= 500)"""))
def _(t: Tables):
    from .curation import passing

    return curate.conflicting_items(t.observations).intersect(passing(t).select("item"))


@query("set_distinct", "SELECT source, CAST(row_number() OVER (ORDER BY source) - 1 AS INTEGER) AS label_idx FROM (SELECT DISTINCT source FROM documents)")
def _(t: Tables):
    return evaluate.label_index(t.raw("documents"), "source")


@query("jn_label_index", """SELECT doc_id, lang, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS label_idx FROM documents""")
def _(t: Tables):
    rows = docs(t)
    return evaluate.with_label_index(rows, evaluate.label_index(rows, "lang"), "lang").select("doc_id", "lang", "label_idx")


@query("fn_base_id", """SELECT doc_id, regexp_extract(stem, '^(.+?)(?:_(\\d+))?$', 1) AS base_id, lang || '::' || regexp_extract(stem, '^(.+?)(?:_(\\d+))?$', 1) AS group_id
FROM (SELECT doc_id, lang, source || '_' || doc_id AS stem FROM documents)""")
def _(t: Tables):
    stem = F.concat_ws("_", "source", F.col("doc_id").cast("string"))
    return t.raw("documents").select(
        "doc_id", text.base_id(stem).alias("base_id"), text.group_id(F.col("lang"), stem).alias("group_id")
    )
