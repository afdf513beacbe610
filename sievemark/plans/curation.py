"""Curation: filters, deduplication, conflicts, funnel, profiles (tables: documents, labels)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..bindings import MIN_CHARS, Tables
from ..operators import curate, profile
from .prelude import sql
from .registry import query

PASSING = "pass AS (SELECT * FROM obs WHERE species IN (SELECT species FROM reference) AND confidence >= 500)"
FIRST = PASSING + ", firsts AS (SELECT * FROM pass QUALIFY row_number() OVER (PARTITION BY item ORDER BY ord) = 1)"
CONFLICT = FIRST + ", conflicts AS (SELECT item FROM obs GROUP BY item HAVING count(DISTINCT species) > 1)"
CLEAN = CONFLICT + ", clean AS (SELECT * FROM firsts WHERE item NOT IN (SELECT item FROM conflicts))"
FINAL = CLEAN + ", final AS (SELECT * FROM clean WHERE doc_id IN (SELECT doc_id FROM labels))"
COUNTS = FINAL + (
    ", c AS (SELECT (SELECT count(*) FROM obs) AS c0, (SELECT count(*) FROM obs WHERE species IN (SELECT species FROM reference)) AS c1, "
    "(SELECT count(*) FROM pass) AS c2, (SELECT count(*) FROM firsts) AS c3, (SELECT count(*) FROM clean) AS c4, "
    "(SELECT count(*) FROM final) AS c5)"
)


def passing(t: Tables):
    return curate.confident(curate.members(t.observations, t.reference_species), MIN_CHARS)


def states(t: Tables):
    return curate.item_states(t.observations, t.reference_species, t.files, "doc_id", MIN_CHARS)


@query("flt_membership", sql("obs reference", "SELECT ord, item, species FROM obs WHERE species IN (SELECT species FROM reference)"))
def _(t: Tables):
    return curate.members(t.observations, t.reference_species).select("ord", "item", "species")


@query("flt_confidence", sql("obs", "SELECT ord, item, confidence FROM obs WHERE confidence >= 500"))
def _(t: Tables):
    return curate.confident(t.observations, MIN_CHARS).select("ord", "item", "confidence")


@query("flt_conflict", sql("obs", "SELECT ord, item, species FROM obs WHERE item NOT IN "
       "(SELECT item FROM obs GROUP BY item HAVING count(DISTINCT species) > 1)"))
def _(t: Tables):
    return curate.without_conflicts(t.observations, t.observations).select("ord", "item", "species")


@query("flt_exists", sql("obs", "SELECT ord, species, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = obs.doc_id) AS present FROM obs"))
def _(t: Tables):
    found = curate.existing(t.observations, t.files, "doc_id").select("ord", "species", F.lit(True).alias("present"))
    lost = curate.missing(t.observations, t.files, "doc_id").select("ord", "species", F.lit(False).alias("present"))
    return found.unionByName(lost)


@query("prj_manifest", sql("obs reference", "SELECT item, species FROM final", FINAL))
def _(t: Tables):
    return curate.manifest(curate.curated(states(t)))


@query("flt_dropna_any", sql("", "SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id) "
       "WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL"))
def _(t: Tables):
    docs = t.raw("documents").select("doc_id", "lang")
    return docs.join(t.raw("labels"), "doc_id", "left").dropna("any")


@query("win_dedup_first", sql("obs reference", "SELECT item, ord, species FROM firsts", FIRST))
def _(t: Tables):
    return curate.keep_first(passing(t).select("item", "ord", "species"))


@query("agg_funnel", sql("obs reference", """
SELECT CAST(0 AS BIGINT) AS step, 'all_rows' AS name, c0 AS count, CAST(0 AS BIGINT) AS removed FROM c
UNION ALL SELECT 1, 'member', c1, c0 - c1 FROM c UNION ALL SELECT 2, 'confident', c2, c1 - c2 FROM c
UNION ALL SELECT 3, 'deduplicated', c3, c2 - c3 FROM c UNION ALL SELECT 4, 'unconflicted', c4, c3 - c4 FROM c
UNION ALL SELECT 5, 'present', c5, c4 - c5 FROM c""", COUNTS))
def _(t: Tables):
    return curate.funnel(curate.funnel_counts(states(t)))


@query("agg_exclusion_reasons", sql("obs reference", """
SELECT 'not_in_reference' AS reason, c0 - c1 AS count FROM c UNION ALL SELECT 'low_confidence', c1 - c2 FROM c
UNION ALL SELECT 'duplicate_item', c2 - c3 FROM c UNION ALL SELECT 'label_conflict', c3 - c4 FROM c
UNION ALL SELECT 'missing_file', c4 - c5 FROM c UNION ALL SELECT 'total', c0 - c5 FROM c""", COUNTS))
def _(t: Tables):
    return curate.exclusion_reasons(curate.funnel_counts(states(t)))


@query("jn_enrich", sql("", "SELECT o_orderkey, c_name, c_mktsegment, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey "
       "WHERE o_totalprice >= 100000"))
def _(t: Tables):
    orders = t.raw("orders").select("o_orderkey", "o_custkey", "o_totalprice").filter("o_totalprice >= 100000")
    who = t.raw("customer").select("c_custkey", "c_name", "c_mktsegment")
    return orders.join(who, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name", "c_mktsegment", "o_totalprice"
    )


@query("agg_value_counts", sql("obs", "SELECT species, count(*) AS count FROM obs GROUP BY species"))
def _(t: Tables):
    return profile.value_counts(t.observations, "species")


@query("agg_imbalance", sql("sizes", """
SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS classes, arg_min(lang, {'n': n, 'l': lang}) AS min_class, min(n) AS min_count,
arg_min(lang, {'n': -n, 'l': lang}) AS max_class, max(n) AS max_count, round(max(n) / min(n), 1) AS imbalance_ratio FROM sizes"""))
def _(t: Tables):
    return profile.imbalance(profile.value_counts(t.observations, "lang"), "lang")


@query("agg_counts_by_confidence", sql("obs", "SELECT confidence, count(*) AS count FROM obs GROUP BY confidence"))
def _(t: Tables):
    return t.observations.groupBy("confidence").agg(F.count(F.lit(1)).alias("count"))


@query("agg_null_counts", """
SELECT * FROM (SELECT 'quality' AS "column", count(*) FILTER (l.quality IS NULL) AS nulls FROM documents d LEFT JOIN labels l USING (doc_id)
UNION ALL SELECT 'toxic', count(*) FILTER (l.toxic IS NULL) FROM documents d LEFT JOIN labels l USING (doc_id)
UNION ALL SELECT 'lang', count(*) FILTER (lang IS NULL) FROM documents) WHERE nulls > 0""")
def _(t: Tables):
    docs = t.raw("documents").select("doc_id", "lang")
    return profile.null_counts(docs.join(t.raw("labels"), "doc_id", "left"))


DESCRIBE = """count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, round(min(v), 6) AS min,
round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50, round(quantile_cont(v, 0.75), 6) AS q75,
round(max(v), 6) AS max"""


def rounded(df, keep: list[str] = []):
    numbers = [c for c, kind in df.dtypes if kind == "double" and c not in keep]
    return df.withColumns({c: F.round(c, 6) for c in numbers})


@query("agg_describe", f"""
SELECT 'n_chars' AS what, {DESCRIBE} FROM (SELECT CAST(n_chars AS DOUBLE) AS v FROM documents) UNION ALL
SELECT 'class_size' AS what, {DESCRIBE} FROM (SELECT CAST(count(*) AS DOUBLE) AS v FROM documents GROUP BY source)""")
def _(t: Tables):
    rows = profile.describe(t.observations, F.col("n_chars")).select(F.lit("n_chars").alias("what"), "*")
    sizes = profile.value_counts(t.observations, "species")
    classes = profile.describe(sizes, F.col("count")).select(F.lit("class_size").alias("what"), "*")
    return rounded(rows.unionByName(classes))


@query("agg_describe_object", """
SELECT 'lang' AS "column", (SELECT count(lang) FROM documents) AS count, count(*) AS "unique", arg_min(v, {'n': -n, 'v': v}) AS top, max(n) AS freq
FROM (SELECT lang AS v, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY 1)
UNION ALL SELECT 'source', (SELECT count(source) FROM documents), count(*), arg_min(v, {'n': -n, 'v': v}), max(n)
FROM (SELECT source AS v, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1)""")
def _(t: Tables):
    return profile.describe_text(t.raw("documents").select("lang", "source"), ["lang", "source"])


@query("agg_taxonomy", """
SELECT CASE WHEN grouping(r_name) = 0 THEN 'r_name' WHEN grouping(n_name) = 0 THEN 'n_name' ELSE 'c_mktsegment' END AS level,
coalesce(r_name, n_name, c_mktsegment) AS value, count(*) AS count
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY GROUPING SETS ((r_name), (n_name), (c_mktsegment))""")
def _(t: Tables):
    nations = t.raw("nation").join(t.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = t.raw("customer").select("c_nationkey", "c_mktsegment").join(
        nations.select("n_nationkey", "n_name", "r_name"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return profile.level_counts(rows, ["r_name", "n_name", "c_mktsegment"])


@query("agg_file_stats", "SELECT count(*) AS files, min(n_chars) AS min_size, max(n_chars) AS max_size, "
       "CAST(sum(n_chars) // count(n_chars) AS BIGINT) AS mean_size, CAST(sum(n_chars) AS BIGINT) AS total_size FROM documents")
def _(t: Tables):
    return profile.size_stats(t.raw("documents"), "n_chars")


@query("agg_duplicate_groups", """
SELECT sha256(text) AS digest, doc_id AS member, count(*) OVER (PARTITION BY sha256(text)) AS group_size
FROM documents QUALIFY group_size > 1""")
def _(t: Tables):
    return profile.duplicate_groups(t.raw("documents"), F.sha2("text", 256), "doc_id")


@query("agg_duplicate_totals", "SELECT count(*) AS duplicate_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows "
       "FROM (SELECT count(*) AS n FROM documents GROUP BY sha256(text) HAVING count(*) > 1)")
def _(t: Tables):
    return profile.duplicate_totals(t.raw("documents"), F.sha2("text", 256))


@query("agg_file_extensions", """SELECT lower(regexp_extract(url, '\\.([A-Za-z0-9]+)$', 1)) AS extension, count(*) AS count FROM pages GROUP BY 1""")
def _(t: Tables):
    return profile.extension_counts(t.raw("pages"), "url")


@query("agg_file_dimensions", """SELECT CASE WHEN n_chars >= 200 THEN (n_chars // 1000) || 'x' || length(lang) END AS dimensions, count(*) AS count FROM documents GROUP BY 1""")
def _(t: Tables):
    """Length in thousands against the width of the code; texts below 200 characters count as corrupt."""
    files = t.raw("documents").select("n_chars", F.expr("n_chars div 1000").alias("w"), F.length("lang").alias("h"))
    return profile.dimension_counts(files, "w", "h", F.col("n_chars") < 200)
