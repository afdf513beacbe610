"""The dealt operators bound to the given tables: one thin query each, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, decontaminate, langid, licenses, mixing, neardup, quality_rules, secrets, sharding, suffixes, topk, toxicity, whitening
from .common import documents

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


OP9_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                  coalesce(length(text), 0) AS chars FROM documents),
k AS (SELECT *, -ln((CAST('0x' || substr(md5('17:' || doc_id), 1, 13) AS BIGINT)::DOUBLE + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
             / greatest(0.05::DOUBLE, 1.0::DOUBLE / (1.0::DOUBLE + abs((CASE WHEN size > 0 THEN chars::DOUBLE / size ELSE 0.0 END) - 6.0::DOUBLE) / 6.0::DOUBLE)) AS key FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, source_size * 2.0::DOUBLE AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
             / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(cap, max(level) OVER () * w) AS target FROM l),
p AS (SELECT k.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs,
             coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST((epochs + CASE WHEN 2 * before + size < 2 * (target - epochs * source_size) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM p
"""

OP10_SQL = r"""
WITH c AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda a, b: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END))) AS crc),
h AS (SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) AS bytes, hex(encode(coalesce(text, ''))) AS hx FROM documents),
d AS (SELECT doc_id, source, CAST(bytes + 8 AS BIGINT) AS size,
             xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(bytes), lambda i: CAST('0x' || substr(hx, 2 * i + 1, 2) AS BIGINT))),
                 lambda a, b: xor(a >> 8, crc[CAST(xor(a, b) & 255 AS BIGINT) + 1])), 4294967295) AS text_crc32,
             (CAST('0x' || substr(md5('29:' || doc_id), 1, 13) AS BIGINT)::DOUBLE + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM h, c),
r AS (SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY u, doc_id, text_crc32, size) - 1)::DOUBLE / (2 * count(*) OVER (PARTITION BY source))::DOUBLE AS fraction FROM d),
p AS (SELECT *, row_number() OVER (ORDER BY fraction, source NULLS LAST, u, doc_id, text_crc32, size) - 1 AS pos, count(*) OVER () AS n FROM r)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law, CAST(pos * 24 // n AS INTEGER) AS shard,
       CAST(pos - ((pos * 24 // n) * n + 23) // 24 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM p
"""


@query("op9_mixing", OP9_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")


@query("op10_sharding", OP10_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shards(documents(spark, folder))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def tile_sql(kind: str, pattern: str, keep: str, value: int = 2) -> str:
    """DuckDB: the spans of one kind, by the same tiling."""
    tile = secrets.tiled(pattern).replace("'", "''")
    return f"""
SELECT doc_id, '{kind}' AS kind, {secrets.KINDS.index(kind)} AS rank, CAST(pos - length(hit) AS BIGINT) AS s, CAST(pos AS BIGINT) AS e FROM (
  SELECT doc_id, hit, val, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id ORDER BY i) AS pos FROM (
    SELECT doc_id, unnest(regexp_extract_all(text, '{tile}', 1)) AS gap, unnest(regexp_extract_all(text, '{tile}', 2)) AS hit,
           unnest(regexp_extract_all(text, '{tile}', {value})) AS val, unnest(range(len(regexp_extract_all(text, '{tile}', 1)))) AS i FROM documents))
WHERE hit <> '' AND {keep}"""


OP7_SQL = f"""
WITH parts AS ({" UNION ALL ".join([
    tile_sql("assign", secrets.ASSIGN, "length(val) >= 12", 4), tile_sql("access", secrets.ACCESS, "length(val) >= 18"),
    tile_sql("hex", secrets.HEX, "length(val) >= 16"), tile_sql("identifier", secrets.IDENTIFIER, "true"),
    tile_sql("token", secrets.TOKEN, "regexp_matches(val, '[0-9]') AND regexp_matches(val, '[A-Za-z]') AND NOT regexp_matches(val, '^[0-9a-f]+$')"),
    tile_sql("endpoint", secrets.ENDPOINT, "true")])}),
met AS (SELECT w.doc_id, w.kind, w.rank, w.s, w.e, bool_or(h.kind IN ('assign', 'hex', 'token')) AS sec, bool_or(h.kind IN ('access', 'identifier')) AS idn
        FROM parts w JOIN parts h ON w.doc_id = h.doc_id AND abs(w.s - h.s) <= {secrets.SCOPE}
        WHERE w.rank >= 3 AND h.rank <= 4 GROUP BY ALL),
spans AS (SELECT * FROM parts WHERE rank < 3 UNION ALL
          SELECT doc_id, kind, rank, s, e FROM met WHERE (kind = 'identifier' AND sec) OR (kind = 'token' AND idn) OR (kind = 'endpoint' AND sec AND idn)),
flat AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k, count(*) FILTER (kind = 'hex') AS h,
                string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3) AS base,
                string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents d LEFT JOIN flat USING (doc_id)
"""

TEMPLATE_ROWS = ", ".join(
    "('{}', [{}])".format(name, ", ".join(f"'{g}'" for g in licenses.template_bigrams(text))) for name, text in licenses.TEMPLATES
)
OP1_SQL = rf"""
WITH t(license, grams) AS (VALUES {TEMPLATE_ROWS}),
u AS (SELECT doc_id, 'line' AS scope, unnest(string_split(text, chr(10))) AS part, unnest(range(len(string_split(text, chr(10))))) AS unit FROM documents
      UNION ALL SELECT doc_id, 'paragraph', unnest(regexp_split_to_array(text, '
[ 	
]*
')), unnest(range(len(regexp_split_to_array(text, '
[ 	
]*
'))))
      FROM documents WHERE contains(text, chr(10))
      UNION ALL SELECT doc_id, 'text', text, 0 FROM documents WHERE contains(text, chr(10))),
w AS (SELECT doc_id, scope, unit, string_split(trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g')), ' ') AS words FROM u),
g AS (SELECT doc_id, scope, unit, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS grams FROM w WHERE len(words) >= 2),
p AS (SELECT doc_id, scope, unit, license, 2.0::DOUBLE * len(list_intersect(g.grams, t.grams)) / (len(g.grams) + len(t.grams)) AS dice FROM g, t
      WHERE len(g.grams) BETWEEN len(t.grams) * 0.6 AND len(t.grams) * 1.6)
SELECT doc_id, license, max(dice) AS dice, count(DISTINCT (scope, unit)) AS units FROM p WHERE dice >= 0.8::DOUBLE GROUP BY doc_id, license
"""


@query("op7_secrets", OP7_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(documents(spark, folder))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


@query("op1_licenses", OP1_SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licenses(documents(spark, folder))


def spared(spark: SparkSession, folder: str, table: str, modulus: int, left_out: int) -> tuple[DataFrame, DataFrame]:
    """A table with ``held_out``, and the condition under which its rows may be learned from."""
    rows = spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")
    return rows, F.coalesce(langid.remainder(F.col("doc_id"), modulus) == left_out, F.lit(False))


@query("op2_langid")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs, held_out = spared(spark, folder, "documents", 4, 2)
    model = langid.fit(docs, train_on=~held_out)
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op4_toxicity")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    labels, held_out = spared(spark, folder, "labels", 3, 1)
    docs = documents(spark, folder)
    weights = toxicity.fit(docs, labels, train_on=~held_out)
    return toxicity.predict(docs.select("doc_id", "text"), weights).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op8_quality")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    labels, held_out = spared(spark, folder, "labels", 4, 2)
    docs = documents(spark, folder)
    ensemble = quality_rules.fit(docs, labels, train_on=~held_out)
    return quality_rules.predict(docs.select("doc_id", "text"), ensemble).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op3_neardup")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = neardup.near_duplicates(documents(spark, folder), shingle=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op5_decontamination")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder.rstrip('/')}/benchmark.parquet")
    return decontaminate.occurrences(documents(spark, folder), benchmark)


OP6_SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op6_topk", OP6_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0)


@query("op12_suffixes")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.remove_repeats(documents(spark, folder))
    lost = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + (s["end"] - s["start"]))
    return found.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), lost.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op13_conversations")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.damage_and_repair(spark.read.parquet(f"{folder.rstrip('/')}/conversations.parquet"))


@query("op11_whitening")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    white = whitening.whiten(spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet"))
    each = white.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
        F.get("explained", F.col("at")).alias("explained"), "identity_error",
    )
