"""Secret scan with multipart credential linking.

Strong kinds (assign, access, hex) are reported wherever they match. Weak kinds are
reported only with their other half nearby: an identifier needs a secret, a long token
needs an identifier, an endpoint needs both. "Nearby" is a scope of ``SCOPE`` code points
between the starts, found by an interval join on cells of that width, inside one text.
Column functions and joins only.

Positions come from tiling the text as (gap, match) pairs and adding up their lengths, in
code points. NULL and empty texts have no spans. Every input row gives one row, also when
an id is NULL or repeats. Columns besides those named are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SCOPE = 400
BLOCK = 256

#: What a span of each kind looks like. Group 2 of an assignment is its value.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
IDENTIFIER = r"""(?i:client|account|access|user|key)[_-]?(?i:id|name)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{4,}"""
TOKEN = r"[A-Za-z0-9+/]{32,}={0,2}"
ENDPOINT = r"""https?://[^\x20\x09-\x0D"'<>]+"""
KINDS = ["assign", "access", "hex", "identifier", "token", "endpoint"]
STRONG = 3
SECRETS, IDENTIFIERS = ("assign", "hex", "token"), ("access", "identifier")


def tiled(pattern: str) -> str:
    """A pattern whose matches cover the text: group 1 is the gap, group 2 the match (empty at the end)."""
    return rf"(?s)(.*?)({pattern}|\z)"


def running(lengths: Column) -> Column:
    """Exclusive prefix sums of an array column, in blocks, so that a long array is not copied at each step."""
    def scan(values: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("total"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(
            values, start,
            lambda a, x: F.struct((a["total"] + x).alias("total"), F.concat(a["out"], F.array(a["total"])).alias("out")),
            lambda a: a["out"],
        )

    last = F.floor((F.size(lengths) - 1) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK))
    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("bigint"), lambda a, x: a + x))
    return F.flatten(F.zip_with(blocks, scan(sums), lambda b, s: F.transform(scan(b), lambda x: x + s)))


def matches(df: DataFrame, kind: str, pattern: str, guard: Column, accept=None, value_group: int | None = None) -> DataFrame:
    """Adds column ``kind``: array of (rank, start, end) of the accepted leftmost matches of ``pattern``.

    ``guard`` is cheaper than the tiling and true wherever a match can be accepted.
    """
    tile, none = F.lit(tiled(pattern)), F.array().cast("array<string>")
    found = F.when(guard, F.regexp_extract_all("_text", tile, F.lit(1))).otherwise(none)
    hits = F.when(guard, F.regexp_extract_all("_text", tile, F.lit(2))).otherwise(none)
    values = F.when(guard, F.regexp_extract_all("_text", tile, F.lit(value_group))).otherwise(none) if value_group else hits
    kept = [c for c in df.columns]
    rank = KINDS.index(kind)
    step = df.withColumns({"_gaps": found, "_hits": hits, "_values": values}).withColumn(
        "_lengths", F.zip_with("_gaps", "_hits", lambda g, h: (F.length(g) + F.length(h)).cast("bigint"))
    ).withColumn("_starts", F.when(F.size("_lengths") > 0, running(F.col("_lengths"))).otherwise(F.array().cast("array<bigint>")))
    cells = F.arrays_zip("_starts", "_gaps", "_hits", "_values")
    good = F.filter(cells, lambda c: (c["_hits"] != "") & (accept(c["_values"]) if accept else F.lit(True)))
    spans = F.transform(good, lambda c: F.struct(
        F.lit(rank).alias("rank"), (c["_starts"] + F.length(c["_gaps"])).alias("start"),
        (c["_starts"] + F.length(c["_gaps"]) + F.length(c["_hits"])).alias("end"),
    ))
    return step.withColumn(kind, spans).select(*kept, kind)


def parts(docs: DataFrame) -> DataFrame:
    """doc_id, text key and one array of candidate spans per kind, for every row."""
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text")).withColumn("_key", F.xxhash64("_text"))
    text = F.col("_text")
    df = matches(df, "assign", ASSIGN, text.rlike(ASSIGN.replace("]+)", "]{12,})")), lambda v: F.length(v) >= 12, 4)
    df = matches(df, "access", ACCESS, text.contains("AKIA"), lambda v: F.length(v) >= 18)
    df = matches(df, "hex", HEX.replace("+", "{16,}"), text.rlike(HEX.replace("+", "{16,}")))
    df = matches(df, "identifier", IDENTIFIER, text.rlike(IDENTIFIER))
    named = (F.size("access") > 0) | (F.size("identifier") > 0)
    df = matches(df, "token", TOKEN, named, lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]") & ~v.rlike("^[0-9a-f]+$"))
    secret = (F.size("assign") > 0) | (F.size("hex") > 0) | (F.size("token") > 0)
    df = matches(df, "endpoint", ENDPOINT, named & secret)
    return df.select("doc_id", "_key", F.length("_text").alias("_length"), *KINDS)


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, _key, _length) → ``weak``: the weak spans whose complementary parts lie within ``scope``.

    A cell holds at most ``scope`` starts of a kind, so no cell of the interval join is large.
    """
    key = ["doc_id", "_key", "_length"]
    with_weak = found.filter(reduce(lambda a, b: a | b, [F.size(k) > 0 for k in KINDS[STRONG:]])).dropDuplicates(key)
    rows = with_weak.select(*key, F.explode(F.concat(*KINDS)).alias("_p")).select(*key, "_p.*").withColumn("_cell", F.floor(F.col("start") / scope))
    ranks = lambda names: F.col("rank").isin([KINDS.index(n) for n in names])
    weak = rows.filter(F.col("rank") >= STRONG).withColumn("_near", F.explode(F.array(F.col("_cell") - 1, F.col("_cell"), F.col("_cell") + 1)))
    helper = rows.filter(ranks(SECRETS + IDENTIFIERS)).select(
        *[F.col(c).alias(f"{c}_h") for c in key], F.col("_cell").alias("_near_h"), F.col("start").alias("start_h"), ranks(SECRETS).alias("secret_h"),
    )
    same = F.col("_near") == F.col("_near_h")
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_h"))
    met = (
        weak.join(helper, same & (F.abs(F.col("start") - F.col("start_h")) <= scope))
        .groupBy(*key, "rank", "start", "end")
        .agg(F.max("secret_h").alias("secret"), F.max(~F.col("secret_h")).alias("identifier"))
    )
    is_kind = lambda name: F.col("rank") == KINDS.index(name)
    complete = (
        (is_kind("identifier") & F.col("secret")) | (is_kind("token") & F.col("identifier"))
        | (is_kind("endpoint") & F.col("secret") & F.col("identifier"))
    )
    return met.filter(complete).groupBy(*key).agg(F.collect_list(F.struct("rank", "start", "end")).alias("weak"))


def scan(docs: DataFrame, *, scope: int = SCOPE) -> DataFrame:
    """doc_id, base and spans (arrays of kind, start, end by start, then kind) for every row of ``docs``."""
    found = written(parts(docs), "secrets")
    weak = linked(found, scope).select(F.col("doc_id").alias("_doc"), F.col("_key").alias("_k"), F.col("_length").alias("_l"), "weak")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_k")) & (F.col("_length") == F.col("_l"))
    base = F.concat(*KINDS[:STRONG])
    every = F.concat(base, F.coalesce("weak", F.array().cast("array<struct<rank:int,start:bigint,end:bigint>>")))

    def ordered(spans: Column) -> Column:
        by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"))))
        names = F.array(*[F.lit(k) for k in KINDS])
        return F.transform(by_start, lambda s: F.struct(F.element_at(names, s["rank"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    return found.join(weak, same, "left").select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS[:STRONG]], ordered(base).alias("base"), ordered(every).alias("spans")
    )


def joined(spans: Column) -> Column:
    """``kind:start:end`` items, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
