"""Sources and sinks: every query writes a given table, reads it back and returns what it read."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..bindings import Tables
from ..functions import dates
from ..operators import quality, runs
from ..session import workspace
from ..sources import readers, writers
from ..streaming import metrics, stateful
from .curation import rounded
from .prelude import sql
from .registry import query
from .selection import strat
from .vectors import MODEL


@query("src_csv", sql("obs", "SELECT item AS image_lien, species, confidence, lang AS kingdom FROM obs"))
def _(t: Tables):
    path = workspace(t.spark, "observations")
    o = t.observations
    empty = F.lit(None).cast("string")
    rows = o.select(
        F.col("item").alias("image_lien"), F.col("species").alias("label"), F.col("species").alias("gbif_info/species"),
        F.col("confidence").alias("gbif_info/confidence"), F.col("lang").alias("gbif_info/kingdom"),
        *[empty.alias(f"gbif_info/{c}") for c in ("phylum", "class", "order", "family", "genus")],
    )
    rows.write.option("header", "true").csv(path)
    return readers.observations_csv(t.spark, path).select("image_lien", "species", "confidence", "kingdom")


@query("src_csv_dialect", sql("", "SELECT DISTINCT source || 'é' AS species FROM documents"))
def _(t: Tables):
    path = workspace(t.spark, "reference")
    rows = t.raw("documents").select(
        F.concat("source", F.lit("é")).alias("Nom scientifique"), F.col("lang").alias("Statut")
    )
    rows.write.option("header", "true").option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    return readers.reference_csv(t.spark, path, "Nom scientifique")


@query("src_fallback", sql("split", "SELECT split, CAST(doc_id AS VARCHAR) AS path, lang AS label FROM split WHERE split = 'val'"))
def _(t: Tables):
    # the filtered manifest is absent, so the raw one is taken
    raw, filtered = workspace(t.spark, "manifest"), workspace(t.spark, "filtered")
    rows = strat(t).select("split", F.col("doc_id").cast("string").alias("path"), F.col("lang").alias("label"))
    writers.write_manifest(rows, raw, ["split", "path", "label"])
    return readers.manifest_csv(t.spark, readers.first_existing(t.spark, filtered, raw), "val")


@query("snk_manifest", sql("split", "SELECT split, CAST(doc_id AS VARCHAR) AS path, lang AS label FROM split"))
def _(t: Tables):
    path = workspace(t.spark, "manifest")
    rows = strat(t).select("split", F.col("doc_id").cast("string").alias("path"), F.col("lang").alias("label"))
    writers.write_manifest(rows, path, ["split", "path", "label"], fmt="parquet", by_split=True)
    return t.spark.read.parquet(path).select("split", "path", "label")


@query("src_files", sql("", "SELECT lang, true AS listed, true AS indexed FROM documents GROUP BY lang"))
def _(t: Tables):
    root = workspace(t.spark, "tree")
    t.raw("documents").select("doc_id", "lang", "source").write.partitionBy("lang").parquet(root)
    listing = readers.file_listing(t.spark, root, [".parquet"])
    index = readers.file_index(listing)
    lang = F.regexp_extract("path", "lang=([a-z]+)/", 1)
    names = listing.groupBy(lang.alias("lang")).agg(F.count(F.lit(1)).alias("files"), F.max("length").alias("size"))
    found = index.agg(F.count(F.lit(1)).alias("n")).scalar()
    return names.select("lang", (F.col("size") > 0).alias("listed"), (found > 0).alias("indexed"))


@query("src_json_report", sql("scores", "SELECT species AS label, count(*) AS total, count(*) FILTER (score_final >= 0.03) AS kept, count(*) - count(*) FILTER (score_final >= 0.03) AS excluded FROM scores GROUP BY 1"))
def _(t: Tables):
    path = workspace(t.spark, "quality-report")
    writers.write_class_report(quality.class_pass(t.scores), "species", path)
    return readers.class_report_json(t.spark, path, "total bigint, kept bigint, excluded bigint")


@query("snk_report", sql("scores", """SELECT item, species, CASE WHEN score_final IS NULL THEN 'unreadable' ELSE 'low_score' END AS reason, round(score_final, 4) AS score_final
FROM scores WHERE score_final IS NULL OR score_final < 0.03"""))
def _(t: Tables):
    path = workspace(t.spark, "excluded")
    ledger = quality.exclusions(t.scores, quality.SCORE_THRESHOLD, MODEL)
    writers.write_rows_json(ledger, path)
    return readers.exclusions_json(t.spark, path, ledger.schema.simpleString()[7:-1].replace(":", " ")).select(
        "item", "species", "reason", "score_final"
    )


@query("snk_snapshot", sql("history", "SELECT 'dated' AS kind, run_id, step AS best_step, value AS best_value FROM history QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY value, step) = 1 "
       "UNION ALL SELECT 'current', run_id, step, value FROM history QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY value, step) = 1"))
def _(t: Tables):
    # an earlier snapshot is replaced by the next one as a whole
    root = workspace(t.spark, "analysis")
    writers.write_snapshot(runs.best_step(t.run_history), root, "2024-01-30")
    dated = writers.write_snapshot(runs.best_step(t.run_history), root, "2024-01-31")
    rows = t.spark.read.parquet(dated).select(F.lit("dated").alias("kind"), "*")
    return rows.unionByName(readers.current_snapshot(t.spark, root).select(F.lit("current").alias("kind"), "*"))


@query("snk_content_store", "SELECT DISTINCT sha256(text) AS hash FROM documents")
def _(t: Tables):
    # each call returns what it stored; the third finds nothing new
    root = workspace(t.spark, "uploads")
    docs = t.raw("documents").select("text")
    stored = [writers.store_content(rows, "text", root) for rows in (docs.filter(F.length("text") > 1000), docs, docs)]
    return stored[0].unionByName(stored[1]).unionByName(stored[2])


@query("src_xml_coverage", """SELECT lang AS package, source AS file, doc_id AS number, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 1 ELSE 0 END AS hits FROM documents""")
def _(t: Tables):
    return coverage_lines(t)


def coverage_lines(t: Tables):
    """Documents as lines of a coverage report: package = lang, file = source, hit = labelled.

    A package element holds at most 50 lines, so no element grows with the table.
    """
    path = workspace(t.spark, "coverage")
    known = t.files.withColumn("_hits", F.lit(1).cast("bigint"))
    lines = t.raw("documents").select("doc_id", "lang", "source").join(known, "doc_id", "left").select(
        "lang", "source", F.expr("doc_id div 50").alias("block"),
        F.struct(F.col("doc_id").alias("_number"), F.coalesce("_hits", F.lit(0)).alias("_hits")).alias("line"),
    )
    classes = lines.groupBy("lang", "block", "source").agg(F.collect_list("line").alias("line")).select(
        "lang", "block", F.struct(F.col("source").alias("_name"), F.struct("line").alias("lines")).alias("class")
    )
    packages = classes.groupBy("lang", "block").agg(F.collect_list("class").alias("class"))
    packages.select(F.col("lang").alias("_name"), F.struct("class").alias("classes")).write.format("xml").option(
        "rowTag", "package"
    ).save(path)
    return readers.coverage_xml(t.spark, path)


@query("agg_coverage", """SELECT lang AS package, count(l.doc_id) AS covered, count(*) AS valid, round(count(l.doc_id) * 100.0::DOUBLE / count(*), 1) AS rate
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""")
def _(t: Tables):
    return runs.coverage(coverage_lines(t))


@query("src_ci_runs", """SELECT CASE WHEN o_orderstatus = 'O' THEN 'EN COURS' ELSE 'SUCCES' END AS status, substr(repeat('t' || o_orderkey || ' ', 20), 1, 70) AS title,
CASE WHEN o_orderstatus = 'P' THEN '-' ELSE 'user' || o_custkey END AS actor, 'main' AS branch, o_orderkey % 200 || 'm05s' AS duration,
strftime(o_orderdate, '%Y-%m-%d 08:30') AS started, '' AS link FROM orders""")
def _(t: Tables):
    o = t.raw("orders")
    begin = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T08:30:00Z"))
    seconds = F.col("o_orderkey") % 200 * 60 + 5
    end = F.date_format(F.to_timestamp(begin) + F.make_dt_interval(secs=seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    doc = F.struct(
        F.when(F.col("o_orderstatus") == "O", "in_progress").otherwise("completed").alias("status"),
        F.when(F.col("o_orderstatus") != "O", "success").alias("conclusion"),
        F.repeat(F.concat(F.lit("t"), F.col("o_orderkey").cast("string"), F.lit(" ")), 20).alias("display_title"),
        F.when(F.col("o_orderstatus") != "P", F.struct(F.concat(F.lit("user"), F.col("o_custkey").cast("string")).alias("login"))).alias("triggering_actor"),
        F.lit("main").alias("head_branch"), begin.alias("run_started_at"), end.alias("updated_at"),
    )
    path = workspace(t.spark, "ci-runs")
    o.select(F.to_json(doc).alias("value")).write.text(path)
    return readers.ci_runs(t.spark.read.text(path), "value")


@query("src_metrics_text", """SELECT 'app_predictions_total' AS metric, event_type AS species, user_id AS "user", CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY 2, 3""")
def _(t: Tables):
    path = workspace(t.spark, "metrics")
    counts = t.log.groupBy("predicted_class", "user_id").agg(F.count(F.lit(1)).alias("n"))
    line = F.format_string('app_predictions_total{species="%s",user="%d"} %d.0', "predicted_class", "user_id", "n")
    other = F.format_string("other_total %d.0", F.col("n"))
    counts.select(F.explode(F.array(F.lit("# TYPE app_predictions_total counter"), line, other)).alias("value")).write.text(path)
    lines = readers.metric_lines(t.spark, path, "app_")
    return lines.select("metric", F.col("labels")["species"].alias("species"), F.col("labels")["user"].cast("bigint").alias("user"), "value")


# --- streams ------------------------------------------------------------------------------

RAW_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(t: Tables):
    """The event table as a stream in the shape of the prediction log."""
    raw = readers.prediction_stream(t.spark, t.folder, RAW_EVENTS, glob="events.parquet")
    return raw.select(
        F.col("event_id").cast("string").alias("id"), F.col("ts").cast("timestamp").alias("ts"),
        F.md5(F.col("user_id").cast("string")).alias("image_hash"), F.col("event_type").alias("predicted_class"),
        (F.lit(50.0) / (F.lit(50.0) + F.col("value"))).alias("confidence"), F.col("value").alias("latency_ms"),
    )


def drained(t: Tables, stream, name: str):
    """Run a stream over everything available and read its output table."""
    path, checkpoint = workspace(t.spark, name), workspace(t.spark, f"{name}-checkpoint")
    schema = stream.schema
    writers.append_table(stream, path, checkpoint).awaitTermination()
    return t.spark.read.schema(schema).parquet(path)


@query("src_pred_stream", sql("log", "SELECT id, predicted_class, round(confidence, 6) AS confidence FROM log"))
def _(t: Tables):
    return rounded(drained(t, event_stream(t), "stream-source").select("id", "predicted_class", "confidence"))


@query("snk_pred_log", sql("log", "SELECT id, strftime(ts, '%Y-%m-%d') AS day, '[{\"species\":\"' || predicted_class || '\",\"confidence\":1.0,\"rank\":1}]' AS top5_json FROM log"))
def _(t: Tables):
    path, checkpoint = workspace(t.spark, "prediction-log"), workspace(t.spark, "prediction-log-checkpoint")
    top = F.array(F.struct(F.col("predicted_class").alias("species"), F.lit(1.0).alias("confidence"), F.lit(1).alias("rank")))
    writers.append_log(event_stream(t).withColumn("top5", top), path, checkpoint).awaitTermination()
    stored = writers.export_log(t.spark.read.parquet(path))
    return stored.select("id", F.date_format("day", "yyyy-MM-dd").alias("day"), "top5_json")


@query("st_dedup_stream", "SELECT md5(CAST(user_id AS VARCHAR)) AS image_hash FROM events GROUP BY user_id")
def _(t: Tables):
    path, checkpoint = workspace(t.spark, "stored-once"), workspace(t.spark, "stored-once-checkpoint")
    writers.store_once(event_stream(t).select("image_hash"), "image_hash", path, checkpoint).awaitTermination()
    return t.spark.read.schema("image_hash string").parquet(path).select("image_hash")


@query("st_rate_stream", sql("log", """SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS start, predicted_class, count(*) AS n FROM (
SELECT time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '2024-01-01') - INTERVAL '1 hour' * k AS start, predicted_class FROM log, (SELECT unnest(range(6)) AS k))
WHERE start + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM log) GROUP BY 1, 2"""))
def _(t: Tables):
    """Windows that the watermark has closed; the batch form of the same function is ``st_rate_long``."""
    rates = metrics.rate(event_stream(t), ["predicted_class"], "6 hours", "1 hour")
    out = drained(t, rates, "stream-rate")
    return out.select(dates.stamp(F.col("start")).alias("start"), "predicted_class", "n")


def condition_stream(t: Tables):
    """One condition sample per event class: is the confidence of the event low?"""
    rows = event_stream(t)
    return rows.select(F.col("predicted_class").alias("alert"), F.col("ts").alias("at"), (F.col("confidence") < 0.95).alias("active"))


@query("st_for_stream", sql("log", """SELECT predicted_class AS alert, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "at", CASE WHEN ts - since >= INTERVAL 3 HOUR THEN 'firing' ELSE 'pending' END AS state FROM (
SELECT *, min(ts) OVER (PARTITION BY predicted_class, run) AS since FROM (
SELECT *, sum(fresh) OVER (PARTITION BY predicted_class ORDER BY ts, active DESC, event_id) AS run FROM (
SELECT predicted_class, ts, event_id, active, CASE WHEN NOT active OR NOT coalesce(lag(active) OVER w, false) OR ts - lag(ts) OVER w > INTERVAL 4 HOUR THEN 1 ELSE 0 END AS fresh
FROM (SELECT predicted_class, ts, event_id, confidence < 0.95 AS active FROM log) WINDOW w AS (PARTITION BY predicted_class ORDER BY ts, active DESC, event_id)))
WHERE active)"""))
def _(t: Tables):
    stateful.use_rocksdb(t.spark)
    path, checkpoint = workspace(t.spark, "stream-held"), workspace(t.spark, "stream-held-checkpoint")
    writers.upsert_log(stateful.held_runs(condition_stream(t), 3 * 3600, 4 * 3600), path, checkpoint).awaitTermination()
    out = readers.latest_rows(t.spark, path, stateful.HELD_SCHEMA, ["alert", "at"])
    return out.select("alert", dates.stamp(F.col("at")).alias("at"), "state", F.explode(F.sequence(F.lit(1), F.col("samples"))).alias("_i")).drop("_i")


@query("st_cooldown_stream", sql("log", """SELECT predicted_class AS key, strftime(tick, '%Y-%m-%d %H:%M:%S') AS "at" FROM f WHERE hit""",
       """c AS (SELECT predicted_class, date_trunc('second', ts) AS tick, row_number() OVER (PARTITION BY predicted_class ORDER BY ts) AS i FROM log WHERE confidence <= 0.6),
f AS (SELECT predicted_class, i, tick, tick AS last, true AS hit FROM c WHERE i = 1 UNION ALL
SELECT c.predicted_class, c.i, c.tick, CASE WHEN c.tick - f.last >= INTERVAL 12 HOUR THEN c.tick ELSE f.last END, c.tick - f.last >= INTERVAL 12 HOUR
FROM f JOIN c ON c.predicted_class = f.predicted_class AND c.i = f.i + 1)"""))
def _(t: Tables):
    stateful.use_rocksdb(t.spark)
    low = event_stream(t).filter("confidence <= 0.6").select(F.col("predicted_class").alias("key"), F.col("ts").alias("at"))
    out = drained(t, stateful.cooldown_stream(low, 12 * 3600), "stream-cooldown")
    return out.select("key", dates.stamp(F.col("at")).alias("at"))


@query("st_rule_absent_stream", sql("log", """SELECT md5(CAST(user_id AS VARCHAR)) AS source, strftime(last + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS absent_since
FROM (SELECT user_id, max(ts) AS last FROM log GROUP BY 1) WHERE last + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM log)"""))
def _(t: Tables):
    stateful.use_rocksdb(t.spark)
    beats = event_stream(t).select(F.col("image_hash").alias("source"), F.col("ts").alias("at"))
    out = drained(t, stateful.absent_stream(beats, 6 * 3600), "stream-absent")
    return out.select("source", dates.stamp(F.col("absent_since")).alias("absent_since"))
