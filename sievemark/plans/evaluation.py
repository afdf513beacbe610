"""Evaluation of predictions and run records (tables: labels, documents, events, nation, region, embeddings)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..bindings import Tables
from ..functions import text, vectors
from ..operators import evaluate, runs
from .curation import rounded
from .prelude import sql
from .registry import query

LABELS = """counts AS (SELECT l AS label, count(*) FILTER (y_true = l AND y_pred = l) AS tp, count(*) FILTER (y_pred = l) AS pp, count(*) FILTER (y_true = l) AS support
FROM pairs, (SELECT y_true AS l FROM pairs UNION SELECT y_pred FROM pairs) GROUP BY l),
per AS (SELECT label, CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END AS precision, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall,
CASE WHEN pp + support > 0 THEN 2.0::DOUBLE * tp / (pp + support) ELSE 0.0 END AS f1, support FROM counts)"""


@query("agg_accuracy", sql("pairs", "SELECT round(avg(CAST(y_true = y_pred AS DOUBLE)), 6) AS accuracy FROM pairs"))
def _(t: Tables):
    return rounded(evaluate.accuracy(t.pairs))


@query("agg_f1_macro", sql("pairs", "SELECT round(avg(f1), 6) AS f1_macro FROM per", LABELS))
def _(t: Tables):
    return rounded(evaluate.f1_macro(t.pairs))


@query("agg_class_report", sql("pairs", """
SELECT CAST(label AS VARCHAR) AS label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM per
UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT round(avg(CAST(y_true = y_pred AS DOUBLE)), 6) AS a, count(*) AS n FROM pairs)
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM per
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM per""", LABELS).replace("WITH RECURSIVE", "WITH"))
def _(t: Tables):
    return rounded(evaluate.class_report(t.pairs))


@query("agg_confusion", sql("pairs", """
SELECT kind, y_true, y_pred, n, round(CASE kind WHEN 'true' THEN n / sum(n) OVER (PARTITION BY kind, y_true) WHEN 'pred' THEN n / sum(n) OVER (PARTITION BY kind, y_pred)
WHEN 'all' THEN n / sum(n) OVER (PARTITION BY kind) ELSE n END, 6) AS value FROM (
SELECT k.kind, a.l AS y_true, b.l AS y_pred, (SELECT count(*) FROM pairs p WHERE p.y_true = a.l AND p.y_pred = b.l) AS n
FROM (SELECT DISTINCT y_true AS l FROM pairs UNION SELECT y_pred FROM pairs) a, (SELECT DISTINCT y_true AS l FROM pairs UNION SELECT y_pred FROM pairs) b,
(SELECT unnest(['true', 'pred', 'all', 'none']) AS kind) k)"""))
def _(t: Tables):
    return rounded(evaluate.normalised(evaluate.confusion_grid(t.pairs), list(evaluate.NORMALISATIONS)))


def label_pairs(t: Tables):
    """True label of a vector and the label of its largest logit."""
    return t.logits.select("vec_id", F.col("label").alias("y_true"), vectors.argmax(F.col("logits")).alias("y_pred"))


GROUPS = """g AS (SELECT vec_id, label % 3 AS y_true, (list_position(logits, list_max(logits)) - 1) % 3 AS y_pred FROM logits)"""


@query("agg_confusion_group", sql("logits", """SELECT a.v AS y_true, b.v AS y_pred, count(g.vec_id) AS n,
round(count(g.vec_id) / sum(count(g.vec_id)) OVER (PARTITION BY a.v), 6) AS value
FROM (SELECT unnest([0, 1, 2]) AS v) a CROSS JOIN (SELECT unnest([0, 1, 2]) AS v) b LEFT JOIN g ON g.y_true = a.v AND g.y_pred = b.v GROUP BY 1, 2""", GROUPS))
def _(t: Tables):
    names = t.vectors.select(F.col("label").alias("cls")).distinct()
    mapping = names.withColumn("grp", F.col("cls") % 3)
    grouped = evaluate.remap_labels(label_pairs(t), mapping, "cls", "grp")
    return rounded(evaluate.confusion_matrix(grouped, "true"))


@query("jn_remap", """SELECT c_custkey, r_name AS y_true, r2 AS y_pred FROM (SELECT c_custkey, c_nationkey AS a, (c_nationkey * 7 + 3) % 25 AS b FROM customer)
JOIN (SELECT n_nationkey AS a, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) USING (a)
JOIN (SELECT n_nationkey AS b, r_name AS r2 FROM nation JOIN region ON n_regionkey = r_regionkey) USING (b)""")
def _(t: Tables):
    groups = t.raw("region").withColumnRenamed("r_regionkey", "n_regionkey")
    mapping = evaluate.chained_mapping(t.raw("nation"), "n_nationkey", groups, "n_regionkey", "r_name")
    pairs = t.raw("customer").select(
        "c_custkey", F.col("c_nationkey").alias("y_true"), ((F.col("c_nationkey") * 7 + 3) % 25).alias("y_pred")
    )
    return evaluate.remap_labels(pairs, mapping, "n_nationkey", "r_name").select("c_custkey", "y_true", "y_pred")


@query("flt_class_errors", sql("pairs", "SELECT doc_id, y_true, y_pred FROM pairs WHERE y_true = 1 AND y_pred <> y_true"))
def _(t: Tables):
    return evaluate.class_errors(t.pairs, 1).select("doc_id", "y_true", "y_pred")


@query("jn_truth", """SELECT count(l.quality) AS processed, count(*) FILTER (l.quality = CAST(d.n_chars >= 1000 AS INTEGER)) AS correct,
count(*) FILTER (l.quality IS NULL) AS skipped FROM documents d LEFT JOIN labels l USING (doc_id)""")
def _(t: Tables):
    return evaluate.truth_report(t.predicted_pairs, t.truth, "doc_id")


@query("jn_truth_skipped", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(t: Tables):
    return evaluate.skipped_items(t.predicted_pairs, t.truth, "doc_id")


PARITY = """j AS (SELECT coalesce(d.doc_id, l.doc_id) AS doc_id,
coalesce(CAST(d.n_chars >= 1000 AS INTEGER) = l.quality AND abs(1.0::DOUBLE - (1.0::DOUBLE + l.toxic * 0.001::DOUBLE + 0.0000001::DOUBLE)) <= 1e-6, false) AS ok FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id)"""


def two_systems(t: Tables):
    """Whole tables: the class by length of every document, and the labels, sure of themselves but for toxic ones."""
    left = t.predicted_pairs.select("doc_id", F.col("y_pred").alias("predicted_class"), F.lit(1.0).alias("confidence"))
    sure = F.lit(1.0) + F.col("toxic") * 0.001 + 0.0000001
    return left, t.raw("labels").select("doc_id", F.col("quality").alias("predicted_class"), sure.alias("confidence"))


@query("jn_parity", sql("", "SELECT doc_id, CASE WHEN ok THEN 'OK' ELSE 'FAIL' END AS status FROM j", PARITY))
def _(t: Tables):
    return evaluate.parity(*two_systems(t), "doc_id").select("doc_id", "status")


@query("jn_parity_totals", sql("", "SELECT count(*) FILTER (ok) AS ok, count(*) FILTER (NOT ok) AS fail FROM j", PARITY))
def _(t: Tables):
    return evaluate.parity_totals(evaluate.parity(*two_systems(t), "doc_id"))


@query("st_release_gate", sql("pairs", "SELECT round(avg(f1), 6) AS f1_macro, avg(f1) >= 0.5 AS released FROM per", LABELS))
def _(t: Tables):
    return rounded(evaluate.release_gate(t.pairs, 0.5))


@query("fn_translate_label", "SELECT n_nationkey, n_name || ' // ' || r_name AS display FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(t: Tables):
    rows = t.raw("nation").join(t.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select("n_nationkey", text.display_label(F.col("n_name"), F.col("r_name")).alias("display"))


# --- runs ---------------------------------------------------------------------------

def start_text():
    return F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start")


@query("src_runs", sql("runs", """SELECT run_id, run_name, CASE WHEN finished THEN 'FINISHED' ELSE 'RUNNING' END AS status, strftime(start, '%Y-%m-%d %H:%M:%S') AS start,
round(CASE WHEN finished THEN (epoch_us(last) // 1000 - epoch_us(start) // 1000) / 1000.0::DOUBLE END, 0) AS duration, CAST(n AS VARCHAR) AS "rows",
coalesce(test_accuracy, val_acc) AS accuracy FROM runs ORDER BY start DESC, run_id LIMIT 100"""))
def _(t: Tables):
    return runs.search(t.runs).select(
        "run_id", "run_name", "status", start_text(), F.round(runs.duration_seconds(), 0).alias("duration"),
        F.col("params")["rows"].alias("rows"), runs.first_metric(runs.ACCURACY_METRICS).alias("accuracy"),
    )


@query("src_run_history", sql("history", "SELECT step, value FROM history WHERE run_id = 'click'"))
def _(t: Tables):
    return runs.history(t.run_history, "click", "val_loss")


@query("win_latest_by_name", sql("runs", "SELECT run_name, run_id, strftime(start, '%Y-%m-%d %H:%M:%S') AS start FROM runs QUALIFY row_number() OVER (PARTITION BY run_name ORDER BY runs.start DESC, runs.run_id DESC) = 1"))
def _(t: Tables):
    return runs.latest_by_name(t.runs).select("run_name", "run_id", start_text())


@query("win_best_run", sql("runs", """SELECT run_id, run_name, coalesce(test_accuracy, val_acc) AS score FROM runs WHERE coalesce(test_accuracy, val_acc) IS NOT NULL
ORDER BY score DESC, start, run_id LIMIT 1"""))
def _(t: Tables):
    return runs.best_run(t.runs)


LATEST = """latest AS (SELECT run_name, coalesce(test_accuracy, val_acc) AS accuracy, coalesce(test_f1, val_f1) AS f1 FROM runs
QUALIFY row_number() OVER (PARTITION BY run_name ORDER BY start DESC, run_id DESC) = 1),
best AS (SELECT * FROM latest WHERE accuracy IS NOT NULL ORDER BY accuracy DESC, run_name LIMIT 1), base AS (SELECT * FROM latest WHERE run_name = 'view')"""


@query("win_run_gaps", sql("runs", """SELECT l.run_name, l.accuracy, l.f1, round(l.accuracy - l.f1, 6) AS accuracy_f1_gap, best.run_name AS best_run,
round(best.accuracy - base.accuracy, 6) AS gap_accuracy, round(best.f1 - base.f1, 6) AS gap_f1 FROM latest l, best, base""", LATEST))
def _(t: Tables):
    return rounded(runs.run_gaps(runs.latest_by_name(t.runs), "view"))


@query("win_best_step", sql("history", "SELECT run_id, step AS best_step, value AS best_value FROM history QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY value, step) = 1"))
def _(t: Tables):
    return runs.best_step(t.run_history)


@query("win_early_stop", sql("history", """, x AS (SELECT *, row_number() OVER w AS i, min(value) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
FROM history WINDOW w AS (PARTITION BY run_id ORDER BY step)),
y AS (SELECT *, max(CASE WHEN prev IS NULL OR value < prev THEN i END) OVER (PARTITION BY run_id ORDER BY step) AS last_better,
min(value) OVER (PARTITION BY run_id ORDER BY step) AS best FROM x),
s AS (SELECT run_id, min(step) FILTER (i - last_better >= 4) AS stop_step FROM y GROUP BY run_id)
SELECT s.run_id, s.stop_step, y.best AS best_value, CAST(y.i - y.last_better AS INTEGER) AS counter FROM s JOIN y ON y.run_id = s.run_id
AND y.step = coalesce(s.stop_step, (SELECT max(step) FROM history h WHERE h.run_id = s.run_id))""").replace(") , x", "), x"))
def _(t: Tables):
    return runs.early_stop(t.run_history, patience=4)


@query("win_latest_stage", """SELECT name, stage, max(version) AS version FROM (SELECT 'model_' || (o_custkey % 5) AS name,
CASE o_orderstatus WHEN 'O' THEN 'Staging' WHEN 'P' THEN 'Production' ELSE 'Archived' END AS stage, o_orderkey AS version FROM orders) GROUP BY 1, 2""")
def _(t: Tables):
    return runs.latest_stage(versions(t))


def versions(t: Tables):
    stage = F.when(F.col("o_orderstatus") == "O", "Staging").when(F.col("o_orderstatus") == "P", "Production").otherwise("Archived")
    name = F.concat(F.lit("model_"), (F.col("o_custkey") % 5).cast("string"))
    return t.raw("orders").select(name.alias("name"), stage.alias("stage"), F.col("o_orderkey").alias("version"))


@query("win_promote", """WITH v AS (SELECT 'model_' || (o_custkey % 5) AS name,
CASE o_orderstatus WHEN 'O' THEN 'Staging' WHEN 'P' THEN 'Production' ELSE 'Archived' END AS stage, o_orderkey AS version FROM orders),
c AS (SELECT max(version) AS best FROM v WHERE name = 'model_2' AND stage = 'Staging')
SELECT name, version, CASE WHEN name = 'model_2' AND stage = 'Staging' AND version = best THEN 'Production'
WHEN name = 'model_2' AND stage = 'Production' THEN 'Archived' ELSE stage END AS stage FROM v, c""")
def _(t: Tables):
    return runs.promote(versions(t), "model_2")


@query("agg_daily_success", """SELECT strftime(day, '%Y-%m-%d') AS day, total, success, total - success AS failed, round(success * 100.0::DOUBLE / total, 1) AS rate FROM (
SELECT CAST(ts AS DATE) AS day, count(*) AS total, count(*) FILTER (event_type <> 'error') AS success FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 14)""")
def _(t: Tables):
    daily = runs.daily_success(t.log, "ts", F.col("predicted_class") != "error")
    return daily.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("agg_overall_success", """SELECT count(*) AS total, count(*) FILTER (event_type <> 'error') AS success, count(*) FILTER (event_type = 'error') AS failed,
round(count(*) FILTER (event_type <> 'error') * 100.0::DOUBLE / count(*), 1) AS rate FROM events""")
def _(t: Tables):
    return runs.overall_success(t.log, F.col("predicted_class") != "error")


@query("agg_class_count", "SELECT count(DISTINCT lang) AS classes, count(DISTINCT lang) = 4 AS matches FROM documents")
def _(t: Tables):
    return evaluate.check_class_count(evaluate.label_index(t.raw("documents"), "lang"), 4)
