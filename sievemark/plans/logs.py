"""Prediction log, baseline and drift (table: events)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..bindings import LAST_TIME, SPLIT_TIME, Tables
from ..functions import dates
from ..operators import baseline, canary, drift, predlog
from .curation import rounded
from .prelude import sql
from .registry import query

TS = "strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts"


def stamped(df):
    return df.withColumn("ts", dates.stamp(F.col("ts")))


@query("flt_since", sql("log", f"SELECT id, {TS} FROM log WHERE ts >= TIMESTAMP '2024-01-16'"))
def _(t: Tables):
    return stamped(predlog.since(t.log, SPLIT_TIME).select("id", "ts"))


@query("flt_recent", sql("log", f"SELECT id, {TS}, predicted_class FROM log WHERE ts >= TIMESTAMP '2024-01-28' ORDER BY log.ts DESC, id LIMIT 1000"))
def _(t: Tables):
    return stamped(predlog.recent(t.log, LAST_TIME, hours=72).select("id", "ts", "predicted_class"))


@query("flt_regex_label", """SELECT 'exclude' AS kind, event_id FROM events WHERE NOT regexp_full_match(event_type, 'sign.*')
UNION ALL SELECT 'include', event_id FROM events WHERE regexp_full_match(event_type, 'click|view')
UNION ALL SELECT 'search', event_id FROM events WHERE regexp_matches(event_type, 'i[a-z]')""")
def _(t: Tables):
    def kind(name, rows):
        return rows.select(F.lit(name).alias("kind"), "event_id")

    a = kind("exclude", predlog.label_filter(t.log, "predicted_class", exclude="sign.*"))
    b = kind("include", predlog.label_filter(t.log, "predicted_class", include="click|view"))
    c = kind("search", predlog.label_filter(t.log, "predicted_class", include="i[a-z]", anchored=False))
    return a.unionByName(b).unionByName(c)


@query("agg_class_distribution", "SELECT event_type AS predicted_class, count(*) AS count FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY 1")
def _(t: Tables):
    return predlog.class_distribution(t.log, SPLIT_TIME)


@query("agg_count", "SELECT count(*) AS count FROM events")
def _(t: Tables):
    return predlog.total(t.log)


@query("agg_series_count", "SELECT count(DISTINCT event_type) AS series FROM events")
def _(t: Tables):
    return predlog.series_count(t.log)


@query("agg_up_summary", """SELECT up, total, CASE WHEN up = total THEN 'ok' WHEN up >= total - 1 THEN 'warning' ELSE 'error' END AS status FROM (
SELECT count(*) FILTER (last >= TIMESTAMP '2024-01-30') AS up, count(*) AS total FROM (SELECT user_id, max(ts) AS last FROM events GROUP BY 1))""")
def _(t: Tables):
    seen = t.log.groupBy("user_id").agg(F.max("ts").alias("last"))
    return predlog.up_summary(seen, F.col("last") >= F.lit("2024-01-30").cast("timestamp"))


@query("agg_ratio_mean", sql("log", "SELECT round(sum(confidence) / greatest(count(*), 1), 6) AS mean FROM log"))
def _(t: Tables):
    return rounded(predlog.ratio_mean(t.log, "confidence"))


@query("agg_footprint", "SELECT count(*) AS predictions, round((58.0::DOUBLE + count(*) * 0.000005::DOUBLE) / 50.0::DOUBLE, 6) AS equivalents FROM events")
def _(t: Tables):
    return rounded(predlog.footprint(t.log))


@query("win_topk_series", "SELECT event_type AS predicted_class, round(sum(value), 4) AS total FROM events GROUP BY 1 ORDER BY total DESC, 1 LIMIT 3")
def _(t: Tables):
    top = predlog.top_series(t.log, "predicted_class", 3, F.col("latency_ms"))
    return top.withColumn("total", F.round("total", 4))


@query("win_trend_top5", """SELECT strftime(date_trunc('hour', (ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris'), '%Y-%m-%d %H') AS hour, event_type AS predicted_class, count(*) AS count
FROM events WHERE event_type IN (SELECT event_type FROM events GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3) GROUP BY 1, 2""")
def _(t: Tables):
    return predlog.hourly_trend(t.log, k=3).withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH"))


@query("jn_vector_default", """SELECT 'error' AS kind, round(count(*) FILTER (event_type = 'error') / greatest(count(*), 0.001::DOUBLE), 6) AS error_ratio FROM events
UNION ALL SELECT 'never', 0.0::DOUBLE FROM (SELECT 1)""")
def _(t: Tables):
    some = predlog.error_ratio(t.log, t.is_error).select(F.lit("error").alias("kind"), "*")
    none = predlog.error_ratio(t.log, F.col("predicted_class") == "absent").select(F.lit("never").alias("kind"), "*")
    return rounded(some.unionByName(none))


@query("jn_vector_and", """SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS hour, n FROM (SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1)
WHERE h IN (SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'purchase')""")
def _(t: Tables):
    hour = dates.stamp(F.date_trunc("hour", F.col("ts"))).alias("hour")
    left = t.log.filter(t.is_error).groupBy(hour).agg(F.count(F.lit(1)).alias("n"))
    right = t.log.filter(F.col("predicted_class") == "purchase").select(hour)
    return predlog.where_active(left, right, "hour")


@query("snk_content_addressed", "SELECT sha256(text) AS hash, count(*) AS uploads FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE source = 'src0') GROUP BY 1")
def _(t: Tables):
    docs = t.raw("documents").select("text", "source")
    stored = docs.filter("source = 'src0'").select(F.sha2("text", 256).alias("hash")).distinct()
    return predlog.store_new(docs, stored, F.col("text"))


# --- baseline ------------------------------------------------------------------------

@query("agg_baseline_class", sql("log", """SELECT predicted_class, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS share, round(avg(confidence), 6) AS confidence_mean,
round(min(confidence), 6) AS confidence_min, round(max(confidence), 6) AS confidence_max FROM log GROUP BY 1"""))
def _(t: Tables):
    return rounded(baseline.class_baseline(t.log))


@query("agg_baseline_global", sql("log", """SELECT round(avg(CAST(predicted_class <> 'error' AS DOUBLE)), 6) AS top1_accuracy, round(avg(confidence), 6) AS confidence_mean,
round(quantile_cont(confidence, 0.10), 6) AS confidence_p10, round(quantile_cont(confidence, 0.50), 6) AS confidence_p50, round(quantile_cont(confidence, 0.95), 6) AS confidence_p95 FROM log"""))
def _(t: Tables):
    return rounded(baseline.global_baseline(t.log.withColumn("correct", ~t.is_error)))


@query("agg_hist_edges", sql("log", """SELECT '[' || printf('%.2f', low) || ', ' || printf('%.2f', high) || ')' AS bucket, low, high,
count(confidence) AS count, round(count(confidence) / (SELECT count(*) FROM log), 6) AS share
FROM (SELECT unnest([0.0, 0.5, 0.7, 0.8, 0.9, 0.95, 0.99])::DOUBLE AS low, unnest([0.5, 0.7, 0.8, 0.9, 0.95, 0.99, 1.0])::DOUBLE AS high) e
LEFT JOIN log ON confidence >= low AND (confidence < high OR (high = 1.0 AND confidence <= 1.0)) GROUP BY low, high"""))
def _(t: Tables):
    return baseline.edge_histogram(t.log, "confidence").withColumn("share", F.round("share", 6))


@query("jn_explode_counts", sql("log ref_log", """SELECT predicted_class, round(m, 6) AS confidence, count(*) AS "rows" FROM (
SELECT predicted_class, avg(confidence) AS m, unnest(range(count(*))) AS i FROM ref_log GROUP BY 1) GROUP BY 1, 2"""))
def _(t: Tables):
    rows = baseline.expand_counts(baseline.class_baseline(t.reference_log))
    return rows.groupBy("predicted_class", F.round("confidence", 6).alias("confidence")).agg(F.count(F.lit(1)).alias("rows"))


@query("jn_baseline", """SELECT props AS predicted_class, count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS n_reference,
count(*) FILTER (ts >= TIMESTAMP '2024-01-16') AS n_current FROM events GROUP BY 1""")
def _(t: Tables):
    """Whole log on both sides of the split time; the many values of props leave some on one side only."""
    return drift.align_classes(t.reference_log, t.current_log, "props").withColumnRenamed("props", "predicted_class")


# --- drift ---------------------------------------------------------------------------

SIDES = "sides AS (SELECT predicted_class, confidence, 0 AS cur, 'plain' AS kind FROM ref_log UNION ALL SELECT predicted_class, confidence, 1, 'plain' FROM cur_log " \
        "UNION ALL SELECT predicted_class, confidence, 0, 'shifted' FROM ref_log UNION ALL SELECT predicted_class, confidence, 1, 'shifted' FROM shift_log)"


def drift_sql(body: str, extra: str = "") -> str:
    return sql("log ref_log cur_log shift_log", body, SIDES + (", " + extra if extra else "")).replace("WITH RECURSIVE", "WITH")


def both_cases(t: Tables, run):
    plain = run(t.tagged_log).select(F.lit("plain").alias("kind"), "*")
    shifted = run(t.tagged_shifted_log).select(F.lit("shifted").alias("kind"), "*")
    return rounded(plain.unionByName(shifted))


CLASSES = """cls AS (SELECT kind, predicted_class, count(*) FILTER (cur = 0) AS r, count(*) FILTER (cur = 1) AS c FROM sides GROUP BY 1, 2),
tot AS (SELECT *, sum(r) OVER (PARTITION BY kind) AS tr, sum(c) OVER (PARTITION BY kind) AS tc FROM cls)"""
CHI = CLASSES + """, chi AS (SELECT kind, sum((r - (r + c) * tr / (tr + tc)) ** 2 / ((r + c) * tr / (tr + tc)) + (c - (r + c) * tc / (tr + tc)) ** 2 / ((r + c) * tc / (tr + tc))) AS x,
CAST(count(*) - 1 AS INTEGER) AS df FROM tot GROUP BY kind)"""
CDF = """vals AS (SELECT kind, confidence AS v, count(*) FILTER (cur = 0) AS r, count(*) FILTER (cur = 1) AS c FROM sides GROUP BY 1, 2),
cdf AS (SELECT kind, v, lead(v) OVER w - v AS width, abs(sum(r) OVER w / sum(r) OVER (PARTITION BY kind) - sum(c) OVER w / sum(c) OVER (PARTITION BY kind)) AS gap
FROM vals WINDOW w AS (PARTITION BY kind ORDER BY v))"""
KS = CDF + """, nm AS (SELECT kind, CAST(count(*) FILTER (cur = 0) AS DOUBLE) AS n, CAST(count(*) FILTER (cur = 1) AS DOUBLE) AS m FROM sides GROUP BY 1),
ks0 AS (SELECT kind, max(gap) AS d, max(gap) * sqrt(max(n) * max(m) / (max(n) + max(m))) AS lam FROM cdf JOIN nm USING (kind) GROUP BY kind),
ks AS (SELECT kind, d, CASE WHEN lam < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, 2 * list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0::DOUBLE * k * k * lam * lam))))) END AS p FROM ks0)"""


@query("drift_categorical", drift_sql("SELECT kind, round(x, 6) AS statistic, df, round(exp(-x / 2) * (1 + x / 2), 6) AS p_value FROM chi", CHI))
def _(t: Tables):
    # five classes: 4 degrees of freedom, whose tail has the closed form used in the SQL
    return both_cases(t, drift.chi_square)


@query("drift_categorical_days", """WITH k AS (SELECT dayofweek(ts) AS d, count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS r, count(*) FILTER (ts >= TIMESTAMP '2024-01-16') AS c FROM events GROUP BY 1),
x AS (SELECT sum((r - (r + c) * tr / (tr + tc)) ** 2 / ((r + c) * tr / (tr + tc)) + (c - (r + c) * tc / (tr + tc)) ** 2 / ((r + c) * tc / (tr + tc))) AS x, CAST(count(*) - 1 AS INTEGER) AS df
FROM k, (SELECT sum(r)::DOUBLE AS tr, sum(c)::DOUBLE AS tc FROM k))
SELECT round(x, 6) AS statistic, df, round(exp(-x / 2) * (1 + x / 2 + x * x / 8), 6) AS p_value FROM x""")
def _(t: Tables):
    """Days of the week as classes: 6 degrees of freedom."""
    day = F.dayofweek("ts").alias("day")
    return rounded(drift.chi_square(t.reference_log.select(day), t.current_log.select(day), "day"))


@query("drift_numeric", drift_sql("SELECT kind, round(d, 6) AS statistic, round(p, 6) AS p_value FROM ks", KS))
def _(t: Tables):
    return both_cases(t, drift.ks)


@query("drift_js", drift_sql("""SELECT kind, round(greatest(d, 0), 6) AS divergence, round(sqrt(greatest(d, 0)), 6) AS distance FROM (SELECT kind,
sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2 AS d
FROM (SELECT kind, r / tr AS p, c / tc AS q FROM tot) GROUP BY kind)""", CLASSES))
def _(t: Tables):
    return both_cases(t, drift.jensen_shannon)


@query("drift_wasserstein", drift_sql("""SELECT kind, round(sum(gap * coalesce(width, 0)), 6) AS distance,
round(sum(gap * coalesce(width, 0)) / (SELECT stddev_samp(confidence) FROM ref_log), 6) AS normed FROM cdf GROUP BY kind""", CDF))
def _(t: Tables):
    return both_cases(t, drift.wasserstein)


@query("drift_psi", drift_sql("""SELECT kind, round(sum((q - p) * ln(q / p)), 6) AS psi FROM (SELECT s.kind, low, greatest(count(*) FILTER (cur = 0 AND inside) / count(*) FILTER (cur = 0), 0.0001) AS p,
greatest(count(*) FILTER (cur = 1 AND inside) / count(*) FILTER (cur = 1), 0.0001) AS q FROM (SELECT kind, cur, low, confidence >= low AND (confidence < high OR (high = 1.0 AND confidence <= 1.0)) AS inside
FROM sides, (SELECT unnest([0.0, 0.5, 0.7, 0.8, 0.9, 0.95, 0.99])::DOUBLE AS low, unnest([0.5, 0.7, 0.8, 0.9, 0.95, 0.99, 1.0])::DOUBLE AS high)) s GROUP BY 1, 2) GROUP BY kind"""))
def _(t: Tables):
    return both_cases(t, drift.psi)


SUMMARY = """sm AS (SELECT kind, count(*) FILTER (cur = 1) AS n_current, count(*) FILTER (cur = 0) AS n_reference,
count(DISTINCT predicted_class) FILTER (cur = 1) AS n_current_classes, count(DISTINCT predicted_class) FILTER (cur = 0) AS n_reference_classes,
avg(confidence) FILTER (cur = 1) AS cm, avg(confidence) FILTER (cur = 0) AS rm, stddev_samp(confidence) FILTER (cur = 1) AS cs, stddev_samp(confidence) FILTER (cur = 0) AS rs FROM sides GROUP BY kind)"""
SUMMARY_COLUMNS = """n_current, n_reference, n_current_classes, n_reference_classes, round(cm, 6) AS confidence_current_mean,
round(rm, 6) AS confidence_reference_mean, round(cs, 6) AS confidence_current_std, round(rs, 6) AS confidence_reference_std"""


@query("agg_drift_summary", drift_sql(f"SELECT kind, {SUMMARY_COLUMNS} FROM sm", SUMMARY))
def _(t: Tables):
    return both_cases(t, drift.summary)


@query("drift_summary_stats", sql("log ref_log cur_log", " UNION ALL ".join(
    f"""SELECT '{side}' AS side, 'confidence' AS "column", count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, round(min(v), 6) AS min, round(quantile_cont(v, 0.25), 6) AS q25,
round(quantile_cont(v, 0.5), 6) AS q50, round(quantile_cont(v, 0.75), 6) AS q75, round(max(v), 6) AS max, NULL::BIGINT AS "unique", NULL::VARCHAR AS top, NULL::BIGINT AS freq FROM (SELECT confidence AS v FROM {table})
UNION ALL SELECT '{side}', 'predicted_class', CAST(sum(n) AS BIGINT), NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(*), arg_min(v, {{'n': -n, 'v': v}}), max(n)
FROM (SELECT predicted_class AS v, count(*) AS n FROM {table} GROUP BY 1)"""
    for side, table in (("reference", "ref_log"), ("current", "cur_log")))))
def _(t: Tables):
    return rounded(drift.side_by_side(t.reference_log, t.current_log))


FLAGS = CHI + ", " + KS + """, fl AS (SELECT kind, exp(-x / 2) * (1 + x / 2) AS cp, p AS kp, (CAST(exp(-x / 2) * (1 + x / 2) < 0.05 AS INTEGER) + CAST(p < 0.05 AS INTEGER)) / 2 AS share FROM chi JOIN ks USING (kind))"""


@query("drift_share", drift_sql("SELECT kind, share, share >= 0.5 AS dataset_drift FROM fl", FLAGS))
def _(t: Tables):
    return both_cases(t, drift.drift_job).select("kind", F.col("share_of_drifted_columns").alias("share"), "dataset_drift")


VERDICT_CASES = """slots AS (SELECT event_type, k FROM (SELECT DISTINCT event_type FROM events), (SELECT unnest(range(13)) AS k)),
cases AS (SELECT s.event_type, s.k, count(e.event_id) AS n, avg(50.0::DOUBLE / (50.0::DOUBLE + value)) AS m FROM slots s LEFT JOIN events e
ON e.event_type = s.event_type AND datediff('day', DATE '2024-01-01', e.ts) // 3 = s.k GROUP BY 1, 2)"""


@query("drift_verdict", f"""WITH {VERDICT_CASES} SELECT event_type, CAST(k AS BIGINT) AS slot, CASE WHEN n = 0 THEN 'no_data' WHEN n < 200 THEN 'insufficient'
WHEN coalesce(CASE WHEN event_type = 'click' THEN m < 0.75 END, CASE WHEN event_type <> 'view' THEN m END >= 0.72, false) THEN 'drift' ELSE 'stable' END AS status FROM cases""")
def _(t: Tables):
    """Per event class and three-day slot, from the first to the last of the log; three slots after it are empty."""
    slot = F.floor(F.datediff("ts", F.lit("2024-01-01").cast("date")) / 3)
    classes = t.log.select(F.col("predicted_class").alias("event_type")).distinct()
    slots = t.log.agg(F.min(slot).alias("first"), F.max(slot).alias("last")).select(F.explode(F.sequence("first", F.col("last") + 3)).alias("slot"))
    expected = classes.crossJoin(slots)
    seen = t.log.groupBy(F.col("predicted_class").alias("event_type"), slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"), F.avg("confidence").alias("m"))
    cases = expected.join(seen, ["event_type", "slot"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    flag = F.when(F.col("event_type") == "click", F.col("m") < 0.75)
    share = F.when(F.col("event_type") != "view", F.col("m"))
    return cases.select("event_type", "slot", drift.verdict(F.col("n"), flag, share, 0.72, 200).alias("status"))


def fr(x: str) -> str:
    return f"replace(printf('%.2f', {x}), '.', ',')"


TREND = f"""'Confiance moyenne en production : ' || {fr('cm')} || ', contre ' || {fr('rm')} || ' en référence. Elle est ' ||
CASE WHEN cm < rm THEN 'plus basse' ELSE 'comparable ou plus haute' END || coalesce(' et ' || CASE WHEN cs > rs THEN 'plus dispersée' ELSE 'aussi stable' END ||
' (écart-type ' || {fr('cs')} || ' contre ' || {fr('rs')} || ')', '') || ', ce qui est cohérent avec des images de terrain plus variées.'"""


@query("drift_trend_text", drift_sql(f"SELECT kind, {TREND} AS confidence_trend FROM sm", SUMMARY))
def _(t: Tables):
    rows = both_cases(t, drift.summary)
    text = drift.trend_text(*[F.col(f"confidence_{c}") for c in ("current_mean", "reference_mean", "current_std", "reference_std")])
    return rows.select("kind", text.alias("confidence_trend"))


@query("drift_job", drift_sql(f"""SELECT kind, {SUMMARY_COLUMNS}, round(cp, 6) AS class_score, round(kp, 6) AS confidence_score, share >= 0.5 AS dataset_drift, share AS share_of_drifted_columns,
CASE WHEN n_current = 0 THEN 'no_data' WHEN n_current < 200 THEN 'insufficient' WHEN share >= 0.5 THEN 'drift' ELSE 'stable' END AS status, {TREND} AS confidence_trend
FROM sm JOIN fl USING (kind)""", FLAGS + ", " + SUMMARY))
def _(t: Tables):
    return both_cases(t, drift.drift_job)


# --- canary ----------------------------------------------------------------------------

ARM = "CASE WHEN ('0x' || substr(md5('42:' || user_id), 1, 15))::BIGINT % 100 < {p} THEN 'candidate' ELSE 'champion' END"


@query("st_canary_assign", " UNION ALL ".join(f"SELECT {p} AS percent, user_id, {ARM.format(p=p)} AS arm FROM (SELECT DISTINCT user_id FROM events)" for p in (0, 10, 100)))
def _(t: Tables):
    users = t.log.select("user_id").distinct()
    frames = [users.select(F.lit(p).alias("percent"), "user_id", canary.arm(F.col("user_id"), p).alias("arm")) for p in (0, 10, 100)]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("st_canary_compare", f"""SELECT round(a, 6) AS candidate_rate, round(b, 6) AS champion_rate, a <= greatest(1.2::DOUBLE * b, 0.01::DOUBLE) AS accepted FROM (
SELECT count(*) FILTER (arm = 'candidate' AND event_type = 'error') / count(*) FILTER (arm = 'candidate') AS a,
count(*) FILTER (arm = 'champion' AND event_type = 'error') / count(*) FILTER (arm = 'champion') AS b
FROM (SELECT event_type, {ARM.format(p=10)} AS arm FROM events WHERE ts >= TIMESTAMP '2024-01-16'))""")
def _(t: Tables):
    rows = t.current_log.withColumn("arm", canary.arm(F.col("user_id")))
    return rounded(canary.compare(rows, "arm", t.is_error))


@query("flt_valid_rows", sql("log", "SELECT id, round(confidence - 0.5, 6) AS confidence FROM log WHERE confidence - 0.5 BETWEEN 0 AND 1"))
def _(t: Tables):
    """Confidence lowered by a half, so that some of it is out of range."""
    return rounded(predlog.valid_rows(t.log.withColumn("confidence", F.col("confidence") - 0.5)).select("id", "confidence"))
