"""Window metrics, alert rules and triggers (table: events)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..bindings import Tables
from ..functions import dates
from ..operators import predlog
from ..streaming import alerts, metrics
from .curation import rounded
from .prelude import sql
from .registry import query

NOW = "2024-01-20 12:00:00"
START = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


def windows(length: int, slide: int, extra: str = "") -> str:
    """CTE ``w``: every event with the start of each window that holds it (times in minutes)."""
    return (
        f"w AS (SELECT time_bucket(INTERVAL '{slide} minutes', ts, TIMESTAMP '2024-01-01') - INTERVAL '{slide} minutes' * k AS start, log.* "
        f"FROM log, (SELECT unnest(range({length // slide})) AS k))" + extra
    )


def stamped(df, *columns):
    return df.withColumns({c: dates.stamp(F.col(c)) for c in columns})


LE = ", ".join(
    f"count(*) FILTER (latency_ms / 1000.0::DOUBLE <= {b}::DOUBLE) AS le_{i}" for i, b in enumerate(metrics.LATENCY_BOUNDS)
) + ", count(*) AS le_inf"


def quantile_sql(q: float) -> str:
    bounds = metrics.LATENCY_BOUNDS
    parts = []
    for i, b in enumerate(bounds):
        low, below = (bounds[i - 1], f"le_{i - 1}") if i else (0.0, "0")
        parts.append(
            f"WHEN le_{i} >= {q}::DOUBLE * le_inf THEN {low}::DOUBLE + ({b}::DOUBLE - {low}::DOUBLE) * ({q}::DOUBLE * le_inf - {below}) / (le_{i} - {below})"
        )
    return f"CASE {' '.join(parts)} ELSE {bounds[-1]}::DOUBLE END"


@query("st_rate", sql("log", f"SELECT {START.format('start')} AS start, predicted_class, count(*) AS n, round(count(*) / 300.0::DOUBLE, 6) AS rate FROM w GROUP BY 1, 2", windows(5, 1)))
def _(t: Tables):
    return rounded(stamped(metrics.rate(t.log, ["predicted_class"]), "start").drop("end"))


@query("st_rate_long", sql("log", f"SELECT {START.format('start')} AS start, predicted_class, count(*) AS n, round(count(*) / 21600.0::DOUBLE, 6) AS rate FROM w GROUP BY 1, 2", windows(360, 60)))
def _(t: Tables):
    return rounded(stamped(metrics.rate(t.log, ["predicted_class"], "6 hours", "1 hour"), "start").drop("end"))


@query("st_rps", sql("log", f"SELECT {START.format('start')} AS start, count(*) AS n, round(count(*) / 300.0::DOUBLE, 6) AS rate FROM w GROUP BY 1", windows(5, 1)))
def _(t: Tables):
    return rounded(stamped(metrics.request_rate(t.log), "start").drop("end"))


@query("st_counter_rate", sql("log", f"""SELECT {START.format('start')} AS start, user_id, round(sum(inc), 4) AS increase FROM (
SELECT s.user_id, inc, time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '2024-01-01') AS start FROM (SELECT user_id, ts,
coalesce(CASE WHEN latency_ms < lag(latency_ms) OVER w THEN latency_ms ELSE latency_ms - lag(latency_ms) OVER w END, 0.0) AS inc FROM log WINDOW w AS (PARTITION BY user_id ORDER BY ts)) s) GROUP BY 1, 2"""))
def _(t: Tables):
    # the value of a user read as a counter that resets whenever it falls
    out = metrics.counter_rate(t.log, ["user_id"], ["user_id"], "1 hour", "1 hour", value="latency_ms")
    return stamped(out, "start").select("start", "user_id", F.round("increase", 4).alias("increase"))


@query("st_hist_buckets", sql("log", "SELECT day, le, count FROM (UNPIVOT (SELECT strftime(ts, '%Y-%m-%d') AS day, "
       + ", ".join(f"count(*) FILTER (latency_ms / 1000.0::DOUBLE <= {b}::DOUBLE) AS \"{b:g}\"" for b in metrics.LATENCY_BOUNDS)
       + ", count(*) AS \"+Inf\" FROM log GROUP BY 1) ON COLUMNS(* EXCLUDE day) INTO NAME le VALUE count)"))
def _(t: Tables):
    buckets = metrics.latency_buckets(t.log, t.latency_seconds, "1 day")
    return metrics.buckets_long(buckets.withColumn("day", F.date_format("start", "yyyy-MM-dd")), ["day"])


@query("st_hist_quantile", sql("log", f"SELECT {START.format('start')} AS start, round({quantile_sql(0.5)}, 6) AS p50, round({quantile_sql(0.95)}, 6) AS p95, round({quantile_sql(0.99)}, 6) AS p99 FROM q",
       windows(60, 10, f", q AS (SELECT start, {LE} FROM w GROUP BY start)")))
def _(t: Tables):
    return rounded(stamped(metrics.latency_quantiles(t.log, t.latency_seconds, "1 hour", "10 minutes"), "start").drop("end"))


@query("st_mean_window", sql("log", f"SELECT {START.format('start')} AS start, count(*) AS n, round(avg(confidence), 6) AS mean FROM w GROUP BY 1", windows(10, 1)))
def _(t: Tables):
    return rounded(stamped(metrics.window_mean(t.log, "confidence", "10 minutes"), "start").drop("end"))


@query("st_error_rate", sql("log", f"""SELECT {START.format('start')} AS start, count(*) FILTER (predicted_class = 'error') AS errors, count(*) AS requests,
round((count(*) FILTER (predicted_class = 'error') / 300.0::DOUBLE) / greatest(count(*) / 300.0::DOUBLE, 0.001::DOUBLE), 6) AS error_rate FROM w GROUP BY 1""", windows(5, 1)))
def _(t: Tables):
    return rounded(stamped(metrics.error_rate(t.log, t.is_error), "start").drop("end"))


LIVE = f"""live AS (SELECT {LE.replace('count(*)', "count(*) FILTER (inside)").replace('FILTER (inside) FILTER (latency', 'FILTER (inside AND latency')},
count(*) FILTER (inside AND predicted_class = 'error') AS errors, count(*) AS total, sum(confidence) / greatest(count(*), 1) AS conf
FROM (SELECT *, ts > TIMESTAMP '{NOW}' - INTERVAL 6 HOUR AS inside FROM log WHERE ts <= TIMESTAMP '{NOW}')),
lm AS (SELECT le_inf / 21600.0::DOUBLE AS rps, {quantile_sql(0.5)} AS p50, {quantile_sql(0.95)} AS p95, {quantile_sql(0.99)} AS p99,
(errors / 21600.0::DOUBLE) / greatest(le_inf / 21600.0::DOUBLE, 0.001::DOUBLE) AS error_rate, total AS total_predictions, conf AS confidence_avg FROM live)"""


def live(t: Tables):
    return metrics.live_metrics(t.log, NOW, t.is_error, t.latency_seconds, length="6 hours")


@query("st_live_metrics", sql("log", """SELECT round(rps, 6) AS rps, round(p50, 6) AS p50, round(p95, 6) AS p95, round(p99, 6) AS p99, round(error_rate, 6) AS error_rate,
total_predictions, round(confidence_avg, 6) AS confidence_avg FROM lm""", LIVE))
def _(t: Tables):
    return rounded(live(t))


LEVEL_CASES = """vals AS (SELECT day, unnest(['confidence', 'latency_p95_seconds', 'error_rate', 'unbounded']) AS metric, unnest([c, p, e, e]) AS value FROM (
SELECT strftime(ts, '%Y-%m-%d %H') AS day, avg(confidence) AS c, max(latency_ms) / 1000.0::DOUBLE AS p, count(*) FILTER (predicted_class = 'error') / count(*) AS e FROM log GROUP BY 1))"""


@query("st_level", sql("log", """SELECT day, metric, round(value, 6) AS value, CASE WHEN metric = 'unbounded' THEN 'unknown'
WHEN metric = 'confidence' AND value <= 0.5 THEN 'critical' WHEN metric = 'confidence' AND value <= 0.7 THEN 'warning'
WHEN metric = 'latency_p95_seconds' AND value >= 0.5 THEN 'critical' WHEN metric = 'latency_p95_seconds' AND value >= 0.2 THEN 'warning'
WHEN metric = 'error_rate' AND value >= 0.10 THEN 'critical' WHEN metric = 'error_rate' AND value >= 0.05 THEN 'warning' ELSE 'ok' END AS level FROM vals""", LEVEL_CASES))
def _(t: Tables):
    hourly = t.log.groupBy(F.date_format("ts", "yyyy-MM-dd HH").alias("day")).agg(
        F.avg("confidence").alias("confidence"),
        (F.max("latency_ms") / 1000.0).alias("latency_p95_seconds"),
        (F.count_if(t.is_error) / F.count(F.lit(1))).alias("error_rate"),
    ).withColumn("unbounded", F.col("error_rate"))
    names = ["confidence", "latency_p95_seconds", "error_rate", "unbounded"]
    rows = hourly.unpivot("day", names, "metric", "value")
    levelled = alerts.metric_levels(rows, alerts.default_levels(t.spark))
    return levelled.select("day", "metric", F.round("value", 6).alias("value"), "level")


@query("st_rule_latency_p95", sql("log", f"SELECT {START.format('start')} AS start, round(p95, 6) AS p95, p95 > 0.05 AS active FROM (SELECT start, {quantile_sql(0.95)} AS p95 FROM q)",
       windows(60, 10, f", q AS (SELECT start, {LE} FROM w GROUP BY start)")))
def _(t: Tables):
    points = metrics.latency_quantiles(t.log, t.latency_seconds, "1 hour", "10 minutes")
    return rounded(stamped(alerts.above(points, "p95", 0.05), "start").select("start", "p95", "active"))


def latency_means(t: Tables):
    log = t.log.withColumn("latency", t.latency_seconds)
    return metrics.window_mean(log, "latency", "5 minutes")


@query("st_rule_latency_mean", sql("log", f"SELECT {START.format('start')} AS start, round(m, 9) AS mean, m > 0.02 AS active FROM (SELECT start, avg(latency_ms / 1000.0::DOUBLE) AS m FROM w GROUP BY 1)", windows(5, 1)))
def _(t: Tables):
    out = stamped(alerts.above(latency_means(t), "mean", 0.02), "start")
    return out.select("start", F.round("mean", 9).alias("mean"), "active")


@query("st_rule_low_confidence", sql("log", f"SELECT {START.format('start')} AS start, round(m, 6) AS mean, m < 0.5 AS active FROM (SELECT start, avg(confidence) AS m FROM w GROUP BY 1)", windows(10, 1)))
def _(t: Tables):
    points = metrics.window_mean(t.log, "confidence", "10 minutes")
    return rounded(stamped(alerts.below(points, "mean", 0.5), "start").select("start", "mean", "active"))


@query("st_rule_absent", sql("log", f"""SELECT {START.format('g.at')} AS at FROM (SELECT unnest(generate_series(date_trunc('minute', min(ts)), date_trunc('minute', max(ts)), INTERVAL 1 MINUTE)) AS at FROM log) g
WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT date_trunc('minute', ts) AS m FROM log) s WHERE s.m > g.at - INTERVAL 5 MINUTE AND s.m <= g.at)"""))
def _(t: Tables):
    return stamped(alerts.absent(t.log), "at")


@query("st_rule_stalled", sql("log", f"""SELECT {START.format('start')} AS start, count(*) AS requests, count(*) FILTER (predicted_class = 'purchase') AS predictions,
count(*) FILTER (predicted_class = 'purchase') = 0 AS active FROM w GROUP BY 1""", windows(10, 1)))
def _(t: Tables):
    out = alerts.stalled(t.log, F.lit(True), F.col("predicted_class") == "purchase")
    return stamped(out, "start").drop("end")


HELD = """pts AS (SELECT predicted_class, start AS tick, avg(confidence) < 0.7 AS active FROM w GROUP BY 1, 2),
runs AS (SELECT *, epoch(tick) / 3600 - row_number() OVER (PARTITION BY predicted_class ORDER BY tick) AS run FROM pts WHERE active),
held AS (SELECT predicted_class, tick, min(tick) OVER (PARTITION BY predicted_class, run) AS since FROM runs),
st AS (SELECT *, CASE WHEN tick - since >= INTERVAL 3 HOUR THEN 'firing' ELSE 'pending' END AS state FROM held)"""
HELD_WINDOWS = windows(360, 60, ", " + HELD)


def held(t: Tables):
    means = metrics.window_mean(t.log, "confidence", "6 hours", "1 hour", by=["predicted_class"])
    points = alerts.below(means, "mean", 0.7).withColumnRenamed("start", "at")
    return alerts.held(points, 3 * 3600, 3600, ["predicted_class"])


@query("st_for", sql("log", f"SELECT predicted_class, {START.format('tick')} AS \"at\", {START.format('since')} AS since, state FROM st", HELD_WINDOWS))
def _(t: Tables):
    return stamped(held(t), "at", "since").select("predicted_class", "at", "since", "state")


@query("win_alert_order", sql("log", f"SELECT alert, state, since, CAST(row_number() OVER (ORDER BY state <> 'firing', alert) AS INTEGER) AS place FROM (SELECT predicted_class AS alert, state, {START.format('since')} AS since FROM st QUALIFY row_number() OVER (PARTITION BY predicted_class ORDER BY tick DESC) = 1)", HELD_WINDOWS))
def _(t: Tables):
    latest = held(t).groupBy(F.col("predicted_class").alias("alert")).agg(F.max_by(F.struct("state", "since"), "at").alias("s"))
    rows = latest.select("alert", "s.state", dates.stamp(F.col("s.since")).alias("since"))
    order = Window.partitionBy().orderBy(F.col("state") != "firing", "alert")
    return predlog.alert_order(rows).withColumn("place", F.row_number().over(order))


@query("st_inhibit", sql("log", f"SELECT {START.format('start')} AS at, alert, severity FROM a WHERE severity = 'critical' OR NOT EXISTS (SELECT 1 FROM a b WHERE b.severity = 'critical' AND b.start = a.start AND b.alert = a.alert)",
       windows(60, 60, ", m AS (SELECT start, predicted_class AS alert, avg(latency_ms) AS v FROM w GROUP BY 1, 2), a AS (SELECT start, alert, 'warning' AS severity FROM m WHERE v > 20 UNION SELECT start, alert, 'critical' FROM m WHERE v > 30)")))
def _(t: Tables):
    means = metrics.window_mean(t.log, "latency_ms", "1 hour", "1 hour", by=["predicted_class"])
    base = means.select(F.col("start").alias("at"), F.col("predicted_class").alias("alert"), "mean")
    warning = base.filter("mean > 20").select("at", "alert", F.lit("warning").alias("severity"))
    critical = base.filter("mean > 30").select("at", "alert", F.lit("critical").alias("severity"))
    return stamped(alerts.inhibit(warning.unionByName(critical)), "at")


WATCH = windows(360, 60, ", hours AS (SELECT start + INTERVAL 6 HOUR AS tick, avg(confidence) AS mean, count(*) AS n FROM w GROUP BY 1)")


@query("st_watchdog", sql("log", f"SELECT {START.format('tick')} AS \"at\", n, round(mean, 6) AS mean, mean <= 0.7 AS degraded FROM hours", WATCH))
def _(t: Tables):
    out = alerts.watchdog(t.log, threshold=0.7)
    return rounded(stamped(out, "end").select(F.col("end").alias("at"), "n", "mean", "degraded"))


COOL = WATCH + """, c AS (SELECT tick, row_number() OVER (ORDER BY tick) AS i FROM hours WHERE mean <= 0.73),
f AS (SELECT i, tick AS last, true AS hit, tick FROM c WHERE i = 1 UNION ALL
SELECT c.i, CASE WHEN c.tick - f.last >= INTERVAL 12 HOUR THEN c.tick ELSE f.last END, c.tick - f.last >= INTERVAL 12 HOUR, c.tick FROM f JOIN c ON c.i = f.i + 1)"""


@query("st_cooldown", sql("log", f"SELECT {START.format('tick')} AS \"at\" FROM f WHERE hit", COOL))
def _(t: Tables):
    checks = alerts.watchdog(t.log, threshold=0.73).filter("degraded")
    candidates = checks.select(F.lit("retrain").alias("job"), F.col("end").alias("at"))
    return stamped(alerts.cooled_triggers(candidates, ["job"]).select("at"), "at")


RULES = "(VALUES ('api_down', NULL, 60, 'critical'), ('high_latency_p95', 0.5, 300, 'warning'), ('high_latency_mean', 0.2, 300, 'warning'), " \
        "('low_mean_confidence', 0.5, 600, 'warning'), ('no_recent_predictions', NULL, 600, 'warning')) AS d(alert, threshold, for_seconds, severity)"


@query("src_thresholds", sql("log", f"""SELECT d.alert, CASE d.alert WHEN 'high_latency_p95' THEN o.p WHEN 'low_mean_confidence' THEN o.c ELSE d.threshold::DOUBLE END AS threshold,
CAST(d.for_seconds AS BIGINT) AS for_seconds, d.severity FROM {RULES}, (SELECT round(max(latency_ms) / 1000, 4) AS p, round(min(confidence), 4) AS c FROM log) o"""))
def _(t: Tables):
    # overrides measured on the log; one names a rule the defaults do not have
    o = t.log.agg(F.round(F.max("latency_ms") / 1000, 4).alias("p"), F.round(F.min("confidence"), 4).alias("c"))
    entries = F.array(
        F.struct(F.lit("high_latency_p95").alias("alert"), F.col("p").alias("threshold")),
        F.struct(F.lit("low_mean_confidence").alias("alert"), F.col("c").alias("threshold")),
        F.struct(F.lit("unknown_rule").alias("alert"), F.col("c").alias("threshold")),
    )
    overrides = o.select(F.explode(entries).alias("e")).select("e.*")
    return alerts.merged(alerts.default_rules(t.spark), overrides, "alert")
