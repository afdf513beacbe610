"""Column functions over the given tables (tables: events, documents, orders, pages)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..bindings import Tables
from ..functions import containers, dates, hashing, text
from .prelude import sql
from .registry import query


@query("fn_round", """SELECT doc_id, round(n_chars / 7.0::DOUBLE, 4) AS r4, round(n_chars / 7.0::DOUBLE, 2) AS r2, round(n_chars / 7.0::DOUBLE, 1) AS r1,
round_even(n_chars / 2.0::DOUBLE, 0) AS even FROM documents""")
def _(t: Tables):
    x = F.col("n_chars") / F.lit(7.0)
    return t.raw("documents").select(
        "doc_id", *[F.round(x, d).alias(f"r{d}") for d in (4, 2, 1)], F.bround(F.col("n_chars") / F.lit(2.0)).alias("even")
    )


@query("fn_safe_float", """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN NULL ELSE value END AS number FROM events""")
def _(t: Tables):
    # text that is a number, text that is not, and NaN
    raw = F.when(t.is_error, "NaN").when(F.col("predicted_class") == "view", F.col("props")).otherwise(
        F.col("latency_ms").cast("string")
    )
    return t.log.select("event_id", text.safe_double(raw).alias("number"))


@query("fn_format_pct", sql("log", "SELECT id, CASE WHEN predicted_class = 'view' THEN '—' ELSE printf('%.1f %%', confidence * 100) END AS pct FROM log"))
def _(t: Tables):
    value = F.when(F.col("predicted_class") != "view", F.col("confidence"))
    return t.log.select("id", text.percent_text(value).alias("pct"))


@query("fn_format_fr", "SELECT event_id, replace(printf('%.2f', value), '.', ',') AS amount, replace(format('{:,}', event_id * 977), ',', chr(160)) AS grouped FROM events")
def _(t: Tables):
    return t.log.select(
        "event_id", text.decimal_comma(F.col("latency_ms")).alias("amount"), text.thousands(F.col("event_id") * 977).alias("grouped")
    )


@query("fn_date_fr", """SELECT event_id, day(s) || ' ' || (['janvier', 'février', 'mars', 'avril', 'mai', 'juin', 'juillet', 'août', 'septembre', 'octobre', 'novembre', 'décembre'])[month(s)]
|| ' ' || year(s) || ' à ' || strftime(s, '%Hh%M') AS text FROM (SELECT event_id, ts + INTERVAL 1 HOUR * (event_id % 9000) AS s FROM events)""")
def _(t: Tables):
    # spread over the year so that every month name occurs
    spread = F.col("ts") + F.make_dt_interval(hours=(F.col("event_id") % 9000).cast("int"))
    return t.log.select("event_id", dates.date_text_fr(spread).alias("text"))


LOCAL = "SELECT event_id, (s AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS l, s FROM (SELECT event_id, ts + INTERVAL 1 HOUR * (event_id % 9000) AS s FROM events)"


@query("fn_local_time", f"""SELECT event_id, strftime(l, '%d/%m/%Y %H:%M:%S') || CASE WHEN l - s = INTERVAL 2 HOUR THEN ' (CEST)' ELSE ' (CET)' END AS "full",
strftime(l, '%d/%m/%Y %H:%M:%S') AS datetime, strftime(l, '%d/%m %H:%M') AS compact, strftime(l, '%H:%M:%S') AS time, strftime(l, '%d/%m/%Y') AS date,
strftime(l, '%Y-%m-%dT%H:%M:%S') || CASE WHEN l - s = INTERVAL 2 HOUR THEN '+0200' ELSE '+0100' END AS iso FROM ({LOCAL})""")
def _(t: Tables):
    spread = F.col("ts") + F.make_dt_interval(hours=(F.col("event_id") % 9000).cast("int"))
    return t.log.select("event_id", *[dates.local_time(spread, f).alias(f) for f in dates.LOCAL_FORMATS])


@query("fn_parse_iso", """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS parsed FROM events""")
def _(t: Tables):
    # nanosecond fraction with Z, offset form, and text that is no time
    base = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    shifted = F.date_format(F.col("ts") + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    raw = F.when(t.is_error, "not a time").when(F.col("predicted_class") == "click", F.concat(shifted, F.lit("+02:00"))).otherwise(
        F.concat(base, F.lit("123Z"))
    )
    return t.log.select("event_id", F.date_format(dates.parse_iso(raw), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("parsed"))


@query("fn_duration", """SELECT event_id, CASE WHEN event_type = 'error' THEN '-' ELSE (event_id % 7000) // 60 || 'm' || lpad(CAST((event_id % 7000) % 60 AS VARCHAR), 2, '0') || 's' END AS duration FROM events""")
def _(t: Tables):
    start = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    end = F.date_format(F.col("ts") + F.make_dt_interval(secs=F.col("event_id") % 7000), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return t.log.select("event_id", dates.duration_text(start, F.when(~t.is_error, end)).alias("duration"))


@query("fn_floor_hour", "SELECT event_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour FROM events")
def _(t: Tables):
    return t.log.select("event_id", dates.stamp(dates.floor_hour(F.col("ts"))).alias("hour"))


@query("fn_parse_filename_ts", """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:00') END AS at FROM events""")
def _(t: Tables):
    name = F.when(t.is_error, "drift_latest.html").otherwise(
        F.concat(F.lit("drift_"), F.date_format("ts", "yyyyMMdd_HHmm"), F.lit(".html"))
    )
    return t.log.select("event_id", dates.stamp(dates.report_timestamp(name)).alias("at"))


@query("fn_file_parts", """SELECT page_id, name, CASE WHEN regexp_matches(name, '^.+\\.[^.]+$') THEN regexp_replace(name, '\\.[^.]*$', '') ELSE name END AS stem,
lower(regexp_extract(name, '^.+(\\.[^.]+)$', 1)) AS extension FROM (SELECT page_id, list_last(string_split(url, '/')) AS name FROM pages)""")
def _(t: Tables):
    pages = t.raw("pages").select("page_id", text.file_name(F.col("url")).alias("name"))
    return pages.select("page_id", "name", text.file_stem(F.col("name")).alias("stem"), text.file_extension(F.col("name")).alias("extension"))


@query("fn_sha256", "SELECT doc_id, sha256(text) AS hash FROM documents")
def _(t: Tables):
    return t.raw("documents").select("doc_id", hashing.content_hash(F.col("text")).alias("hash"))


@query("fn_json_array", sql("log", """SELECT id, '[{"species":"' || predicted_class || '","confidence":0.5,"rank":1},{"species":"other","confidence":0.25,"rank":2}]' AS json, predicted_class AS first, 2 AS size FROM log"""))
def _(t: Tables):
    items = F.array(
        F.struct(F.col("predicted_class").alias("species"), F.lit(0.5).alias("confidence"), F.lit(1).alias("rank")),
        F.struct(F.lit("other").alias("species"), F.lit(0.25).alias("confidence"), F.lit(2).alias("rank")),
    )
    rows = t.log.select("id", text.to_json_array(items).alias("json")).withColumn("back", text.from_json_array(F.col("json")))
    return rows.select("id", "json", F.col("back")[0]["species"].alias("first"), F.size("back").alias("size"))


@query("fn_status_label", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'EN COURS' WHEN o_orderstatus = 'P' THEN 'EN ATTENTE' ELSE
CASE o_orderpriority WHEN '1-URGENT' THEN 'SUCCES' WHEN '2-HIGH' THEN 'ECHEC' WHEN '3-MEDIUM' THEN 'ANNULE' WHEN '5-LOW' THEN 'INCONNU' ELSE upper(o_orderpriority) END END AS label FROM orders""")
def _(t: Tables):
    status = F.when(F.col("o_orderstatus") == "O", "in_progress").when(F.col("o_orderstatus") == "P", "queued").otherwise("completed")
    p = F.col("o_orderpriority")
    conclusion = F.when(p == "1-URGENT", "success").when(p == "2-HIGH", "failure").when(p == "3-MEDIUM", "cancelled").when(p != "5-LOW", p)
    return t.raw("orders").select("o_orderkey", text.status_label(status, conclusion).alias("label"))


WORDS = [("the by", "BY-THE"), ("the", "THE"), ("la", "LA"), ("The", "THÉ")]
NESTED = "text"
for _old, _new in WORDS:
    for _ in range(2):
        NESTED = f"regexp_replace({NESTED}, '(^|[^\\pL\\pM\\pN_]){_old}([^\\pL\\pM\\pN_]|$)', '\\1{_new}\\2', 'g')"


@query("fn_dictionary_replace", f"SELECT doc_id, md5({NESTED}) AS digest FROM documents")
def _(t: Tables):
    return t.raw("documents").select("doc_id", F.md5(text.replace_words(F.col("text"), WORDS)).alias("digest"))


# --- container statistics derived from the event log -----------------------------------

def stats(t: Tables):
    """Statistics JSON of one container per event, parsed back."""
    e, v = F.col("event_id"), F.col("latency_ms")
    scaled = (v * 100).cast("bigint")
    usage = F.struct((e + scaled).alias("total_usage"))
    doc = F.struct(
        F.struct(usage.alias("cpu_usage"), (e * 10 + 5000).alias("system_cpu_usage"), F.lit(4).alias("online_cpus")).alias("cpu_stats"),
        F.struct(F.struct(e.alias("total_usage")).alias("cpu_usage"), F.when(F.col("predicted_class") != "view", e * 10).alias("system_cpu_usage")).alias("precpu_stats"),
        F.struct(
            (scaled + 100).alias("usage"), F.when(F.col("predicted_class") != "click", F.lit(40960)).alias("limit"),
            F.struct(F.lit(300).alias("inactive_file")).alias("stats"),
        ).alias("memory_stats"),
        F.when(F.col("predicted_class") != "signup", F.create_map(
            F.lit("eth0"), F.struct(e.alias("rx_bytes"), (e * 2).alias("tx_bytes")),
            F.lit("eth1"), F.struct(F.lit(7).cast("bigint").alias("rx_bytes"), F.lit(9).cast("bigint").alias("tx_bytes")),
        )).alias("networks"),
        F.struct(F.array(
            F.struct(F.lit("Read").alias("op"), scaled.alias("value")), F.struct(F.lit("wbytes").alias("op"), (scaled * 3).alias("value")),
            F.struct(F.lit("rbytes").alias("op"), F.lit(11).cast("bigint").alias("value")), F.struct(F.lit("sync").alias("op"), e.alias("value")),
        ).alias("io_service_bytes_recursive")).alias("blkio_stats"),
    )
    status = F.when(t.is_error, "exited").otherwise("running")
    return t.log.select("event_id", status.alias("status"), F.from_json(F.to_json(doc), containers.STATS_SCHEMA).alias("stats"))


CONTAINER = """k AS (SELECT event_id, event_type AS et, event_type <> 'error' AS on_, CAST(trunc(value * 100) AS BIGINT) AS s FROM events),
g AS (SELECT event_id, et, on_, s, event_id * 10 + 5000 - CASE WHEN et <> 'view' THEN event_id * 10 ELSE 0 END AS sys, greatest(s + 100 - 300, 0) AS mem FROM k)"""


@query("fn_cpu_percent", f"WITH {CONTAINER} SELECT event_id, CASE WHEN sys > 0 AND s >= 0 THEN round(s / sys * 4 * 100.0::DOUBLE, 2) ELSE 0.0 END AS cpu_percent FROM g")
def _(t: Tables):
    return stats(t).select("event_id", containers.cpu_percent(F.col("stats")).alias("cpu_percent"))


@query("fn_mem_percent", f"WITH {CONTAINER} SELECT event_id, CASE WHEN et <> 'click' THEN round(mem / 40960.0::DOUBLE * 100.0::DOUBLE, 2) ELSE 0.0 END AS memory_percent FROM g")
def _(t: Tables):
    return stats(t).select("event_id", containers.memory_percent(F.col("stats")).alias("memory_percent"))


@query("fn_map_sum", f"WITH {CONTAINER} SELECT event_id, CASE WHEN et <> 'signup' THEN event_id + 7 ELSE 0 END AS rx, CASE WHEN et <> 'signup' THEN event_id * 2 + 9 ELSE 0 END AS tx FROM g")
def _(t: Tables):
    nets = F.col("stats.networks")
    return stats(t).select("event_id", containers.map_sum(nets, "rx_bytes").alias("rx"), containers.map_sum(nets, "tx_bytes").alias("tx"))


@query("fn_array_filter_sum", f"WITH {CONTAINER} SELECT event_id, s + 11 AS block_read, s * 3 AS block_write FROM g")
def _(t: Tables):
    ops = F.col("stats.blkio_stats.io_service_bytes_recursive")
    return stats(t).select(
        "event_id", containers.op_sum(ops, containers.READ_OPS).alias("block_read"), containers.op_sum(ops, containers.WRITE_OPS).alias("block_write")
    )


@query("st_container_metrics", f"""WITH {CONTAINER} SELECT event_id, CAST(on_ AS INTEGER) AS up, CASE WHEN on_ AND sys > 0 AND s >= 0 THEN round(s / sys * 4 * 100.0::DOUBLE, 2) ELSE 0.0 END AS cpu_percent,
CASE WHEN on_ THEN mem ELSE 0 END::DOUBLE AS memory_usage, CASE WHEN on_ AND et <> 'click' THEN 40960 ELSE 0 END::DOUBLE AS memory_limit,
CASE WHEN on_ AND et <> 'click' THEN round(mem / 40960.0::DOUBLE * 100.0::DOUBLE, 2) ELSE 0.0 END AS memory_percent,
CASE WHEN on_ AND et <> 'signup' THEN event_id + 7 ELSE 0 END::DOUBLE AS network_rx, CASE WHEN on_ AND et <> 'signup' THEN event_id * 2 + 9 ELSE 0 END::DOUBLE AS network_tx,
CASE WHEN on_ THEN s + 11 ELSE 0 END::DOUBLE AS block_read, CASE WHEN on_ THEN s * 3 ELSE 0 END::DOUBLE AS block_write FROM g""")
def _(t: Tables):
    rows = stats(t)
    return rows.select("event_id", *containers.container_metrics(F.col("status"), F.col("stats")))


@query("st_utilisation", """SELECT day, round(100.0::DOUBLE - avg(value), 9) AS cpu_used_percent, round((1.0::DOUBLE - sum(value) / (count(*) * 400.0::DOUBLE)) * 100.0::DOUBLE, 9) AS memory_used_percent FROM (
SELECT strftime(ts, '%Y-%m-%d') AS day, value FROM events) GROUP BY 1""")
def _(t: Tables):
    from ..streaming import metrics

    # the value of an event read as an idle percentage, and as free space of 400 units
    rows = t.log.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), (F.col("latency_ms") / 100.0).alias("rate"), "latency_ms")
    cpu = metrics.idle_to_used_percent(rows, ["day"])
    memory = rows.groupBy("day").agg(
        (metrics.used_percent(F.sum("latency_ms"), F.count(F.lit(1)) * 400.0)).alias("memory_used_percent")
    )
    return cpu.join(memory, "day").select("day", F.round("cpu_used_percent", 9).alias("cpu_used_percent"), F.round("memory_used_percent", 9).alias("memory_used_percent"))


RATED = ["network_rx", "network_tx", "block_read", "block_write"]


@query("st_container_rates", """WITH c AS (SELECT user_id, ts, event_id, unnest(['network_rx', 'network_tx', 'block_read', 'block_write']) AS metric,
unnest([CAST(event_id % 997 AS DOUBLE), CAST(event_id * 2 % 1009 AS DOUBLE), CAST(event_id * 3 % 1013 AS DOUBLE), CAST(event_id * 5 % 1019 AS DOUBLE)]) AS value FROM events),
s AS (SELECT *, value - lag(value) OVER (PARTITION BY user_id, metric ORDER BY ts, value) AS step FROM c)
SELECT strftime(time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '2024-01-01'), '%Y-%m-%d %H:%M:%S') AS start, user_id, metric,
round(sum(CASE WHEN step IS NULL THEN 0.0 WHEN step < 0 THEN value ELSE step END) / 3600.0::DOUBLE, 6) AS rate FROM s GROUP BY ALL""")
def _(t: Tables):
    """Network and block counters of each user, which reset when they fall, as rates by the second and hour."""
    from ..streaming import metrics

    event = F.col("event_id")
    values = [event % 997, event * 2 % 1009, event * 3 % 1013, event * 5 % 1019]
    each = F.array(*[F.struct(F.lit(n).alias("metric"), v.cast("double").alias("value")) for n, v in zip(RATED, values, strict=True)])
    samples = t.log.select("user_id", "ts", F.explode(each).alias("c")).select("user_id", "ts", "c.*")
    rates = metrics.counter_rate(samples, ["user_id", "metric"], ["user_id", "metric"], "1 hour", "1 hour")
    return rates.select(dates.stamp(F.col("start")).alias("start"), "user_id", "metric", F.round("rate", 6).alias("rate"))
