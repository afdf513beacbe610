"""Vector scores, score reports, top-n and model application (table: embeddings)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..bindings import LOGIT_COUNT, Tables
from ..functions import vectors
from ..operators import evaluate, predlog, quality
from .curation import rounded
from .prelude import sql
from .registry import query

MODEL = "cosine-7"
LEDGER = """ledger AS (SELECT item, species, CASE WHEN score_final IS NULL THEN 'unreadable' ELSE 'low_score' END AS reason, 0.03::DOUBLE AS threshold, 'cosine-7' AS model,
round(score_positive, 4) AS score_positive, round(score_negative, 4) AS score_negative, round(score_final, 4) AS score_final FROM scores WHERE score_final IS NULL OR score_final < 0.03)"""


@query("vec_prompt_score", sql("scores", "SELECT item, species, round(score_positive, 6) AS score_positive, round(score_negative, 6) AS score_negative, round(score_final, 6) AS score_final FROM scores"))
def _(t: Tables):
    return rounded(t.scores.select("item", "species", "score_positive", "score_negative", "score_final"))


@query("flt_score", sql("scores", "SELECT item, score_final >= 0.03 AS passed FROM scores WHERE score_final IS NOT NULL"))
def _(t: Tables):
    ok = quality.passed(t.scores).select("item", F.lit(True).alias("passed"))
    return ok.unionByName(quality.failed(t.scores).select("item", F.lit(False).alias("passed")))


@query("flt_unreadable", sql("scores", "SELECT item, score_final IS NOT NULL AS readable FROM scores"))
def _(t: Tables):
    good = quality.readable(t.scores).select("item", F.lit(True).alias("readable"))
    return good.unionByName(quality.unreadable(t.scores).select("item", F.lit(False).alias("readable")))


@query("prj_exclusions", sql("scores", "SELECT * FROM ledger", LEDGER))
def _(t: Tables):
    return quality.exclusions(t.scores, quality.SCORE_THRESHOLD, MODEL)


@query("flt_reason_page", sql("scores", "SELECT item, species, score_final FROM ledger WHERE reason = 'low_score' ORDER BY item, species LIMIT 200", LEDGER))
def _(t: Tables):
    ledger = quality.exclusions(t.scores, quality.SCORE_THRESHOLD, MODEL)
    return quality.reason_page(ledger, quality.REASON_LOW_SCORE).select("item", "species", "score_final")


PASS = "SELECT species, count(*) AS total, count(*) FILTER (score_final >= 0.03) AS kept, count(*) - count(*) FILTER (score_final >= 0.03) AS excluded FROM scores GROUP BY species"


@query("agg_class_pass", sql("scores", PASS))
def _(t: Tables):
    return quality.class_pass(t.scores)


@query("jn_kept", sql("scores", PASS))
def _(t: Tables):
    return quality.kept_by_join(t.scores, quality.passed(t.scores))


@query("agg_quality_stats", sql("scores", """SELECT count(*) AS total, count(score_final) AS valid, count(*) - count(score_final) AS unreadable,
count(*) FILTER (score_final >= 0.03) AS passed, count(*) FILTER (score_final < 0.03) AS failed, round(min(score_final), 4) AS min, round(max(score_final), 4) AS max,
round(avg(score_final), 4) AS mean, round(stddev_samp(score_final), 4) AS std, round(quantile_cont(score_final, 0.05), 4) AS q05, round(quantile_cont(score_final, 0.25), 4) AS q25,
round(quantile_cont(score_final, 0.5), 4) AS q50, round(quantile_cont(score_final, 0.75), 4) AS q75, round(quantile_cont(score_final, 0.95), 4) AS q95 FROM scores"""))
def _(t: Tables):
    return quality.score_stats(t.scores)


@query("agg_cleaning_update", sql("scores", """SELECT count(*) AS before_total, count(*) FILTER (score_final >= 0.03) AS after_total,
count(DISTINCT CASE WHEN score_final >= 0.03 THEN species END) AS after_classes, count(*) FILTER (score_final < 0.03) AS excluded_by_score,
count(*) FILTER (score_final IS NULL) AS excluded_unreadable, (SELECT count(*) FROM documents) - count(*) FILTER (score_final >= 0.03) AS excluded_total FROM scores"""))
def _(t: Tables):
    return quality.cleaning_update(t.scores, t.raw("documents").select("doc_id"))


@query("agg_hist_equal", sql("scores", """SELECT i.bin, round(lo + i.bin * w, 6) AS low, round(lo + (i.bin + 1) * w, 6) AS high, count(s.score_final) AS count
FROM (SELECT unnest(range(60)) AS bin) i CROSS JOIN (SELECT min(score_final) AS lo, (max(score_final) - min(score_final)) / 60 AS w, max(score_final) AS hi FROM scores) m
LEFT JOIN scores s ON least(floor((s.score_final - m.lo) / (m.hi - m.lo) * 60), 59) = i.bin GROUP BY ALL"""))
def _(t: Tables):
    return rounded(quality.equal_width_histogram(t.scores))


@query("agg_hist_marks", sql("scores", "SELECT unnest(['q05', 'q25', 'q50', 'q75', 'q95']) AS mark, unnest([round(x, 3) FOR x IN quantile_cont(score_final, [0.05, 0.25, 0.5, 0.75, 0.95])]) AS value FROM scores"))
def _(t: Tables):
    """Quantile marks of the histogram ``agg_hist_equal``."""
    return quality.quantile_marks(t.scores)


@query("agg_threshold_sweep", sql("scores", """SELECT t AS threshold, count(*) FILTER (score_final >= t) AS passed, round(count(*) FILTER (score_final >= t) * 100.0::DOUBLE / count(score_final), 1) AS percent
FROM scores, (SELECT unnest([-0.05, 0.0, 0.05, 0.1, 0.15])::DOUBLE AS t) GROUP BY t"""))
def _(t: Tables):
    return quality.threshold_sweep(t.scores)


@query("win_panels", sql("scores", """SELECT panel, item, round(score_final, 6) AS score_final FROM (
(SELECT 'top' AS panel, * FROM scores WHERE score_final IS NOT NULL ORDER BY score_final DESC, item LIMIT 20) UNION ALL
(SELECT 'bottom', * FROM scores WHERE score_final IS NOT NULL ORDER BY score_final, item LIMIT 20) UNION ALL
(SELECT 'borderline', * FROM scores WHERE score_final IS NOT NULL ORDER BY abs(score_final - 0.03), item LIMIT 20))"""))
def _(t: Tables):
    return rounded(quality.panels(t.scores).select("panel", "item", "score_final"))


@query("fn_l2_normalise", sql("unit", "SELECT vec_id, round(list_sum(vec), 6) AS total, round(list_dot_product(vec, vec), 6) AS norm, round(vec[1], 6) AS first FROM unit"))
def _(t: Tables):
    unit = t.vectors.select("vec_id", vectors.normalise(F.col("vec")).alias("v"))
    return unit.select(
        "vec_id", F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x), 6).alias("total"),
        F.round(vectors.dot(F.col("v"), F.col("v")), 6).alias("norm"), F.round(F.col("v")[0], 6).alias("first"),
    )


@query("fn_softmax", sql("probs", "SELECT vec_id, CAST(generate_subscripts(p, 1) - 1 AS INTEGER) AS idx, round(unnest(p), 6) AS prob FROM probs"))
def _(t: Tables):
    probs = t.logits.select("vec_id", F.posexplode(vectors.softmax(F.col("logits"))).alias("idx", "prob"))
    return rounded(probs)


@query("fn_argmax", sql("logits", "SELECT vec_id, CAST(list_position(logits, list_max(logits)) - 1 AS INTEGER) AS idx, round(list_max(logits), 6) AS best FROM logits"))
def _(t: Tables):
    v = F.col("logits")
    return t.logits.select("vec_id", vectors.argmax(v).alias("idx"), F.round(F.array_max(v), 6).alias("best"))


TOP = """ranked AS (SELECT vec_id, prob, i - 1 AS idx, row_number() OVER (PARTITION BY vec_id ORDER BY prob DESC, i) AS rank
FROM (SELECT vec_id, generate_subscripts(p, 1) AS i, unnest(p) AS prob FROM probs))"""


@query("win_topn_array", sql("probs", """SELECT vec_id, CASE WHEN idx < 9 THEN 'label_' || idx ELSE 'class_' || idx END AS species, round(prob, 6) AS confidence,
CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 5""", TOP))
def _(t: Tables):
    top = vectors.top_n(vectors.softmax(F.col("logits")), 5, t.class_names)
    rows = t.logits.select("vec_id", F.explode(top).alias("t")).select("vec_id", "t.*")
    return rounded(rows)


@query("win_top3_columns", sql("probs", """SELECT vec_id, max(CASE WHEN rank = 1 THEN idx END) AS label_1, round(max(CASE WHEN rank = 1 THEN prob END), 6) AS score_1,
max(CASE WHEN rank = 2 THEN idx END) AS label_2, round(max(CASE WHEN rank = 2 THEN prob END), 6) AS score_2,
max(CASE WHEN rank = 3 THEN idx END) AS label_3, round(max(CASE WHEN rank = 3 THEN prob END), 6) AS score_3 FROM ranked GROUP BY vec_id""", TOP))
def _(t: Tables):
    names = F.array(*[F.lit(str(i)) for i in range(LOGIT_COUNT)])
    top = t.logits.withColumn("t", vectors.top_n(vectors.softmax(F.col("logits")), 3, names))
    columns = []
    for i in range(3):
        columns.append(F.col("t")[i]["species"].cast("bigint").alias(f"label_{i + 1}"))
        columns.append(F.round(F.col("t")[i]["confidence"], 6).alias(f"score_{i + 1}"))
    return top.select("vec_id", *columns)


@query("flt_topk_overlap", sql("probs", "SELECT DISTINCT vec_id FROM ranked WHERE rank <= 3 AND idx IN (1, 4)", TOP))
def _(t: Tables):
    top = t.logits.withColumn("t", vectors.top_n(vectors.softmax(F.col("logits")), 5, t.class_names))
    labels = F.transform("t", lambda x: x["species"])
    return top.filter(predlog.top_labels_allowed(labels, ["label_1", "label_4"])).select("vec_id")


@query("vec_output_parity", sql("logits", """SELECT round(max(d), 9) AS max_abs_diff, round(avg(d), 9) AS mean_abs_diff, bool_and(d < 0.0001) AS all_match FROM (
SELECT vec_id, list_max(list_transform(logits, lambda x: abs(x - (x + x * 0.00001)))) AS d FROM logits)"""))
def _(t: Tables):
    other = t.logits.withColumn("logits", F.transform("logits", lambda x: x + x * 0.00001))
    parity = evaluate.output_parity(t.logits, other, "vec_id", "logits")
    return parity.withColumns({c: F.round(c, 9) for c in ("max_abs_diff", "mean_abs_diff")})
