"""Golden values, hand cases, edge rows and properties."""

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievemark import plans  # noqa: F401  (fills the registry)
from sievemark.bindings import Tables
from sievemark.functions import dates, text, vectors
from sievemark.operators import baseline, canary, curate, distribution, drift, evaluate, predlog, quality, ranking, runs, sample, split
from sievemark.plans.registry import QUERIES
from sievemark.sources import readers, writers
from sievemark.streaming import alerts, metrics

# Golden values of FIXTURES.md: kept, train, val, test per class.
SPLIT_GOLDEN = """94 66 14 14|593 415 89 89|3396 2377 509 510|981 687 147 147|714 500 107 107|757 530 113 114|112 78 17 17
1919 1343 288 288|244 171 37 36|286 200 43 43|1020 714 153 153|197 138 30 29|445 312 66 67|1116 781 167 168|475 332 71 72
443 310 66 67|280 196 42 42|434 304 65 65|171 120 26 25|1614 1130 242 242|257 180 38 39|54 38 8 8|115 81 17 17|97 68 15 14
212 148 32 32|62 43 10 9|162 113 25 24|872 610 131 131|414 290 62 62|1602 1121 240 241"""


def one(df):
    return df.collect()[0].asDict()


def test_split_quotas_golden(spark):
    rows = [tuple(map(int, r.split())) for r in SPLIT_GOLDEN.replace("\n", "|").split("|")]
    counts = spark.createDataFrame([(f"c{i:02d}", r[0]) for i, r in enumerate(rows)], "label string, n bigint")
    got = [(r.n, r.train, r.val, r.test) for r in split.split_quotas(counts, "label").orderBy("label").collect()]
    assert got == rows
    assert [sum(c) for c in zip(*got)] == [19138, 13396, 2870, 2872]


def test_split_rejects_ratios(spark):
    counts = spark.createDataFrame([("a", 10)], "label string, n bigint")
    with pytest.raises(ValueError):
        split.split_quotas(counts, "label", 0.9, 0.1)


def skewed(spark, n=3000):
    return spark.range(n).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 7).cast("string"))).alias("c"))


def test_split_matches_direct_rank_and_partitioning(spark):
    df = skewed(spark)
    a = {r.k: r.split for r in split.stratified_split(df, "c", "k").collect()}
    b = {r.k: r.split for r in split.stratified_split(df.repartition(7), "c", "k").collect()}
    assert a == b and len(a) == 3000
    quotas = {r.c: r for r in split.split_quotas(df.groupBy("c").agg(F.count("*").alias("n")), "c").collect()}
    stats = {r.c: r for r in split.split_stats(split.stratified_split(df, "c", "k"), "c").collect()}
    assert all((stats[c].train, stats[c].val, stats[c].test) == (q.train, q.val, q.test) for c, q in quotas.items())


def test_class_rank_equals_row_number(spark):
    from pyspark.sql import Window

    df, digest = skewed(spark), F.md5(F.col("k").cast("string"))
    direct = df.withColumn("want", F.row_number().over(Window.partitionBy("c").orderBy(digest, "k")))
    both = direct.join(ranking.class_rank(df, "c", digest, "k", digits=1).select("k", "rank"), "k")
    assert both.filter("want <> rank").count() == 0


def test_group_split_never_leaks(spark):
    df = skewed(spark).withColumn("g", F.concat_ws("::", "c", (F.col("k") % 500).cast("string")))
    out = split.group_split(df, "c", "g")
    assert split.leaking_groups(out, "g").count() == 0
    assert split.coverage_gaps(df, out, "k").count() == 0


def test_weighted_sample_is_balanced(spark):
    rows = sample.weighted_sample(skewed(spark), "c", "k").groupBy("c").count().collect()
    assert sum(r["count"] for r in rows) == 3000
    assert max(r["count"] for r in rows) < 2 * min(r["count"] for r in rows)


def test_rebalance_bounds(spark):
    out = sample.rebalance(skewed(spark), "c", "k", high=900, low=850)
    sizes = {r.c: r["count"] for r in out.groupBy("c").count().collect()}
    assert sizes.pop("hot") == 900 and set(sizes.values()) == {850}


def test_copies_across_ranges(spark):
    df = spark.createDataFrame([("x.jpg", 5), ("x.jpg", 250_000), ("x.jpg", 100_001), ("y.jpg", 1)], "image string, o bigint")
    got = {r.o: r.unique_name for r in sample.suffix_copies(df, "image", "o").collect()}
    assert got == {5: "x.jpg", 100_001: "x_1.jpg", 250_000: "x_2.jpg", 1: "y.jpg"}


def test_weights_hand_cases(spark):
    df = spark.createDataFrame([("a", i) for i in range(4)] + [("b", 9)], "c string, k int")
    assert {r.weight for r in sample.class_weights(df, "c").collect()} == {0.25, 1.0}


def test_conflict_and_nan(spark):
    rows = [(1, "i", "a", 95.0), (2, "i", None, 95.0), (3, "j", "a", float("nan")), (4, "k", "a", 92.0), (5, "k", "b", 1.0), (6, "m", "a", None)]
    obs = spark.createDataFrame(rows, "ord int, item string, species string, confidence double")
    assert {r.ord for r in curate.confident(obs).collect()} == {1, 2, 4}
    assert [r.item for r in curate.conflicting_items(obs).collect()] == ["k"]
    assert curate.keep_first(obs).count() == 4


def test_empty_inputs(spark):
    log = spark.createDataFrame([], "predicted_class string, confidence double")
    assert one(baseline.global_baseline(log)) == {"top1_accuracy": 0.0, "confidence_mean": 0.0, "confidence_p10": 0.0, "confidence_p50": 0.0, "confidence_p95": 0.0}
    assert [r["count"] for r in baseline.edge_histogram(log, "confidence").collect()] == [0] * 7
    with pytest.raises(ValueError):
        drift.drift_job(log, log, require_rows=True)
    assert one(drift.drift_job(log, log))["status"] == "no_data"


@pytest.mark.parametrize("n", [1, 2, 5, 997])
def test_quantiles_exact(spark, n):
    values = [round(math.sin(i * 7.3), 2) for i in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    got = one(distribution.quantiles(df, F.col("v"), {"a": 0.05, "b": 0.5, "c": 0.95}))
    assert np.allclose(list(got.values()), np.quantile(values, [0.05, 0.5, 0.95]))


def test_drift_extremes(spark):
    a = spark.createDataFrame([("x", i / 100) for i in range(100)], "predicted_class string, confidence double")
    b = spark.createDataFrame([("y", 2 + i / 100) for i in range(100)], "predicted_class string, confidence double")
    assert one(drift.jensen_shannon(a, a))["divergence"] == 0.0
    assert one(drift.jensen_shannon(a, b))["divergence"] == pytest.approx(1.0)
    assert one(drift.ks(a, a)) == {"statistic": 0.0, "p_value": 1.0}
    assert one(drift.ks(a, b))["statistic"] == 1.0
    assert one(drift.wasserstein(a, b))["distance"] == pytest.approx(2.0)
    assert one(drift.psi(a, a))["psi"] == 0.0


def test_chi_square_against_mllib(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    for classes in (3, 4, 6):
        df = spark.range(600).select((F.col("id") * F.col("id") % classes).alias("v"), (F.col("id") % 5 < 2).alias("s"))
        rows = df.select(F.col("v").cast("string").alias("predicted_class"), "s", "v")
        ours = one(drift.chi_square(rows.filter("not s"), rows.filter("s")))
        data = VectorAssembler(inputCols=["v"], outputCol="f").transform(df.withColumn("l", F.col("s").cast("double")))
        theirs = ChiSquareTest.test(data, "f", "l").first()
        assert ours["statistic"] == pytest.approx(theirs.statistics[0]) and ours["df"] == theirs.degreesOfFreedom[0]
        assert ours["p_value"] == pytest.approx(theirs.pValues[0], abs=1e-9)


def test_verdict_order(spark):
    cases = [(0, True, 1.0, "no_data"), (199, True, 1.0, "insufficient"), (200, None, 0.5, "drift"), (200, False, 1.0, "stable"), (200, None, None, "stable")]
    df = spark.createDataFrame(cases, "n int, flag boolean, share double, want string")
    assert df.filter(drift.verdict(F.col("n"), F.col("flag"), F.col("share")) != F.col("want")).count() == 0


def test_early_stop_hand_cases(spark):
    def run(values, **kw):
        df = spark.createDataFrame([("r", i + 1, v) for i, v in enumerate(values)], "run_id string, step bigint, value double")
        return one(runs.early_stop(df, **kw))

    assert run([0.5, 0.6, 0.7, 0.8], patience=3)["stop_step"] == 4
    free = run([1.0, 1.1, 1.2, 0.5], patience=3)
    assert free["stop_step"] is None and free["best_value"] == 0.5
    top = run([0.8, 0.9, 0.85, 0.88], patience=2, mode="max")
    assert top["stop_step"] == 4 and top["best_value"] == 0.9
    assert run([1.0, 0.995], patience=2, min_delta=0.01)["counter"] == 1


def test_levels_on_bounds(spark):
    df = spark.createDataFrame([("latency_p95_seconds", 0.2), ("latency_p95_seconds", 0.5), ("confidence", 0.7), ("confidence", 0.5), ("confidence", None)], "metric string, value double")
    got = [r.level for r in alerts.metric_levels(df, alerts.default_levels(spark)).orderBy("metric", F.desc("value")).collect()]
    assert got == ["warning", "critical", "unknown", "critical", "warning"]


def test_cooldown_bounds(spark):
    base = datetime(2024, 1, 1)
    times = [base, base + timedelta(hours=11, minutes=59), base + timedelta(hours=12), base + timedelta(hours=23), base + timedelta(hours=24)]
    df = spark.createDataFrame([("j", t) for t in times], "job string, at timestamp")
    assert [r.at for r in alerts.cooled_triggers(df, ["job"]).orderBy("at").collect()] == [times[0], times[2], times[4]]


def test_counter_reset_and_held(spark):
    base = datetime(2024, 1, 1)
    df = spark.createDataFrame([("s", base + timedelta(minutes=i), v) for i, v in enumerate([5.0, 7.0, 2.0, 3.0])], "s string, ts timestamp, value double")
    assert [r.increase for r in metrics.counter_increase(df, ["s"]).orderBy("ts").collect()] == [0.0, 2.0, 2.0, 1.0]
    points = spark.createDataFrame([(base + timedelta(minutes=i), a) for i, a in enumerate([True, True, False, True, True, True])], "at timestamp, active boolean")
    assert [r.state for r in alerts.held(points, 120, 60).orderBy("at").collect()] == ["pending", "pending", "pending", "pending", "firing"]


def test_texts(spark):
    row = one(spark.range(1).select(
        dates.local_time(F.lit("2026-05-19T19:24:17.575759+00:00")).alias("full"),
        dates.local_time(F.lit(None).cast("string")).alias("none"),
        text.base_id(F.lit("705_12")).alias("base"), text.base_id(F.lit("705")).alias("plain"),
        text.percent_text(F.lit(None).cast("double")).alias("dash"), text.decimal_comma(F.lit(0.125)).alias("half"),
        dates.duration_text(F.lit("x"), F.lit("y")).alias("bad"),
        dates.date_text_fr(F.lit("2026-05-21 23:12:00").cast("timestamp")).alias("day"),
        text.replace_words(F.lit("uné un run un."), [("un", "X")]).alias("words"),
    ))
    assert row == {"full": "19/05/2026 21:24:17 (CEST)", "none": "", "base": "705", "plain": "705", "dash": "—", "half": "0,12", "bad": "-", "day": "21 mai 2026 à 23h12", "words": "uné X run X."}
    with pytest.raises(ValueError):
        dates.local_time(F.lit("x"), "nope")


def test_evaluation_hand_case(spark):
    pairs = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "y_true int, y_pred int")
    assert one(evaluate.f1_macro(pairs))["f1_macro"] == pytest.approx((2 / 3 + 0.5 + 0.0) / 3)
    total = evaluate.confusion_matrix(pairs, "all").agg(F.sum("value").alias("s"), F.count("*").alias("n"))
    assert one(total) == {"s": 1.0, "n": 9}


def test_arrow_scores_equal_native(spark):
    rng = np.random.default_rng(0)
    mat = rng.normal(size=(40, 8))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(mat)] + [(99, None)], "k int, vec array<double>")
    pos, neg = df.filter("k < 3").select("vec"), df.filter("k in (3,4,5,6)").select("vec")
    native = {r.k: r for r in quality.prompt_scores(df, pos, neg).collect()}
    unit = mat / np.linalg.norm(mat, axis=1, keepdims=True)
    want = (unit @ unit[:3].T).max(axis=1) - (unit @ unit[3:7].T).max(axis=1)
    assert native[99].score_final is None
    assert all(native[k].score_final == pytest.approx(want[k]) for k in range(40))


def test_top_n_clamps_and_ties(spark):
    names = F.array(F.lit("a"), F.lit("b"))
    row = spark.range(1).select(vectors.top_n(F.array(F.lit(0.2), F.lit(0.4), F.lit(0.4)), 9, names).alias("t")).first()
    assert [(x.species, x.rank) for x in row.t] == [("b", 1), ("class_2", 2), ("a", 3)]


def test_canary_share(spark):
    arms = spark.range(20000).select(canary.arm(F.col("id")).alias("a")).groupBy("a").count().collect()
    share = {r.a: r["count"] / 20000 for r in arms}["candidate"]
    assert abs(share - 0.10) < 0.01
    with pytest.raises(ValueError):
        canary.arm(F.lit(1), 101)


def test_recent_window(spark):
    now = datetime(2024, 1, 10)
    df = spark.createDataFrame([("a", now - timedelta(hours=48)), ("b", now - timedelta(minutes=5))], "id string, ts timestamp")
    assert predlog.recent(df, str(now), 1).count() == 1 and predlog.recent(df, str(now), 72).count() == 2


def test_manifest_errors_and_order(spark, tmp_path):
    rows = spark.createDataFrame([("test", "b", "x"), ("train", "c", "x"), ("val", "a", "x"), ("train", "a", "x")], "split string, path string, label string")
    path = str(tmp_path / "m")
    writers.write_manifest(rows, path, ["split", "path", "label"])
    assert readers.manifest_csv(spark, path, "train").count() == 2
    with pytest.raises(ValueError):
        readers.manifest_csv(spark, path, "other")
    with pytest.raises(FileNotFoundError):
        readers.manifest_csv(spark, str(tmp_path / "none"), "train")
    assert readers.exclusions_json(spark, str(tmp_path / "none"), "item string").count() == 0


def bmp(width, height):
    """Small uncompressed bitmap file."""
    row = (width * 3 + 3) // 4 * 4
    size = 54 + row * height
    head = b"BM" + size.to_bytes(4, "little") + bytes(4) + (54).to_bytes(4, "little") + (40).to_bytes(4, "little")
    head += width.to_bytes(4, "little") + height.to_bytes(4, "little") + (1).to_bytes(2, "little") + (24).to_bytes(2, "little") + bytes(24)
    return head + bytes(row * height)


def test_images(spark, tmp_path):
    (tmp_path / "a b.bmp").write_bytes(bmp(6, 4))
    (tmp_path / "bad.bmp").write_bytes(b"no image")
    got = {r.path.rsplit("/", 1)[-1]: r for r in readers.images(spark, str(tmp_path)).collect()}
    good, bad = next(v for k, v in got.items() if k != "bad.bmp"), got["bad.bmp"]
    assert (good.width, good.height, good.corrupt, good.length) == (6, 4, False, 54 + 20 * 4)
    assert bad.corrupt and bad.length == 8


def test_samples_of_any_size(spark):
    df = spark.range(6000).select("id", F.when(F.col("id") < 5000, "big").otherwise("small").alias("label"))
    got = {r["label"]: r["count"] for r in sample.sample_per_class(df, "label", "id", 1500).groupBy("label").count().collect()}
    assert got == {"big": 1500, "small": 1000}
    ranked = sample.round_robin(df, "label", "id", 2500)
    assert {r["label"]: r["count"] for r in ranked.groupBy("label").count().collect()} == {"big": 1500, "small": 1000}


def test_quantiles_with_infinite_values(spark):
    values = [float(i) for i in range(801)] + [float("inf")] * 99 + [float("-inf")] * 100
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = one(distribution.quantiles(df, F.col("v"), {"low": 0.01, "mid": 0.5, "high": 0.99}))
    ordered = sorted(values)
    assert row["low"] == float("-inf") and row["high"] == float("inf")
    assert row["mid"] == (ordered[499] + ordered[500]) / 2


def test_counter_of_one_hot_series_over_days(spark):
    base = datetime(2024, 1, 1)
    rows = [("hot" if i % 10 else "cold", base + timedelta(hours=5 * (i // 2)), float(i % 37)) for i in range(300)]
    got = metrics.counter_increase(spark.createDataFrame(rows, "s string, ts timestamp, value double"), ["s"]).collect()
    want = []
    for s in ("hot", "cold"):
        last = None
        for _, t, v in sorted((r for r in rows if r[0] == s), key=lambda r: r[1:]):
            want.append((s, t, v, 0.0 if last is None else v if v < last else v - last))
            last = v
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_store_content_returns_only_new(spark, tmp_path):
    root = str(tmp_path / "store")
    up = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "c string")
    assert writers.store_content(up.filter("c = 'a'"), "c", root).count() == 1
    assert writers.store_content(up, "c", root).count() == 1 and writers.store_content(up, "c", root).count() == 0
    assert spark.read.parquet(root).count() == 2


def test_held_condition_keeps_every_sample():
    """Two samples in one second, a tie, and late samples of a later batch."""
    import pandas as pd

    from sievemark.streaming.stateful import HeldCondition

    class State:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    op = HeldCondition(10, 60)
    op.run = State()
    at = lambda s: pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=s)

    def feed(*samples):
        frame = pd.DataFrame([(at(s), a) for s, a in samples], columns=["at", "active"])
        return [(r.at, r.state) for part in op.handleInputRows(("x",), iter([frame]), None) for r in part.itertuples()]

    assert feed((0, True), (0.4, False), (0.8, True), (10.5, True), (11, True), (11, False), (12, True)) == [
        (at(0), "pending"), (at(0.8), "pending"), (at(10.5), "pending"), (at(11), "firing"), (at(12), "pending")]
    assert feed((22, True), (11.5, True)) == [(at(11.5), "pending"), (at(22), "firing")]
    assert feed((15, False)) == [] and feed((23, True)) == [(at(23), "pending")]


def test_drift_verdict_covers_the_whole_log(spark, tmp_path):
    """Slots follow the log, also before 2024 and after 39 days; three empty ones come last."""
    days = [(datetime(2023, 12, 30), 250), (datetime(2024, 1, 1), 1), (datetime(2024, 3, 1), 250)]
    rows = [(i, day, "click", 50.0, 1, None) for i, day in enumerate(day for day, n in days for _ in range(n))]
    spark.createDataFrame(rows, "event_id long, ts timestamp, event_type string, value double, user_id long, props string").write.parquet(f"{tmp_path}/events.parquet")
    got = {r["slot"]: r["status"] for r in QUERIES["drift_verdict"](Tables(spark, str(tmp_path))).collect()}
    assert sorted(got) == list(range(-1, 24))
    assert {k: v for k, v in got.items() if v != "no_data"} == {-1: "drift", 0: "insufficient", 20: "drift"}
