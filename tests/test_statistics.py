"""Exact order statistics, the gamma tail and the drift index against numpy and other plain versions."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievemark.functions.gamma import chi_square_tail, log_gamma
from sievemark.functions.ordinals import from_ordinal, ordinal
from sievemark.operators import distribution, drift

PROBS = {"a": 0.0, "b": 0.05, "c": 0.25, "d": 0.5, "e": 0.95, "f": 1.0}
ODD = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, float("inf"), float("-inf"), 0.1, 3.0, 2.0**-1030]


def frame(spark, values, extra=""):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double").repartition(3)


def test_images_keep_order_and_come_back(spark):
    rng = random.Random(1)
    values = ODD + [struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(300)]
    values = [v for v in values if v == v]
    rows = frame(spark, values).select("v", ordinal(F.col("v")).alias("k")).select("v", "k", from_ordinal(F.col("k")).alias("back")).collect()
    assert all(r.back == r.v for r in rows)
    by_value = sorted(rows, key=lambda r: r.v)
    assert all((x.k < y.k) == (x.v < y.v) and x.k <= y.k for x, y in zip(by_value, by_value[1:], strict=False))
    none = frame(spark, [None, float("nan")]).select(ordinal(F.col("v")).alias("k")).collect()
    assert all(r.k is None for r in none)


@pytest.mark.parametrize("case", ["normal", "heavy", "close", "few", "one"])
def test_quantiles(spark, case):
    rng = np.random.default_rng(2)
    values = {
        "normal": list(rng.normal(size=3000)), "heavy": [0.25] * 2700 + list(rng.normal(size=300)),
        "close": list(1.0 + rng.integers(0, 5000, 3000) * 2.0**-52), "few": [3.0, -1.0, 2.0], "one": [7.5],
    }[case]
    row = distribution.summarise(frame(spark, [*values, None, float("nan")]), F.col("v"), PROBS, extra={"rows": F.count(F.lit(1))}).first()
    wanted = np.quantile(values, list(PROBS.values()))
    assert [row[p] for p in PROBS] == pytest.approx(list(wanted), rel=1e-15, abs=1e-300)
    assert (row["count"], row["rows"], row["min"], row["max"]) == (len(values), len(values) + 2, min(values), max(values))
    assert row["mean"] == pytest.approx(np.mean(values))
    # means are doubles: with values 1 + k / 2**52 no more than the size of the spread is left
    assert row["std"] == (pytest.approx(np.std(values, ddof=1), rel=1e-9, abs=1e-15) if len(values) > 1 else None)


def test_quantiles_with_infinite_values_and_without_values(spark):
    inf = float("inf")
    row = distribution.quantiles(frame(spark, [inf] * 5 + [-inf] * 5 + [1.0]), F.col("v"), PROBS).first()
    assert (row.a, row.d, row.f) == (-inf, 1.0, inf)
    empty = distribution.summarise(frame(spark, [None, float("nan")]), F.col("v"), PROBS).first()
    assert empty["count"] == 0 and all(empty[p] is None for p in PROBS)


def test_groups_and_null_group(spark):
    rng = np.random.default_rng(3)
    rows = [(g, float(x)) for g in ("x", "y", None) for x in rng.exponential(size=200)]
    got = {r.g: r for r in distribution.describe(spark.createDataFrame(rows, "g string, v double"), F.col("v"), ["g"]).collect()}
    for g in ("x", "y", None):
        mine = [v for k, v in rows if k == g]
        assert [got[g].q25, got[g].q50, got[g].q75] == pytest.approx(list(np.quantile(mine, [0.25, 0.5, 0.75])))
        assert got[g]["count"] == 200 and got[g].std == pytest.approx(np.std(mine, ddof=1))


def test_no_job_before_the_action(spark):
    df = frame(spark, [1.0, 2.0])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    try:
        distribution.summarise(df, F.col("v"), PROBS)
        drift.drift_job(*[spark.range(5).select(F.col("id").cast("string").alias("predicted_class"), F.rand(1).alias("confidence"))] * 2)
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_cumulative_over_the_trie(spark):
    rng = random.Random(4)
    values = [rng.choice(ODD + [rng.uniform(-2, 2), 1 + rng.randrange(50) * 2.0**-52, 1 + rng.randrange(50) * 2.0**-30]) for _ in range(500)]
    counts = frame(spark, values).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    got = {r.value: r for r in distribution.cumulative(counts, "v", ["n"]).collect()}
    ordered = sorted(set(values))
    assert sorted(got) == ordered
    for i, v in enumerate(ordered):
        assert got[v].n_cum == sum(x <= v for x in values) and got[v].n_total == len(values)
        assert got[v].next_value == (ordered[i + 1] if i + 1 < len(ordered) else None)


def test_gamma_tail(spark):
    cases = [(x, k) for k in (1, 2, 3, 4, 7, 10, 51, 400, 5001) for x in (0.0, 0.01, 0.5 * k, 0.99 * k, float(k), 1.2 * k + 2, 3.0 * k + 20)]
    rows = spark.createDataFrame(cases, "x double, k int").select(
        "x", "k", chi_square_tail(F.col("x"), F.col("k")).alias("p"), log_gamma(F.col("k") / 2.0).alias("g")
    ).collect()

    def tail(x, k):  # closed form by the degrees of freedom
        half = x / 2
        if x == 0:
            return 1.0
        first = 0.0 if k % 2 == 0 else math.erfc(math.sqrt(half))
        shift = 0 if k % 2 == 0 else 0.5
        return first + math.fsum(math.exp(-half + (i + shift) * math.log(half) - math.lgamma(i + shift + 1)) for i in range((k - (k % 2)) // 2))

    for r in rows:
        assert r.p == pytest.approx(tail(r.x, r.k), rel=1e-9, abs=1e-13), (r.x, r.k)
        assert r.g == pytest.approx(math.lgamma(r.k / 2), rel=1e-13, abs=1e-13)
    none = spark.createDataFrame([(None, 3), (1.0, 0), (1.0, None)], "x double, k int").select(chi_square_tail(F.col("x"), F.col("k")).alias("p")).collect()
    assert all(r.p is None for r in none)


def test_chi_square_against_spark_ml(spark):
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.stat import ChiSquareTest

    rng = random.Random(5)
    sides = [[(rng.choice("abcdefgh"[: 6 + s]),) for _ in range(150 + 40 * s)] for s in (0, 1)]
    reference, current = (spark.createDataFrame(s, "predicted_class string") for s in sides)
    got = drift.chi_square(reference, current).first()
    rows = [(float(s), Vectors.dense("abcdefgh".index(c))) for s in (0, 1) for (c,) in sides[s]]
    ml = ChiSquareTest.test(spark.createDataFrame(rows, ["label", "features"]), "features", "label").first()
    assert got.df == ml.degreesOfFreedom[0]
    assert (got.statistic, got.p_value) == (pytest.approx(ml.statistics[0]), pytest.approx(ml.pValues[0], rel=1e-9))


def test_drift_job_reads_one_index(spark):
    rng = np.random.default_rng(6)
    reference, current = (
        spark.createDataFrame([(None if i % 50 == 0 else str(i % 5), None if i % 40 == 0 else float(x)) for i, x in enumerate(rng.normal(m, 1, n))], "predicted_class string, confidence double")
        for m, n in ((0.0, 400), (0.2, 300))
    )
    row = drift.drift_job(reference, current).first()
    assert (row.n_reference, row.n_current, row.n_reference_classes, row.n_current_classes) == (400, 300, 5, 5)
    for side, df in (("reference", reference), ("current", current)):
        values = [r.confidence for r in df.collect() if r.confidence is not None]
        assert row[f"confidence_{side}_mean"] == pytest.approx(np.mean(values)) and row[f"confidence_{side}_std"] == pytest.approx(np.std(values, ddof=1))
    assert row.confidence_score == pytest.approx(drift.ks(reference, current).first().p_value)
    empty = drift.drift_job(reference, current.limit(0)).first()
    assert empty.status == "no_data" and empty.n_current == 0
    assert empty.class_score is None and empty.confidence_score is None
    with pytest.raises(ValueError, match="no predictions in the window"):
        drift.drift_job(reference, current.limit(0), require_rows=True)
