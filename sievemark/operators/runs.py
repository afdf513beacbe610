"""Run tracking records, metric histories, pipeline runs and model stages.

A run record is ``run_id, run_name, status, start, end, params map, metrics map``;
a history is long: ``run_id, metric, step, value``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .small import one_row

# Metric names in order of preference.
ACCURACY_METRICS = ["test_accuracy", "val_acc"]
F1_METRICS = ["test_f1_macro", "val_f1_macro"]


def search(runs: DataFrame, order: Column | None = None, limit: int = 100) -> DataFrame:
    """Runs sorted (newest first unless told otherwise), first ``limit``."""
    return runs.orderBy(F.desc("start") if order is None else order, "run_id").limit(limit)


def duration_seconds() -> Column:
    """End minus start in seconds; NULL while the run is open."""
    return F.timestamp_diff("MILLISECOND", F.col("start"), F.col("end")) / 1000.0


def history(points: DataFrame, run_id: str, metric: str) -> DataFrame:
    """(step, value) of one metric of one run."""
    return points.filter((F.col("run_id") == run_id) & (F.col("metric") == metric)).select("step", "value").orderBy("step")


def latest_by_name(runs: DataFrame, name: str = "run_name", order: str = "start", key: str = "run_id") -> DataFrame:
    """Most recent record per name, as an aggregation; of records with equal times the largest id."""
    others = [c for c in runs.columns if c != name]
    return runs.groupBy(name).agg(F.max_by(F.struct(*others), F.struct(F.col(order), F.col(key))).alias("_r")).select(name, "_r.*")


def first_metric(names: list[str]) -> Column:
    """First available of several metrics."""
    return F.coalesce(*[F.col("metrics")[n] for n in names])


def best_run(runs: DataFrame, metrics: list[str] = ACCURACY_METRICS) -> DataFrame:
    """Run with the best metric; on a tie the earliest started one."""
    scored = runs.withColumn("score", first_metric(metrics)).filter("score IS NOT NULL")
    order = F.struct(F.lit(0.0) - F.col("score"), F.col("start"), F.col("run_id"))
    return scored.agg(
        F.min_by(F.struct("run_id", "run_name", "score"), order).alias("r")
    ).filter("r IS NOT NULL").select("r.*")


def run_gaps(latest: DataFrame, base_name: str) -> DataFrame:
    """Per run: accuracy, F1, their difference, and the gap of the best run to the base run.

    Works on one record per name; best and base enter as scalar subqueries.
    """
    scored = latest.select(
        "run_name", first_metric(ACCURACY_METRICS).alias("accuracy"), first_metric(F1_METRICS).alias("f1")
    )
    order = F.struct(F.lit(0.0) - F.col("accuracy"), F.col("run_name"))
    best = one_row(
        scored.filter("accuracy IS NOT NULL")
        .agg(F.min_by(F.struct("run_name", "accuracy", "f1"), order).alias("b")).select("b.*")
    )
    base = one_row(scored.filter(F.col("run_name") == base_name).agg(F.max("accuracy").alias("accuracy"), F.max("f1").alias("f1")))
    return scored.withColumn("_best", best).withColumn("_base", base).select(
        "run_name", "accuracy", "f1",
        (F.col("accuracy") - F.col("f1")).alias("accuracy_f1_gap"),
        F.col("_best.run_name").alias("best_run"),
        (F.col("_best.accuracy") - F.col("_base.accuracy")).alias("gap_accuracy"),
        (F.col("_best.f1") - F.col("_base.f1")).alias("gap_f1"),
    )


def best_step(points: DataFrame, mode: str = "min") -> DataFrame:
    """Step where each run's metric is best; a later equal value does not replace it."""
    value = F.col("value") if mode == "min" else F.lit(0.0) - F.col("value")
    order = F.struct(value, F.col("step"))
    best = F.min_by(F.struct("step", "value"), order)
    return points.groupBy("run_id").agg(best.alias("b")).select(
        "run_id", F.col("b.step").alias("best_step"), F.col("b.value").alias("best_value")
    )


def early_stop(points: DataFrame, patience: int = 5, mode: str = "min", min_delta: float = 0.0) -> DataFrame:
    """Per run: first step at which ``patience`` steps passed without improvement, NULL if none,
    with the best value and the counter when the fold ended.

    The fold runs over the steps of one run, of which there are as many as epochs.
    """
    steps = F.sort_array(F.collect_list(F.struct("step", "value")))
    start = F.struct(
        F.lit(None).cast("double").alias("best"), F.lit(0).alias("counter"), F.lit(None).cast("bigint").alias("stop")
    )

    def advance(acc: Column, point: Column) -> Column:
        better = acc["best"].isNull() | (
            point["value"] < acc["best"] - min_delta if mode == "min" else point["value"] > acc["best"] + min_delta
        )
        counter = F.when(better, 0).otherwise(acc["counter"] + 1)
        live = acc["stop"].isNull()
        return F.struct(
            F.when(live & better, point["value"]).otherwise(acc["best"]).alias("best"),
            F.when(live, counter).otherwise(acc["counter"]).alias("counter"),
            F.when(live & (counter >= patience), point["step"].cast("bigint")).otherwise(acc["stop"]).alias("stop"),
        )

    folded = points.groupBy("run_id").agg(F.aggregate(steps, start, advance).alias("s"))
    return folded.select(
        "run_id", F.col("s.stop").alias("stop_step"), F.col("s.best").alias("best_value"),
        F.col("s.counter").alias("counter"),
    )


def latest_stage(versions: DataFrame) -> DataFrame:
    """Latest version per (name, stage)."""
    return versions.groupBy("name", "stage").agg(F.max("version").alias("version"))


def promote(versions: DataFrame, name: str, source: str = "Staging", target: str = "Production", archive: str = "Archived") -> DataFrame:
    """New version table: the latest ``source`` version moves to ``target`` and the previous
    holders of ``target`` are archived. Raises when there is no candidate."""
    mine = (F.col("name") == name) & (F.col("stage") == source)
    newest = versions.filter(mine).agg(F.max("version")).first()[0]
    if newest is None:
        raise ValueError(f"no candidate in {source} for {name}")
    return versions.withColumn(
        "stage",
        F.when(mine & (F.col("version") == F.lit(newest)), target)
        .when((F.col("name") == name) & (F.col("stage") == target), archive)
        .otherwise(F.col("stage")),
    )


def daily_success(runs: DataFrame, started: str, success: Column, days: int = 14) -> DataFrame:
    """total, successes, failures and rate per day, for the last ``days`` days that have runs."""
    daily = runs.filter(F.col(started).isNotNull()).groupBy(F.to_date(started).alias("day")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(success).alias("success"), F.count_if(~success).alias("failed")
    )
    return daily.orderBy(F.desc("day")).limit(days).withColumn(
        "rate", F.round(F.col("success") * 100.0 / F.col("total"), 1)
    )


def overall_success(runs: DataFrame, success: Column) -> DataFrame:
    """Total, successes, failures and rate over everything, 0 when empty."""
    rate = F.when(F.count(F.lit(1)) > 0, F.round(F.count_if(success) * 100.0 / F.count(F.lit(1)), 1)).otherwise(0.0)
    return runs.agg(F.count(F.lit(1)).alias("total"), F.count_if(success).alias("success"), F.count_if(~success).alias("failed"), rate.alias("rate"))


def coverage(packages: DataFrame) -> DataFrame:
    """Lines covered and valid per package, rate in percent, best first.

    ``packages`` has one row per line: (package, hits).
    """
    return (
        packages.groupBy("package")
        .agg(F.count_if(F.col("hits") > 0).alias("covered"), F.count(F.lit(1)).alias("valid"))
        .withColumn("rate", F.round(F.col("covered") * 100.0 / F.col("valid"), 1))
        .orderBy(F.desc("rate"), "package")
    )
