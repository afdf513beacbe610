"""The given tables in the roles the operators work on; the only place that knows both."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import quality
from .session import prepare

MIN_CHARS = 500
SPLIT_TIME = "2024-01-16 00:00:00"
LAST_TIME = "2024-01-31 00:00:00"
OUTSIDE_REFERENCE = ["src0", "src1"]
POSITIVE_IDS, NEGATIVE_IDS = [0, 1, 2], [3, 4, 5, 6]
LOGIT_COUNT = 10
LONG_TEXT = 1000
OPEN_EVERY = 5


class Tables:
    """Lazy frames over one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark)
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # --- labelled observations -------------------------------------------------
    @cached_property
    def documents(self) -> DataFrame:
        """doc_id, item (content key), lang, source, n_chars."""
        return self.raw("documents").select(
            "doc_id", F.md5("text").alias("item"), "lang", "source", "n_chars"
        )

    @cached_property
    def observations(self) -> DataFrame:
        return self.documents.select(
            F.col("doc_id").alias("ord"), "doc_id", "item", F.col("source").alias("species"), "lang",
            F.col("n_chars").cast("double").alias("confidence"), "n_chars",
        )

    @cached_property
    def reference_species(self) -> DataFrame:
        names = self.raw("documents").select(F.col("source").alias("species")).distinct()
        return names.filter(~F.col("species").isin(OUTSIDE_REFERENCE))

    @cached_property
    def files(self) -> DataFrame:
        """Items that exist on disk."""
        return self.raw("labels").select("doc_id")

    # --- prediction log ----------------------------------------------------------
    @cached_property
    def log(self) -> DataFrame:
        value = F.col("value")
        return self.raw("events").select(
            F.col("event_id").cast("string").alias("id"),
            F.col("ts").cast("timestamp").alias("ts"),
            F.col("event_type").alias("predicted_class"),
            (F.lit(50.0) / (F.lit(50.0) + value)).alias("confidence"),
            value.alias("latency_ms"),
            "user_id",
            "props",
            "event_id",
        )

    @cached_property
    def reference_log(self) -> DataFrame:
        return self.log.filter(F.col("ts") < F.lit(SPLIT_TIME).cast("timestamp"))

    @cached_property
    def current_log(self) -> DataFrame:
        return self.log.filter(F.col("ts") >= F.lit(SPLIT_TIME).cast("timestamp"))

    @cached_property
    def shifted_log(self) -> DataFrame:
        """Current rows of high latency: the case in which the confidence drifts."""
        return self.current_log.filter(F.col("latency_ms") >= 30)

    @cached_property
    def tagged_log(self) -> DataFrame:
        """The whole log, told apart at the split time."""
        return self.log.withColumn("is_current", F.col("ts") >= F.lit(SPLIT_TIME).cast("timestamp"))

    @cached_property
    def tagged_shifted_log(self) -> DataFrame:
        """Reference rows, and the current rows of ``shifted_log``."""
        return self.tagged_log.filter(~F.col("is_current") | (F.col("latency_ms") >= 30))

    @property
    def is_error(self) -> Column:
        return F.col("predicted_class") == "error"

    @property
    def latency_seconds(self) -> Column:
        return F.col("latency_ms") / 1000.0

    # --- vectors -----------------------------------------------------------------
    @cached_property
    def vectors(self) -> DataFrame:
        return self.raw("embeddings").select("vec_id", F.col("embedding").alias("vec"), "label")

    @cached_property
    def positive_prompts(self) -> DataFrame:
        return self.vectors.filter(F.col("vec_id").isin(POSITIVE_IDS)).select("vec")

    @cached_property
    def negative_prompts(self) -> DataFrame:
        return self.vectors.filter(F.col("vec_id").isin(NEGATIVE_IDS)).select("vec")

    @cached_property
    def features(self) -> DataFrame:
        """Documents with their vector (one without is unreadable), and vectors without a document (species NULL)."""
        prompts = [*POSITIVE_IDS, *NEGATIVE_IDS]
        vecs = self.vectors.filter(~F.col("vec_id").isin(prompts)).select(F.col("vec_id").alias("doc_id"), "vec")
        docs = self.raw("documents").select("doc_id", F.col("source").alias("species"))
        return docs.join(vecs, "doc_id", "full_outer").withColumn("item", F.col("doc_id").cast("string"))

    @cached_property
    def scores(self) -> DataFrame:
        return quality.prompt_scores(self.features, self.positive_prompts, self.negative_prompts)

    @cached_property
    def logits(self) -> DataFrame:
        """Products of the whole vector with the mean vector of each label, times ten."""
        vectors = self.vectors.withColumn("vec", F.col("vec").cast("array<double>"))
        means = vectors.select("label", F.posexplode("vec").alias("pos", "x")).groupBy("label", "pos").agg(F.avg("x").alias("m"))
        by_label = means.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("c"))
        one_row = by_label.agg(F.transform(F.sort_array(F.collect_list(F.struct("label", "c"))), lambda s: s["c"]).alias("centres"))
        product = lambda v, c: F.aggregate(F.zip_with(v, c, lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
        # one row with a vector for each of the labels
        return vectors.join(F.broadcast(one_row)).select(
            "vec_id", "label", F.transform("centres", lambda c: product(F.col("vec"), c) * 10.0).alias("logits")
        )

    @property
    def class_names(self) -> Column:
        """Names of all classes but the last, which falls back to its index."""
        return F.array(*[F.lit(f"label_{i}") for i in range(LOGIT_COUNT - 1)])

    # --- evaluation --------------------------------------------------------------
    @cached_property
    def predicted_pairs(self) -> DataFrame:
        """doc_id with the predicted label, for every document."""
        return self.raw("documents").select("doc_id", (F.col("n_chars") >= LONG_TEXT).cast("int").alias("y_pred"))

    @cached_property
    def truth(self) -> DataFrame:
        return self.raw("labels").select("doc_id", F.col("quality").alias("y_true"))

    @cached_property
    def pairs(self) -> DataFrame:
        return self.predicted_pairs.join(self.truth, "doc_id")

    # --- runs ----------------------------------------------------------------------
    @cached_property
    def run_history(self) -> DataFrame:
        """One run per event type, one step per day."""
        return (
            self.log.groupBy(F.col("predicted_class").alias("run_id"), F.dayofmonth("ts").cast("bigint").alias("step"))
            .agg(F.round(F.avg("latency_ms"), 6).alias("value"))
            .select("run_id", F.lit("val_loss").alias("metric"), "step", "value")
        )

    @cached_property
    def runs(self) -> DataFrame:
        """One run per event type and day; on every fifth day the run is still open and has no test metrics."""
        day = F.date_format("ts", "yyyy-MM-dd")
        full = F.dayofmonth("start") % OPEN_EVERY != 0
        grouped = self.log.groupBy(F.col("predicted_class").alias("run_name"), day.alias("day")).agg(
            F.count(F.lit(1)).alias("n"),
            F.min("ts").alias("start"),
            F.max("ts").alias("end"),
            F.round(F.avg("confidence"), 6).alias("acc"),
            F.round(F.min("confidence"), 6).alias("low"),
        )
        return grouped.select(
            F.concat_ws("-", "run_name", "day").alias("run_id"), "run_name",
            F.when(full, "FINISHED").otherwise("RUNNING").alias("status"),
            "start", F.when(full, F.col("end")).alias("end"),
            F.create_map(F.lit("day"), F.col("day"), F.lit("rows"), F.col("n").cast("string")).alias("params"),
            F.map_filter(
                F.create_map(
                    F.lit("test_accuracy"), F.when(full, F.col("acc")), F.lit("val_acc"), F.col("acc"),
                    F.lit("test_f1_macro"), F.when(full, F.col("low")), F.lit("val_f1_macro"), F.col("low"),
                ),
                lambda _, v: v.isNotNull(),
            ).alias("metrics"),
        )
