"""Batch and stream writers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SPLIT_ORDER = ["train", "val", "test"]


def write_manifest(rows: DataFrame, path: str, order: list[str], fmt: str = "csv", by_split: bool = False) -> None:
    """Manifest files in global order: range-partitioned, sorted inside the partition.

    With ``split`` among the order columns, splits come as train, val, test.
    """
    keys: list[Column] = []
    for name in order:
        if name == "split":
            rank = F.array_position(F.array(*[F.lit(s) for s in SPLIT_ORDER]), F.col("split"))
            keys.append(F.when(rank > 0, rank).otherwise(len(SPLIT_ORDER) + 1))
        else:
            keys.append(F.col(name))
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    writer = ranged.write.mode("errorifexists")
    if by_split:
        writer = writer.partitionBy("split")
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.format(fmt).save(path)


def write_rows_json(rows: DataFrame, path: str) -> None:
    """One JSON object per row, as many files as partitions."""
    rows.write.mode("errorifexists").json(path)


def write_class_report(rows: DataFrame, label: str, path: str) -> None:
    """JSON report with one line per class, so that any number of classes is written by all tasks.

    ``rows`` has one row per class; NULL is a class and stays NULL, empty fields are written too.
    """
    fields = [c for c in rows.columns if c != label]
    rows.select(F.col(label).alias("label"), *fields).write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def write_snapshot(rows: DataFrame, root: str, day: str) -> str:
    """Dated snapshot, committed as the current one by a pointer; returns its folder.

    Rows go to a fresh folder ``dt=<day>/<id>``; only when it is complete does one more small
    folder below ``_current`` name it. Pointers are numbered and only added, so a reader sees
    the old or the new rows at any time, and a write that is killed leaves the old ones. Of
    two writers that commit at once one fails.
    """
    from .readers import pointers

    spark = rows.sparkSession
    folder = f"dt={day}/{uuid.uuid4().hex}"
    rows.write.parquet(f"{root}/{folder}")
    number = max(pointers(spark, root), default=0) + 1
    spark.createDataFrame([(folder,)], "folder string").coalesce(1).write.mode("errorifexists").text(f"{root}/_current/{number:012d}")
    return f"{root}/{folder}"


def log_rows(predictions: DataFrame) -> DataFrame:
    """Complete log rows: uuid id and current time where missing, day for partitioning."""
    filled = predictions
    if "id" not in predictions.columns:
        filled = filled.withColumn("id", F.uuid())
    now = F.current_timestamp()
    ts = F.coalesce(F.col("ts"), now) if "ts" in predictions.columns else now
    return filled.withColumn("ts", ts).withColumn("day", F.to_date("ts"))


def append_log(predictions: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append a prediction stream to day-partitioned Parquet, exactly once per checkpoint."""
    writer = (
        log_rows(predictions).writeStream.format("parquet").outputMode("append").partitionBy("day")
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def append_table(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Drain a stream into Parquet files and stop."""
    return (
        rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )


def store_once(rows: DataFrame, key: str, root: str, checkpoint: str) -> StreamingQuery:
    """Drain a stream into ``root``, each key once for good (NULL is a key); returns the query.

    No state holds the keys: every micro-batch is compared with what earlier batches stored and
    written to the folder of its own number, which a replay of the batch replaces. Late rows
    count as any others.
    """
    from .readers import exists

    def commit(batch: DataFrame, number: int) -> None:
        fresh = batch.dropDuplicates([key])
        if exists(batch.sparkSession, root):
            stored = batch.sparkSession.read.schema(f"{fresh.schema.simpleString()[7:-1].replace(':', ' ')}, batch bigint").parquet(root)
            earlier = stored.filter(F.col("batch") < number).select(F.col(key).alias("_stored"))
            fresh = fresh.join(earlier, F.col(key).eqNullSafe(F.col("_stored")), "left_anti")
        fresh.write.mode("overwrite").parquet(f"{root}/batch={number}")

    return rows.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_log(rows: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Drain an update-mode stream into ``root``, one folder per micro-batch; ``readers.latest_rows`` gives the last version of each row."""
    def commit(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch={number}")

    return (
        rows.writeStream.outputMode("update").foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def export_log(log: DataFrame) -> DataFrame:
    """Log rows with the top entries as JSON text, for row-oriented consumers."""
    return log.withColumn("top5_json", F.to_json("top5")).drop("top5")


def store_content(uploads: DataFrame, content: str, root: str) -> DataFrame:
    """Keep each upload once, named by SHA-256; returns the newly stored digests.

    Digests are reduced and compared with those below ``root`` first; the content moves only for those that stay. A second upload of the same
    content returns nothing.
    """
    from .readers import exists

    spark = uploads.sparkSession
    hashed = uploads.select(F.sha2(F.col(content), 256).alias("hash"), F.col(content).alias("content"))
    digests = hashed.select("hash").filter(F.col("hash").rlike("^[0-9a-f]{64}$")).distinct()
    if exists(spark, root):
        digests = digests.join(spark.read.parquet(root).select("hash"), "hash", "left_anti")
    stored = f"{root.rstrip('/')}-new-{uuid.uuid4().hex}"
    digests.write.parquet(stored)
    fresh = spark.read.schema("hash string").parquet(stored)
    hashed.join(fresh, "hash").dropDuplicates(["hash"]).write.mode("append").parquet(root)
    return fresh
