"""Batch and stream readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, text

OBSERVATION_SCHEMA = T.StructType([
    T.StructField("image_lien", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("gbif_info/species", T.StringType()),
    T.StructField("gbif_info/confidence", T.DoubleType()),
    *[T.StructField(f"gbif_info/{c}", T.StringType()) for c in ("kingdom", "phylum", "class", "order", "family", "genus")],
])
MANIFEST_SCHEMA = "split string, path string, label string"
PREDICTION_SCHEMA = (
    "id string, ts timestamp, image_hash string, predicted_class string, confidence double, "
    "top5 array<struct<species:string,confidence:double,rank:int>>, latency_ms double"
)
IMAGE_EXTENSIONS = [".jpg", ".jpeg", ".png"]


def snake(name: str) -> str:
    return name.rsplit("/", 1)[-1].strip().lower().replace(" ", "_")


def observations_csv(spark: SparkSession, path: str, schema: T.StructType = OBSERVATION_SCHEMA) -> DataFrame:
    """Observations CSV with an explicit schema; path-like names become the last part."""
    raw = spark.read.schema(schema).csv(path, header=True, enforceSchema=False)
    return raw.withColumnsRenamed({c: snake(c) for c in raw.columns})


def reference_csv(spark: SparkSession, path: str, column: str, separator: str = ";", encoding: str = "ISO-8859-1") -> DataFrame:
    """Distinct names of a reference list in another CSV dialect."""
    rows = spark.read.csv(path, header=True, sep=separator, encoding=encoding)
    return rows.select(F.col(column).alias("species")).distinct()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, asked through the Hadoop file system of the session."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(jpath)


def first_existing(spark: SparkSession, *paths: str) -> str:
    """First path that exists: the filtered manifest before the raw one."""
    for path in paths:
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"none of these exists: {', '.join(paths)}")


def pointers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed pointers of a snapshot; a pointer counts once its write has ended."""
    base = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_current/*/_SUCCESS")
    found = base.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(base)
    return [int(f.getPath().getParent().getName()) for f in found or []]


def current_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the snapshot committed last; an error when there is none."""
    committed = pointers(spark, root)
    if not committed:
        raise FileNotFoundError(f"{root}/_current")
    folder = spark.read.text(f"{root}/_current/{max(committed):012d}").first()[0]
    return spark.read.parquet(f"{root}/{folder}")


def latest_rows(spark: SparkSession, root: str, schema: str, keys: list[str]) -> DataFrame:
    """Last version of every row that ``writers.upsert_log`` has written."""
    fields = [f.name for f in T.StructType.fromDDL(schema) if f.name not in keys]
    rows = spark.read.schema(f"{schema}, batch bigint").parquet(root)
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*fields), "batch").alias("_v")).select(*keys, "_v.*")


def manifest_split(rows: DataFrame, split: str, limit: int | None = None) -> DataFrame:
    """Manifest rows of one split; an empty split is an error."""
    chosen = rows.filter(F.col("split") == split)
    if chosen.isEmpty():
        raise ValueError(f"no rows for split {split!r}")
    return chosen if limit is None else chosen.orderBy("path").limit(limit)


def manifest_csv(spark: SparkSession, path: str, split: str, limit: int | None = None) -> DataFrame:
    """Manifest file of one split; a missing file or an empty split is an error."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return manifest_split(spark.read.schema(MANIFEST_SCHEMA).csv(path, header=True), split, limit)


def file_listing(spark: SparkSession, root: str, extensions: list[str] | None = None) -> DataFrame:
    """path, name, extension, length, modified of every file below ``root``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).drop("content")
    name = text.file_name(F.col("path"))
    listed = files.select(
        "path", name.alias("name"), text.file_extension(name).alias("extension"), "length",
        F.col("modificationTime").alias("modified"),
    )
    return listed if extensions is None else listed.filter(F.col("extension").isin(extensions))


def file_index(listing: DataFrame) -> DataFrame:
    """name → path; of equal names the first path wins."""
    return listing.groupBy("name").agg(F.min("path").alias("path"))


def images(spark: SparkSession, root: str) -> DataFrame:
    """path, width, height, length, corrupt per image file."""
    decoded = spark.read.format("image").option("recursiveFileLookup", "true").load(root).select("image.*")
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    shapes = decoded.select(F.url_decode(F.regexp_replace("origin", "^file:/+", "/")).alias("_p"), "width", "height")
    files = sizes.withColumn("_p", F.regexp_replace("path", "^file:/+", "/"))
    return files.join(shapes, "_p", "left").select(
        "path", "width", "height", "length", (F.coalesce("height", F.lit(-1)) <= 0).alias("corrupt")
    )


def class_report_json(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """Rows of a class report: ``label`` and the ``fields`` (as in a schema string); a missing report is an error."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.schema(f"label string, {fields}").json(path)


def class_map_json(spark: SparkSession, path: str, value: str, field: str = "per_class") -> DataFrame:
    """Rows of one document whose ``field`` maps class names to structs of type ``value``."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    report = spark.read.schema(f"`{field}` map<string, {value}>").json(path, multiLine=True)
    return report.select(F.explode(field).alias("label", "v")).select("label", "v.*")


def exclusions_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Exclusion ledger; a missing file is an empty ledger."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path, multiLine=False)


COVERAGE_SCHEMA = """
_name string, `_line-rate` double,
classes struct<class: array<struct<_name: string, lines: struct<line: array<struct<_number: bigint, _hits: bigint>>>>>>
"""


def coverage_xml(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of a coverage report: (package, file, number, hits)."""
    packages = spark.read.format("xml").option("rowTag", "package").schema(COVERAGE_SCHEMA).load(path)
    classes = packages.select(F.col("_name").alias("package"), F.explode("classes.class").alias("c"))
    lines = classes.select("package", F.col("c._name").alias("file"), F.explode("c.lines.line").alias("l"))
    return lines.select("package", "file", F.col("l._number").alias("number"), F.col("l._hits").alias("hits"))


CI_RUN_SCHEMA = """
status string, conclusion string, display_title string, triggering_actor struct<login: string>,
head_branch string, run_started_at string, updated_at string, html_url string
"""


def ci_runs(raw: DataFrame, column: str = "json") -> DataFrame:
    """Pipeline-run JSON → flat rows: label, 70-character title, actor or '-', duration, minute."""
    run = raw.select(F.from_json(column, CI_RUN_SCHEMA).alias("r")).select("r.*")
    return run.select(
        text.status_label(F.coalesce("status", F.lit("")), F.col("conclusion")).alias("status"),
        F.substring(F.coalesce("display_title", F.lit("")), 1, 70).alias("title"),
        F.coalesce("triggering_actor.login", F.lit("-")).alias("actor"),
        F.coalesce("head_branch", F.lit("")).alias("branch"),
        dates.duration_text(F.col("run_started_at"), F.col("updated_at")).alias("duration"),
        F.replace(F.substring(F.coalesce("run_started_at", F.lit("")), 1, 16), F.lit("T"), F.lit(" ")).alias("started"),
        F.coalesce("html_url", F.lit("")).alias("link"),
    )


def metric_lines(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """Exposition text → metric, labels map, value, for the metrics of one prefix."""
    lines = spark.read.text(path).filter(F.startswith("value", F.lit(prefix)))
    pattern = r"^([A-Za-z_:][\w:]*)(?:\{(.*)\})?\s+(\S+)"
    labels = F.regexp_extract("value", pattern, 2)
    keys = F.regexp_extract_all(labels, F.lit(r'(\w+)="((?:[^"\\]|\\.)*)"'), F.lit(1))
    values = F.regexp_extract_all(labels, F.lit(r'(\w+)="((?:[^"\\]|\\.)*)"'), F.lit(2))
    return lines.select(
        F.regexp_extract("value", pattern, 1).alias("metric"),
        F.map_from_arrays(keys, values).alias("labels"),
        text.safe_double(F.regexp_extract("value", pattern, 3)).alias("value"),
    )


def prediction_stream(spark: SparkSession, path: str, schema: str = PREDICTION_SCHEMA, glob: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """Prediction log as a stream of Parquet files."""
    reader = spark.readStream.schema(schema).format("parquet")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)
