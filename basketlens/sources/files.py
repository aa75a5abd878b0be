"""Batch readers: CSV, TSV, Parquet, catalog tables and JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.schemas import LIVE, ctr_schema, event_schema

CORRUPT = "_corrupt_record"


def _layouts(spark: SparkSession, path: str | list[str]) -> dict[bool, list[str]]:
    """Export files by whether their header has the session key; reads one line a file."""
    found: dict[bool, list[str]] = {}
    for row in spark.read.format("binaryFile").load(path).select("path").collect():
        header = spark.read.option("header", True).csv(row.path).columns
        found.setdefault("user_session" in header, []).append(row.path)
    return found


def _session(frame: DataFrame, wanted: bool) -> DataFrame:
    if wanted and "user_session" not in frame.columns:
        return frame.withColumn("user_session", F.lit(None).cast("string"))
    return frame if wanted else frame.drop("user_session")


def read_events_csv(
    spark: SparkSession,
    path: str | list[str],
    malformed: str = "keep",
    with_session: bool = False,
) -> DataFrame:
    """Raw shop events from headed CSV files with or without the session key, also mixed.

    ``malformed="keep"`` turns unreadable fields into nulls, ``"drop"``
    leaves such rows out, ``"fail"`` stops the job. Each file is read in the layout
    of its own header, and a header in another order is refused. ``with_session``
    says whether the result has the key (null where a file has none).
    """
    modes = {"keep": "PERMISSIVE", "drop": "DROPMALFORMED", "fail": "FAILFAST"}
    frames = [
        _session(
            spark.read.schema(event_schema(layout))
            .option("header", True)
            .option("enforceSchema", False)
            .option("mode", modes[malformed])
            .csv(files),
            with_session,
        )
        for layout, files in sorted(_layouts(spark, path).items())
    ]
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], event_schema(with_session))


def read_event_rejects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines that ``malformed="drop"`` leaves out, with their file."""
    found = spark.createDataFrame([], "line string, file string")
    for layout, files in sorted(_layouts(spark, path).items()):
        fields = event_schema(layout).fields
        schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
        rows = (
            spark.read.schema(schema)
            .option("header", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .csv(files)
        )
        # All fields stay in the plan: a scan of the corrupt column alone is refused.
        line = F.when(F.greatest(*[F.col(f.name).isNotNull().cast("int") for f in fields]) >= 0, F.col(CORRUPT))
        found = found.unionByName(rows.select(line.alias("line"), F.col("_metadata.file_path").alias("file")).filter("line is not null"))
    return found


def read_monthly_csv(spark: SparkSession, root: str, names: list[str], **options) -> DataFrame:
    """Several export files of one schema in one scan; missing files are skipped."""
    return read_events_csv(spark, f"{root}/{{{','.join(names)}}}", **options)


def union_sources(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by column name; columns a source lacks become null."""
    combined = first
    for other in others:
        combined = combined.unionByName(other, allowMissingColumns=True)
    return combined


def read_ctr_tsv(spark: SparkSession, path: str, day: int) -> DataFrame:
    """One day of click rows: a folder, a ``.gz`` or a ``.tsv`` file."""
    return _ctr_reader(spark).csv(path).select(
        "*", F.lit(day).cast("int").alias("day"), F.monotonically_increasing_id().alias("row_id")
    )


def read_ctr_days(spark: SparkSession, root: str, days: list[int] | None = None) -> DataFrame:
    """All ``day_<n>`` folders or files below ``root`` in one scan.

    The day comes from the file path, so a filter on it skips whole files,
    and days that do not exist simply contribute nothing.
    """
    day = F.regexp_extract(F.col("_metadata.file_path"), r"/day_(\d+)(?:\.(?:gz|tsv))?(?:/|$)", 1)
    rows = _ctr_reader(spark).option("recursiveFileLookup", True).csv(root)
    rows = rows.select("*", day.alias("_day"))
    rows = rows.filter(F.col("_day") != "")
    if days is not None:
        rows = rows.filter(F.col("_day").isin([str(d) for d in days]))
    return rows.select(
        *ctr_schema().fieldNames(),
        F.col("_day").cast("int").alias("day"),
        F.monotonically_increasing_id().alias("row_id"),
    )


def _ctr_reader(spark: SparkSession):
    return (
        spark.read.schema(ctr_schema())
        .option("sep", "\t")
        .option("header", False)
        .option("mode", "DROPMALFORMED")
    )


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet layer with partition discovery."""
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str, fmt: str | None = None) -> DataFrame:
    """A catalog table, or a path in the given format when one is named."""
    return spark.table(name) if fmt is None else spark.read.format(fmt).load(name)


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """Temp views for ad-hoc SQL."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def read_live_json(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Live events in ``year=/month=/day=`` folders.

    A file is one JSON object, or one object per line when ``one_per_file``
    is off. Price and ids stay strings here; typing is ``type_live``'s work.
    """
    return spark.read.schema(LIVE).option("multiLine", one_per_file).json(path)


def newest_files(spark: SparkSession, path: str, limit: int) -> list[str]:
    """Paths of the ``limit`` newest files below ``path`` by modification time, ties by path; no file is opened."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path).select("path", "modificationTime")
    return [r.path for r in listed.orderBy(F.desc("modificationTime"), "path").limit(limit).collect()]


def read_live_recent(spark: SparkSession, path: str, limit: int = 250) -> DataFrame:
    """The events of the newest ``limit`` files, typed; only those files are read."""
    from basketlens.operators.live import type_live

    chosen = newest_files(spark, path, limit)
    reader = spark.read.schema(LIVE).option("multiLine", True).option("basePath", path)
    found = reader.json(chosen).select("*", F.col("_metadata.file_modification_time").alias("landed_at")) if chosen else None
    return type_live(spark.createDataFrame([], LIVE).withColumn("landed_at", F.lit(None).cast("timestamp")) if found is None else found)


def write_summary(frame: DataFrame, path: str) -> None:
    """A small result frame as one JSON file."""
    frame.coalesce(1).write.mode("overwrite").json(path)
