"""Sinks, keyed upserts and merges, and versioned Parquet tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from basketlens.functions.rules import stable_bucket
from basketlens.operators.metrics import rows
from basketlens.schemas import TABLES

# ---------------------------------------------------------------- plain sinks


def write_layer(df: DataFrame, path: str, by: list[str] | None = None, codec: str = "snappy", mode: str = "overwrite") -> None:
    """Partitioned Parquet layer.

    Rebalancing first gives each partition folder a few well-sized files: AQE
    merges small shuffle blocks and splits the blocks of a dominant value.
    ``mode="overwrite"`` replaces the whole layer.
    """
    writer = (df.hint("rebalance", *by) if by else df).write.mode(mode).option("compression", codec)
    if by:
        writer = writer.partitionBy(*by)
    writer.option("partitionOverwriteMode", "static").parquet(path)


def write_bronze(events: DataFrame, path: str, by: tuple[str, ...] = ("event_date",), codec: str = "snappy") -> None:
    """Bronze events by date, or by year and month for archives."""
    write_layer(events, path, list(by), codec)


def write_ctr(clicks: DataFrame, path: str, by: tuple[str, ...] = ("day",), codec: str = "snappy") -> None:
    """Bronze click rows by day; unpartitioned ones lose their row id."""
    write_layer(clicks if by else clicks.drop("row_id"), path, list(by), codec)


def write_by_event_type(events: DataFrame, path: str) -> None:
    """Speed-layer copy of the events."""
    write_layer(events, path, ["event_type"])


def overwrite_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace exactly the partitions that occur in ``df``."""
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def create_empty(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """An empty table with a schema, for readers that start before the writer."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def create_or_replace(df: DataFrame, name: str, properties: dict[str, str] | None = None, codec: str = "snappy") -> None:
    """Replace a catalog table."""
    df.write.mode("overwrite").format("parquet").option("compression", codec).saveAsTable(name)
    if properties:
        pairs = ", ".join(f"'{key}' = '{value}'" for key, value in properties.items())
        df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def create_tables(spark: SparkSession, database: str) -> list[str]:
    """The typed catalog tables, created where missing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, (columns, by) in TABLES.items():
        layout = f" PARTITIONED BY ({', '.join(by)})" if by else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{layout}")
    return [f"{database}.{name}" for name in TABLES]


def insert_partitions(df: DataFrame, name: str) -> None:
    """Load a catalog table, replacing the partitions that occur in ``df``."""
    target = df.sparkSession.table(name).schema
    aligned = df.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in target.fields])
    aligned.write.option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=True)


# ------------------------------------------------------------ upsert and merge


def latest_per_key(updates: DataFrame, keys: list[str], precombine: list[str]) -> DataFrame:
    """One row per key: the one with the greatest precombine values.

    A maximum over structs combines partially before the shuffle, so a key
    with very many updates costs no more than any other.
    """
    rest = [c for c in updates.columns if c not in keys and c not in precombine]
    newest = F.max(F.struct(*precombine, *rest)).alias("_row")
    return updates.groupBy(*keys).agg(newest).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in updates.columns]
    )


def upsert(base: DataFrame, updates: DataFrame, keys: list[str], precombine: list[str]) -> DataFrame:
    """Keyed upsert: per key the row with the greater precombine stays, new keys come in.

    On equal precombine values the update wins. ``base`` holds one row per key;
    a null key is a key of its own.
    """
    fresh = latest_per_key(updates, keys, precombine).withColumn("_new", F.lit(True)).alias("u")
    stored = base.withColumn("_old", F.lit(True)).alias("b")
    joined = stored.join(fresh, _same_key(keys, "b", "u"), "full_outer")
    order = [F.struct(*[F.col(f"{side}.{c}") for c in precombine]) for side in ("u", "b")]
    newer = F.col("_new").isNotNull() & (F.col("_old").isNull() | (order[0] >= order[1]))
    return joined.select(*[F.when(newer, F.col(f"u.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in base.columns])


def _same_key(keys: list[str], left: str, right: str) -> Column:
    """Equal keys; null equals null, so that a null key is one row like any other."""
    return reduce(and_, (F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys))


def merge_into(target: DataFrame, source: DataFrame, on: list[str], precombine: list[str]) -> DataFrame:
    """Matched rows take the source's values, unmatched source rows are added.

    The source is first reduced to one row per key, as a target row must not
    match twice. Null keys match each other. The target may repeat keys: it is the preserved side of a
    left join, which AQE can split when one key dominates.
    """
    fresh = latest_per_key(source, on, precombine)
    marked = fresh.withColumn("_hit", F.lit(True)).alias("s")
    joined = target.alias("t").join(marked, _same_key(on, "t", "s"), "left")
    hit = F.col("_hit").isNotNull()
    updated = joined.select(
        *[
            F.col(f"t.{c}") if c in on else F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            for c in target.columns
        ]
    )
    present = target.select(*on).distinct().alias("p")
    added = fresh.alias("s").join(present, _same_key(on, "s", "p"), "left_anti").select(target.columns)
    return updated.unionByName(added)


def bump_top_profiles(profiles: DataFrame, n: int = 100, events: int = 10, views: int = 5) -> DataFrame:
    """Update batch: the busiest users gain events and views."""
    busiest = profiles.orderBy(F.desc("total_events"), "user_id").limit(n)
    return busiest.withColumns(
        {"total_events": F.col("total_events") + events, "total_views": F.col("total_views") + views}
    )


def price_bump_batch(events: DataFrame, fraction: float = 0.1, factor: float = 1.1, key: str = "event_id") -> DataFrame:
    """Update batch: a repeatable share of the rows with a raised price."""
    picked = events.filter(stable_bucket(key, buckets=1000) < int(round(fraction * 1000)))
    return picked.withColumn("price", F.col("price") * factor)


# ------------------------------------------------------------ versioned tables


class VersionedTable:
    """Parquet snapshots under ``version=<n>`` and one commit record each.

    A version exists once its commit record is written, so readers never see
    a half-written snapshot and a failed write is simply repeated. Retired
    versions drop out of the record; freeing their files is left to the
    store's expiry rules.
    """

    _COMMIT = "version long, committed_at timestamp, operation string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def commit(self, snapshot: DataFrame, operation: str = "write", by: list[str] | None = None) -> int:
        """Write a new version and return its number."""
        newest = self._commits().agg(F.max("version")).first()[0]
        version = 0 if newest is None else newest + 1
        write_layer(snapshot, f"{self.path}/version={version}", by)
        record = self.spark.range(1).select(
            F.lit(version).cast("long").alias("version"),
            F.current_timestamp().alias("committed_at"),
            F.lit(operation).alias("operation"),
        )
        record.write.mode("overwrite").json(f"{self.path}/_commits/{version:010d}")
        return version

    def versions(self) -> DataFrame:
        """Live commits: version, time, operation."""
        commits, floor = self._commits(), self._floor()
        return commits if floor is None else commits.filter(F.col("version") >= floor)

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or the table as of a given one."""
        live = self.versions()
        wanted = live if version is None else live.filter(F.col("version") == version)
        found = wanted.agg(F.max("version")).first()[0]
        if found is None:
            raise LookupError(f"{self.path} has no live version {'' if version is None else version}".rstrip())
        return self.spark.read.parquet(f"{self.path}/version={found}")

    def history(self) -> DataFrame:
        """Per live version: commit time, operation, rows, files and bytes."""
        files = (
            self.spark.read.parquet(self.path)
            .groupBy("version", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
            .agg(rows().alias("n"))
        )
        stored = files.groupBy(F.col("version").cast("long").alias("version")).agg(
            F.sum("n").alias("rows"), rows().alias("files"), F.sum("size").alias("bytes")
        )
        return self.versions().join(stored, "version", "left").na.fill(0, ["rows", "files", "bytes"]).orderBy("version")

    def retain(self, n: int = 5) -> None:
        """Keep the newest ``n`` versions."""
        newest = self.versions().agg(F.max("version")).first()[0]
        if newest is not None:
            kept = self.versions().orderBy(F.desc("version")).limit(n)
            kept.agg(F.min("version").alias("floor")).write.mode("overwrite").json(f"{self.path}/_retained/{newest:010d}")

    def _commits(self) -> DataFrame:
        return self._records("_commits", self._COMMIT)

    def _floor(self) -> int | None:
        return self._records("_retained", "floor long").agg(F.max("floor")).first()[0]

    def _records(self, folder: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).json(f"{self.path}/{folder}/*")
        except AnalysisException:
            return self.spark.createDataFrame([], schema)


def storage_stats(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Files and megabytes of each Parquet table, from the listing; no file is opened."""
    combined = None
    for name, path in paths.items():
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet")
            .load(path)
            .select(F.lit(name).alias("table"), "length")
        )
        combined = files if combined is None else combined.unionByName(files)
    sized = combined.groupBy("table").agg(rows().alias("files"), F.sum("length").alias("_bytes"))
    return sized.select("table", "files", F.round(F.col("_bytes") / (1024.0 * 1024.0), 2).alias("storage_mb"))
