"""Streaming queries: each reads its source once and runs to completion.

Sinks are append-only or idempotent per batch id, so a restarted query
neither loses nor repeats rows. Windows are kept as additive rows per batch and
added up on reading: the newest windows are there at once, late rows count, and
no state is held between batches.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from basketlens.functions.measures import kind_counts, revenue_units
from basketlens.operators.live import normalise_live
from basketlens.operators.metrics import rows
from basketlens.operators.profiles import profile_rates
from basketlens.operators.tables import VersionedTable, create_empty
from basketlens.operators.windows import (
    category_from_parts,
    category_parts,
    trending_from_parts,
    trending_parts,
)
from basketlens.sources.streams import stream_events, stream_live_json


def start_append(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", by: list[str] | None = None
) -> StreamingQuery:
    """Append a stream to a table; stops after the data available at the start."""
    writer = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if by:
        writer = writer.partitionBy(*by)
    return writer.start(path)


def start_upsert(stream: DataFrame, apply, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Hand every micro-batch to ``apply(batch, batch_id)``."""
    return (
        stream.writeStream.foreachBatch(apply)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_event_stream(spark: SparkSession, source: str, schema: T.StructType, out: str, max_files: int = 5) -> DataFrame:
    """Raw events into an append table."""
    create_empty(spark, schema, f"{out}/events")
    start_append(stream_events(spark, source, schema, max_files), f"{out}/events", f"{out}/_checkpoints/events").awaitTermination()
    return spark.read.schema(schema).parquet(f"{out}/events")


class PartStream:
    """A stream reduced to additive rows, batch by batch.

    The rows of a micro-batch are stored under its batch id; a repeated batch
    replaces itself. ``read`` gives the rows of all batches, with ``batch_id``.
    """

    def __init__(self, stream: DataFrame, reduce: Callable[[DataFrame], DataFrame], path: str, checkpoint: str):
        self.spark, self.stream, self.reduce = stream.sparkSession, stream, reduce
        self.path, self.checkpoint = path, checkpoint
        self.schema = reduce(stream).schema

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        self.reduce(batch).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def start(self) -> StreamingQuery:
        create_empty(self.spark, self.schema, f"{self.path}/batch_id=-1")
        return start_upsert(self.stream, self.apply, self.checkpoint)

    def read(self) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])
        return self.spark.read.schema(schema).parquet(self.path)


def trending_stream(events: DataFrame, out: str, pane: str = "15 minutes", distinct: str = "exact") -> PartStream:
    """Additive trending rows of a stream of events."""
    return PartStream(
        events, lambda batch: trending_parts(batch, pane, distinct), f"{out}/trending_parts", f"{out}/_checkpoints/trending"
    )


def category_stream(events: DataFrame, out: str, window: str = "30 minutes") -> PartStream:
    """Additive category rows of a stream of events."""
    return PartStream(
        events, lambda batch: category_parts(batch, window), f"{out}/category_parts", f"{out}/_checkpoints/categories"
    )


def run_trending_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    out: str,
    window: str = "1 hour",
    slide: str | None = "15 minutes",
    max_files: int = 5,
    distinct: str = "exact",
) -> DataFrame:
    """Trending products of every window, the newest ones and late rows included."""
    stream = trending_stream(stream_events(spark, source, schema, max_files), out, slide or window, distinct)
    stream.start().awaitTermination()
    return trending_from_parts(stream.read(), window, slide, distinct)


def run_category_stream(
    spark: SparkSession, source: str, schema: T.StructType, out: str, window: str = "30 minutes", max_files: int = 5
) -> DataFrame:
    """Category metrics of every window, the newest ones and late rows included."""
    stream = category_stream(stream_events(spark, source, schema, max_files), out, window)
    stream.start().awaitTermination()
    return category_from_parts(stream.read(), window)


def run_speed_layer(
    spark: SparkSession, source: str, schema: T.StructType, out: str, max_files: int = 5
) -> dict[str, DataFrame]:
    """The three queries side by side, each with its own checkpoint."""
    create_empty(spark, schema, f"{out}/events")
    raw = stream_events(spark, source, schema, max_files)
    trending, categories = trending_stream(raw, out), category_stream(raw, out)
    started = [start_append(raw, f"{out}/events", f"{out}/_checkpoints/events"), trending.start(), categories.start()]
    for query in started:
        query.awaitTermination()
    return {
        "events": spark.read.schema(schema).parquet(f"{out}/events"),
        "trending": trending_from_parts(trending.read()),
        "categories": category_from_parts(categories.read()),
    }


class ProfileStream:
    """User profiles kept current by a stream.

    A micro-batch is reduced to one additive delta row per user and stored
    under its batch id; writing a batch again replaces it. Readers sum the
    base snapshot and the deltas after it, and ``compact`` folds deltas into a
    new snapshot, so the cost of a batch follows the batch and not the table.
    """

    KEYS = ["user_id"]
    TOTALS = ["total_events", "total_views", "total_carts", "total_purchases", "_spend"]

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.base = VersionedTable(spark, f"{self.path}/base")

    @staticmethod
    def totals(events: DataFrame) -> DataFrame:
        """Additive totals per user."""
        return events.groupBy("user_id").agg(
            rows().alias("total_events"),
            *kind_counts("total_views", "total_carts", "total_purchases"),
            revenue_units().alias("_spend"),
            F.max("event_time").alias("last_event_time"),
        )

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        self.totals(batch).write.mode("overwrite").parquet(f"{self.path}/deltas/batch_id={batch_id}")

    def run(self, events: DataFrame) -> None:
        start_upsert(events, self.apply, f"{self.path}/_checkpoint").awaitTermination()

    def _merged(self) -> DataFrame:
        deltas = self.spark.read.parquet(f"{self.path}/deltas")
        base = self._base()
        if base is not None:
            folded = base.agg(F.max("upto_batch")).first()[0]
            fresh = deltas.filter(F.col("batch_id") > folded)
            deltas = base.withColumnRenamed("upto_batch", "batch_id").unionByName(fresh)
        sums = [F.sum(name).alias(name) for name in self.TOTALS]
        return deltas.groupBy(*self.KEYS).agg(
            *sums, F.max("last_event_time").alias("last_event_time"), F.max("batch_id").alias("batch_id")
        )

    def _base(self) -> DataFrame | None:
        try:
            return self.base.read()
        except LookupError:
            return None

    def read(self, asof: dt.datetime | None = None) -> DataFrame:
        """Current profiles with rates and segment."""
        return profile_rates(self._merged().drop("batch_id"), asof)

    def compact(self) -> int:
        """Fold all deltas into a new base snapshot."""
        merged = self._merged()
        newest = F.lit(merged.agg(F.max("batch_id")).first()[0])
        return self.base.commit(merged.drop("batch_id").withColumn("upto_batch", newest), "compact")


def run_live_stream(
    spark: SparkSession, source: str, out: str, max_files: int = 1000, one_per_file: bool = True
) -> DataFrame:
    """Live JSON feed into a typed table by date."""
    feed = normalise_live(stream_live_json(spark, source, max_files, one_per_file))
    start_append(feed, f"{out}/live", f"{out}/_checkpoints/live", by=["year", "month", "day"]).awaitTermination()
    return spark.read.schema(feed.schema).parquet(f"{out}/live")
