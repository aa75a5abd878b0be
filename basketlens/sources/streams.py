"""Streaming sources and the replay of history as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.schemas import LIVE


def stream_events(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 5) -> DataFrame:
    """File-source stream of typed events, a bounded number of files per trigger."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def stream_live_json(spark: SparkSession, path: str, max_files: int = 1000, one_per_file: bool = True) -> DataFrame:
    """Stream of live JSON events, one object per file or per line."""
    return (
        spark.readStream.schema(LIVE)
        .option("multiLine", one_per_file)
        .option("maxFilesPerTrigger", max_files)
        .json(path)
    )


def prepare_replay(events: DataFrame, path: str, slices: int = 100, time_col: str = "event_time") -> str:
    """Write history so that a file stream replays it in event-time order.

    The file source orders files by modification time. Tasks of one job finish
    in any order, so each time slice is its own append; inside a slice the
    write is distributed as usual. Slices have equal time spans; a table
    partitioned by date is pruned to the slice's days. Events are out of order
    by at most one slice, so a stream whose watermark covers the span of a
    slice drops none of them.
    """
    micros = F.unix_micros(F.col(time_col).cast("timestamp"))
    low, high = events.agg(F.min(micros), F.max(micros)).first()
    if low is None:
        events.write.mode("overwrite").parquet(path)
        return path
    span = high - low + 1
    edges = [low + span * i // slices for i in range(slices + 1)]
    for start, stop in zip(edges, edges[1:]):
        first, last = (_instant(micros, events, time_col) for micros in (start, stop - 1))
        part = events.filter(F.col(time_col).between(first, last))
        if "event_date" in events.columns:
            part = part.filter(F.col("event_date").between(F.to_date(first), F.to_date(last)))
        part.write.mode("append").parquet(path)
    return path


def _instant(micros: int, events: DataFrame, time_col: str):
    """A time literal of the column's own type, so the bound reaches the scan."""
    return F.timestamp_micros(F.lit(micros)).cast(events.schema[time_col].dataType)
