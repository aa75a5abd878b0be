"""Generated click rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.constants import CTR_CATEGORICAL, CTR_NUMERIC


def _uniform(digest: Column, slot: int) -> Column:
    """A number in [0, 1) from eight hex digits of a digest."""
    return F.conv(F.substring(digest, slot * 8 + 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def generate_ctr(rows: DataFrame | int, spark: SparkSession | None = None, seed: int = 42, signal: float = 0.0) -> DataFrame:
    """Click rows for every ``row_id`` of a frame (or for ``0..rows-1``).

    Every value is a function of row id and seed alone, so a lost task
    recomputes the same rows and partitioning does not matter. ``signal``
    (0..1) is the share of rows whose label follows ``I1`` instead of chance.
    """
    if isinstance(rows, int):
        session = spark or SparkSession.active()
        rows = session.range(rows).select(F.col("id").alias("row_id"))
    digests = [F.sha2(F.concat_ws("_", F.lit(f"{seed}.{part}"), F.col("row_id")), 256).alias(f"_h{part}") for part in range(2)]
    # 16 slots of eight hex digits: label, signal gate, 13 numerics, one spare.
    slots = [_uniform(F.col(f"_h{slot // 8}"), slot % 8) for slot in range(16)]
    chance = slots[0] > 0.5
    label = F.when(slots[1] < signal, slots[2] > 0.5).otherwise(chance) if signal > 0 else chance
    numerics = [(slots[2 + i] * 1000).alias(name) for i, name in enumerate(CTR_NUMERIC)]
    categoricals = [
        F.sha2(F.concat_ws("_", F.lit(i), F.col("row_id")), 256).alias(name)
        for i, name in enumerate(CTR_CATEGORICAL, start=1)
    ]
    return rows.select("row_id", *digests).select("row_id", label.cast("int").alias("label"), *numerics, *categoricals)
