"""Business rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketlens.constants import ABANDONER, CASUAL, LOYAL, POWER


def rule_segment(
    min_purchases: int = 3,
    min_spend: float = 500,
    min_carts: int = 2,
    min_events: int = 20,
) -> Column:
    """Segment of a profile; the first rule that holds decides."""
    buys, carts = F.col("total_purchases"), F.col("total_carts")
    loyal = (buys >= min_purchases) | (F.col("total_spend") >= min_spend)
    abandons = (carts >= min_carts) & (buys == 0)
    return (
        F.when(loyal, LOYAL)
        .when(abandons, ABANDONER)
        .when(F.col("total_events") >= min_events, POWER)
        .otherwise(CASUAL)
    )


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


# Fixed values of the demo click scorer: intercept, weights, bounds, threshold.
DEMO_BASE = 0.48
DEMO_WEIGHTS = {"I1": 0.002, "I2": 0.0005, "I3": 0.001, "I5": -0.001}
DEMO_BOUND = 0.04
DEMO_THRESHOLD = 0.5


def demo_click_probability() -> Column:
    """Linear demo score; a missing feature counts as 0."""
    lift = F.lit(0.0)
    for name, coefficient in DEMO_WEIGHTS.items():
        lift = lift + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * F.lit(coefficient)
    return F.round(clamp(F.lit(DEMO_BASE) + clamp(lift, -DEMO_BOUND, DEMO_BOUND), 0.0, 1.0), 4)


def stable_bucket(*keys: str, buckets: int = 100, alike: bool = False) -> Column:
    """Bucket of a row that depends on its keys alone.

    The same keys land in the same bucket on every run, cluster and engine,
    unlike random splits, which depend on partitioning. ``alike`` says that the
    keys have one type: they are cast as one array, in half the time for many.
    """
    texts = [F.array(*keys).cast("array<string>")] if alike else [F.col(key).cast("string") for key in keys]
    digest = F.md5(F.concat_ws("|", *texts))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")
