"""Event-time window aggregates.

Events are first added up by pane (the slide of the windows) and by the user
or product that is counted distinctly; panes are then laid into their windows.
The rows of the first step are additive: streams store them batch by batch and
add them up on reading. A product seen by very many users is spread over those
users, and an event is not copied into each of its windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketlens.constants import CART, PURCHASE, VIEW
from basketlens.functions.measures import (
    engagement,
    is_kind,
    kind_count,
    money,
    money_mean,
    units_sum,
)
from basketlens.operators.metrics import rows

TREND_KEYS = ["product_id", "main_category", "brand"]


KIND_SUMS = [f"_{kind}" for kind in (VIEW, CART, PURCHASE)]


def _panes(events: DataFrame, pane: str) -> DataFrame:
    return events.withColumn("pane", F.window("event_time", pane)["start"])


def _whole_panes(spark: SparkSession, window: str, slide: str) -> None:
    """Windows must consist of whole panes."""
    micros = [f"unix_micros(timestamp_seconds(0) + interval {span})" for span in (window, slide)]
    if spark.range(1).select(F.expr(f"{micros[0]} % {micros[1]} <> 0")).first()[0]:
        raise ValueError(f"a window of {window} is no multiple of its slide {slide}")


def trending_parts(events: DataFrame, pane: str = "15 minutes", distinct: str = "exact") -> DataFrame:
    """Additive product activity per pane: a row per user, or (approximate) a sketch of the users."""
    keys, users = ["pane", *TREND_KEYS], []
    if distinct == "approx":
        users = [F.hll_sketch_agg("user_id").alias("_users")]
    else:
        keys.append("user_id")
    return _panes(events, pane).groupBy(*keys).agg(
        rows().alias("_n"),
        *[kind_count(kind).alias(name) for kind, name in zip((VIEW, CART, PURCHASE), KIND_SUMS)],
        units_sum("price").alias("_units"),
        F.count("price").alias("_priced"),
        *users,
    )


def trending_from_parts(
    parts: DataFrame, window: str = "1 hour", slide: str | None = "15 minutes", distinct: str = "exact"
) -> DataFrame:
    """Product activity per window of ``trending_parts`` rows, whatever batches they come from."""
    if slide:
        _whole_panes(parts.sparkSession, window, slide)
    span = F.window("pane", window, slide) if slide else F.window("pane", window)
    sums = [F.sum(name).alias(name) for name in ("_n", *KIND_SUMS, "_units", "_priced")]
    if distinct == "approx":
        users, totals = F.hll_sketch_estimate(F.hll_union_agg("_users")), parts.groupBy(span, *TREND_KEYS)
    else:
        users = rows()
        totals = parts.groupBy(span, *TREND_KEYS, "user_id").agg(*sums).groupBy("window", *TREND_KEYS)
    view, cart, purchase = KIND_SUMS
    return totals.agg(*sums, users.alias("unique_users")).select(
        "window",
        *TREND_KEYS,
        F.col("_n").alias("event_count"),
        F.col(view).alias("views"),
        F.col(cart).alias("carts"),
        F.col(purchase).alias("purchases"),
        "unique_users",
        money_mean("_units", "_priced").alias("avg_price"),
        engagement(view, cart, purchase).alias("trend_score"),
    )


def trending_windows(
    events: DataFrame, window: str = "1 hour", slide: str | None = "15 minutes", distinct: str = "exact"
) -> DataFrame:
    """Product activity per sliding window with its trend score."""
    return trending_from_parts(trending_parts(events, slide or window, distinct), window, slide, distinct)


def category_parts(events: DataFrame, window: str = "30 minutes") -> DataFrame:
    """Additive category activity per window and (user, product)."""
    return _panes(events, window).groupBy("pane", "main_category", "user_id", "product_id").agg(
        rows().alias("_n"),
        units_sum("price", is_kind(PURCHASE)).alias("_revenue"),
        kind_count(PURCHASE).alias("_purchases"),
    )


def category_from_parts(parts: DataFrame, window: str = "30 minutes") -> DataFrame:
    """Category activity per window of ``category_parts`` rows, users and products counted exactly.

    Each row is read once as a user and once as a product, so both distinct
    counts share the two aggregations.
    """
    seen_as = F.explode(
        F.array(
            F.struct(F.lit("user").alias("role"), F.col("user_id").alias("id")),
            F.struct(F.lit("product").alias("role"), F.col("product_id").alias("id")),
        )
    )
    sums = ["_n", "_revenue", "_purchases"]
    tagged = parts.select("pane", "main_category", *sums, seen_as.alias("seen"))
    per_id = tagged.groupBy(
        F.window("pane", window), "main_category", F.col("seen.role").alias("role"), F.col("seen.id").alias("id")
    ).agg(*[F.sum(name).alias(name) for name in sums])
    as_user = F.col("role") == "user"
    totals = per_id.groupBy("window", "main_category").agg(
        F.sum(F.when(as_user, F.col("_n"))).alias("total_events"),
        F.count_if(as_user).alias("active_users"),
        F.count_if(F.col("role") == "product").alias("products_interacted"),
        F.sum(F.when(as_user, F.col("_revenue"))).alias("_revenue"),
        F.sum(F.when(as_user, F.col("_purchases"))).alias("purchases"),
    )
    return totals.select(
        "window",
        "main_category",
        "total_events",
        "active_users",
        "products_interacted",
        money("_revenue").alias("revenue"),
        "purchases",
    )


def category_windows(events: DataFrame, window: str = "30 minutes") -> DataFrame:
    """Category activity per tumbling window, users and products counted exactly."""
    return category_from_parts(category_parts(events, window), window)


def late_rows(parts: DataFrame, delay: str = "1 hour") -> DataFrame:
    """(batch_id, late): rows of each batch whose pane began over ``delay`` before the newest pane of earlier batches.

    They are part of the windows all the same; one row a batch meets in the running maximum.
    """
    newest = parts.groupBy("batch_id").agg(F.max("pane").alias("newest"))
    earlier = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)
    bound = newest.select("batch_id", (F.max("newest").over(earlier) - F.expr(f"interval {delay}")).alias("bound"))
    return parts.join(bound, "batch_id").groupBy("batch_id").agg(
        F.coalesce(F.sum(F.when(F.col("pane") < F.col("bound"), F.col("_n"))), F.lit(0)).alias("late")
    )


def flat_window(frame: DataFrame) -> DataFrame:
    """Window bounds as plain zone-less columns."""
    rest = [c for c in frame.columns if c != "window"]
    start, end = (F.col(f"window.{side}").cast("timestamp_ntz").alias(f"window_{side}") for side in ("start", "end"))
    return frame.select(start, end, *rest)
