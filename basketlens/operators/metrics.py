"""Aggregates over shop events.

All of them are one pass: counts, fixed-point sums and distinct counts that
Spark aggregates partially before the shuffle. Distinct counts shuffle on
(group, value), so a group that holds a third of the rows is spread over the
values it contains. Top-k reports end in ``orderBy().limit()`` on the full
sort key, which Spark runs as a bounded heap per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.constants import EVENT_TYPES, LIVE_REQUIRED, PURCHASE, UNKNOWN, VIEW
from basketlens.functions.measures import (
    is_kind,
    kind_count,
    kind_counts,
    money,
    money_mean,
    money_share,
    revenue_units,
    share,
    units_sum,
)
from basketlens.operators.quantiles import exact_quantile


def rows() -> Column:
    return F.count(F.lit(1))


def event_rows(events: DataFrame, kind: str | None = None, name: str = "total") -> DataFrame:
    """Row count, of one event type when given."""
    picked = events if kind is None else events.filter(is_kind(kind))
    return picked.agg(rows().alias(name))


def category_type_stats(events: DataFrame, n: int = 20) -> DataFrame:
    """Busiest (category, event type) pairs with their mean price."""
    grouped = events.filter(F.col("category_code").isNotNull()).groupBy("category_code", "event_type")
    totals = grouped.agg(rows().alias("events"), units_sum("price").alias("_u"), F.count("price").alias("_p"))
    priced = totals.select("category_code", "event_type", "events", F.round(money_mean("_u", "_p"), 2).alias("avg_price"))
    return priced.orderBy(F.desc("events"), "category_code", "event_type").limit(n)


def category_type_counts(events: DataFrame, n: int = 20) -> DataFrame:
    """Busiest (category, event type) pairs, events without a category included."""
    counted = events.groupBy("category_code", "event_type").agg(rows().alias("events"))
    return counted.orderBy(F.desc("events"), "category_code", "event_type").limit(n)


def event_type_distribution(events: DataFrame) -> DataFrame:
    totals = events.groupBy("event_type").agg(
        rows().alias("events"), units_sum("price").alias("_u"), F.count("price").alias("_p")
    )
    return totals.select(
        "event_type", "events", F.round(money_mean("_u", "_p"), 2).alias("avg_price")
    ).orderBy(F.desc("events"), "event_type")


def daily_event_volume(events: DataFrame, n: int = 50) -> DataFrame:
    keys = ["event_date", "event_type"]
    return events.groupBy(*keys).agg(rows().alias("events")).orderBy(*keys).limit(n)


def hourly_volume(events: DataFrame) -> DataFrame:
    counted = events.groupBy("event_type", F.hour("event_time").alias("hour")).agg(rows().alias("event_count"))
    return counted.orderBy("event_type", "hour")


def hourly_traffic(events: DataFrame) -> DataFrame:
    hours = events.groupBy(F.hour("event_time").alias("hour_of_day"))
    return hours.agg(rows().alias("events"), F.count_distinct("user_id").alias("users")).orderBy("hour_of_day")


def trending_products(events: DataFrame) -> DataFrame:
    """Products by views, with mean viewed price and distinct viewers."""
    views = events.filter(is_kind(VIEW)).groupBy("product_id", "category_code", "brand")
    totals = views.agg(
        rows().alias("view_count"),
        units_sum("price").alias("_u"),
        F.count("price").alias("_p"),
        F.count_distinct("user_id").alias("unique_viewers"),
    )
    return totals.select(
        "product_id", "category_code", "brand", "view_count", money_mean("_u", "_p").alias("avg_price"), "unique_viewers"
    ).orderBy(F.desc("view_count"), "product_id", "category_code", "brand")


def top_products(
    events: DataFrame,
    kind: str,
    name: str,
    n: int = 20,
    keys: tuple[str, ...] = ("product_id", "brand", "category_code"),
) -> DataFrame:
    """Products with the most events of one type."""
    counted = events.filter(is_kind(kind)).groupBy(*keys).agg(rows().alias(name))
    return counted.orderBy(F.desc(name), *keys).limit(n)


def daily_metrics(events: DataFrame) -> DataFrame:
    """Gold daily table: volume, audience, revenue and conversion rates."""
    days = events.groupBy("event_date").agg(
        rows().alias("total_events"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("product_id").alias("unique_products"),
        *kind_counts("total_views", "total_carts", "total_purchases"),
        revenue_units().alias("_revenue"),
    )
    return days.select(
        *[c for c in days.columns if c != "_revenue"],
        money("_revenue").alias("total_revenue"),
        money_share("_revenue", "total_purchases").alias("avg_order_value"),
        share("total_carts", "total_views", 2, 100).alias("view_to_cart_rate"),
        share("total_purchases", "total_carts", 2, 100).alias("cart_to_purchase"),
        share("total_purchases", "total_views", 4, 100).alias("overall_conversion"),
    )


def daily_trend(events: DataFrame) -> DataFrame:
    days = events.groupBy("event_date").agg(
        rows().alias("total_events"), F.count_distinct("user_id").alias("unique_users"), revenue_units().alias("_r")
    )
    return days.select("event_date", "total_events", "unique_users", money("_r").alias("revenue")).orderBy("event_date")


def category_revenue(events: DataFrame, n: int = 10) -> DataFrame:
    """Main categories by purchase revenue."""
    totals = events.groupBy("main_category").agg(
        rows().alias("total_events"), revenue_units().alias("_r"), F.count_distinct("user_id").alias("unique_users")
    )
    priced = totals.select("main_category", "total_events", money("_r").alias("revenue"), "unique_users")
    return priced.orderBy(F.desc("revenue"), "main_category").limit(n)


def category_buyers(events: DataFrame, n: int = 15) -> DataFrame:
    """Main categories by revenue, purchases only, with distinct buyers."""
    totals = (
        events.filter(is_kind(PURCHASE))
        .groupBy("main_category")
        .agg(rows().alias("purchases"), units_sum("price").alias("_r"), F.count_distinct("user_id").alias("buyers"))
    )
    priced = totals.select("main_category", "purchases", money("_r").alias("revenue"), "buyers")
    return priced.orderBy(F.desc("revenue"), "main_category").limit(n)


def category_price_revenue(events: DataFrame) -> DataFrame:
    totals = events.groupBy("main_category").agg(rows().alias("cnt"), units_sum("price").alias("_r"))
    return totals.select("main_category", "cnt", money("_r").alias("revenue"))


def funnel(events: DataFrame) -> DataFrame:
    """Stages in funnel order, each with its share of the first stage's users."""
    stages = events.groupBy("event_type").agg(
        rows().alias("total"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("product_id").alias("unique_products"),
    )
    order = F.array_position(F.array(*[F.lit(kind) for kind in EVENT_TYPES]), F.col("event_type"))
    first = stages.filter(is_kind(EVENT_TYPES[0])).select("unique_users").scalar()
    return (
        stages.withColumn("stage", order.cast("int"))
        .withColumn("pct_of_first", share("unique_users", first, 2, 100))
        .orderBy("stage", "event_type")
    )


def user_activity(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(
        rows().alias("total_events"),
        F.count_distinct("event_date").alias("active_days"),
        kind_count(PURCHASE).alias("purchases"),
    )


def active_users(events: DataFrame, min_events: int = 100) -> DataFrame:
    """Users with more than ``min_events`` events."""
    busy = events.groupBy("user_id").agg(
        F.count_distinct("event_date").alias("active_days"), rows().alias("events")
    )
    return busy.filter(F.col("events") > min_events)


def buyer_share(activity: DataFrame) -> DataFrame:
    """How many users bought at all."""
    totals = activity.agg(rows().alias("users"), F.count_if(F.col("purchases") > 0).alias("buyers"))
    return totals.withColumn("buyer_share", F.when(F.col("users") > 0, F.col("buyers") / F.col("users")))


def top_brands(events: DataFrame, n: int = 20) -> DataFrame:
    totals = (
        events.filter(F.col("brand") != UNKNOWN)
        .groupBy("brand")
        .agg(rows().alias("interactions"), revenue_units().alias("_r"), F.count_distinct("user_id").alias("users"))
    )
    priced = totals.select("brand", "interactions", money("_r").alias("revenue"), "users")
    return priced.orderBy(F.desc("revenue"), "brand").limit(n)


def ingest_stats(events: DataFrame, exact_median: bool = False) -> DataFrame:
    """Load report in one pass: volumes, shares, distincts, dates, prices.

    The median is approximate by default. ``exact_median`` finds it by rounds of
    histograms, which run at once: each reads the prices, and no task holds them.
    """
    totals = events.agg(
        rows().alias("total_events"),
        *kind_counts("views", "carts", "purchases"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("product_id").alias("unique_products"),
        F.count_distinct("brand").alias("unique_brands"),
        F.count_distinct("main_category").alias("unique_categories"),
        F.min("event_date").alias("first_date"),
        F.max("event_date").alias("last_date"),
        units_sum("price").alias("_u"),
        F.count("price").alias("_p"),
        F.min("price").alias("price_min"),
        F.max("price").alias("price_max"),
    )
    if exact_median:
        median = F.lit(exact_quantile(events, ["price"])["price"]).cast("double")
    else:
        median = events.agg(F.percentile_approx("price", 0.5)).scalar()
    shares = [share(name, "total_events", 1, 100).alias(f"{name}_pct") for name in ("views", "carts", "purchases")]
    return totals.select(
        *[c for c in totals.columns if not c.startswith("_")],
        *shares,
        money_mean("_u", "_p").alias("price_mean"),
        median.alias("price_median"),
    )


def histogram(
    rows_: DataFrame, column: str, bins: int, low: float, high: float, by: list[str] | None = None
) -> DataFrame:
    """Equal-width counts over [low, high); values outside are not counted."""
    by = by or []
    width = (high - low) / bins
    picked = rows_.filter((F.col(column) >= low) & (F.col(column) < high))
    slot = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("int")
    counted = picked.groupBy(*by, slot.alias("bin")).agg(rows().alias("n"))
    edge = F.lit(float(low)) + F.col("bin") * F.lit(float(width))
    return counted.select(*by, "bin", edge.alias("bin_start"), "n")


def price_histogram(events: DataFrame, bins: int = 100, low: float = 0, high: float = 1000) -> DataFrame:
    """Price distribution per event type, positive prices below ``high``."""
    return histogram(events.filter(F.col("price") > 0), "price", bins, low, high, ["event_type"])


def trending_by_category(trending: DataFrame) -> DataFrame:
    """Roll-up of a trending table to main categories."""
    totals = trending.groupBy("main_category").agg(
        F.sum("trend_score").alias("total_trend_score"),
        rows().alias("trending_products"),
        F.sum("purchases").alias("total_purchases"),
    )
    return totals.orderBy(F.desc("total_trend_score"), "main_category")


def top_trending(trending: DataFrame, n: int = 20, category: str | None = None) -> DataFrame:
    """Highest trend scores, window bounds flattened."""
    picked = trending if category is None else trending.filter(F.col("main_category") == category)
    flat = picked.select(
        "product_id",
        "brand",
        "main_category",
        "views",
        "carts",
        "purchases",
        "unique_users",
        "trend_score",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
    )
    return flat.orderBy(F.desc("trend_score"), F.desc("window_start"), "product_id", "brand", "main_category").limit(n)


def schema_match(frame: DataFrame, required: list[str] = LIVE_REQUIRED) -> DataFrame:
    """Share of required columns present, and how often all of them are filled."""
    present = [name for name in required if name in frame.columns]
    pct = round(len(present) / len(required) * 100, 1)
    filled = F.lit(len(present) == len(required))
    for name in present:
        filled = filled & F.col(name).isNotNull()
    totals = frame.agg(rows().alias("events"), F.count_if(filled).alias("complete_events"))
    return totals.select(F.lit(pct).alias("schema_match_pct"), "events", "complete_events")


def frame_profile(frame: DataFrame, name: str) -> DataFrame:
    """Row count, column count and column names of a frame."""
    columns = F.lit(",".join(frame.columns))
    return frame.agg(rows().alias("row_count")).select(
        F.lit(name).alias("name"), "row_count", F.lit(len(frame.columns)).alias("column_count"), columns.alias("columns")
    )


