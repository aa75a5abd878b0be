"""User, product and brand profiles, and the feature set for clustering."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.constants import PURCHASE, SEGMENT_FEATURES, VIEW
from basketlens.functions.measures import (
    engagement,
    is_kind,
    kind_count,
    kind_counts,
    money,
    money_mean,
    money_share,
    revenue_units,
    share,
    units,
    units_sum,
)
from basketlens.functions.rules import rule_segment
from basketlens.operators.metrics import rows


def first_seen(events: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Attributes of each key's earliest event, ties broken by event id.

    Kept apart from the counting aggregates: strings in an aggregation buffer
    turn the whole aggregate into a sort, which must not hit the row set that
    distinct counts expand. This one reads only the key, the order and the
    attributes, and reduces to one row per key before its shuffle.
    """
    earliest = F.min(F.struct("event_time", "event_id", *columns))
    return events.groupBy(key).agg(earliest.alias("_first")).select(
        key, *[F.col(f"_first.{source}").alias(name) for source, name in columns.items()]
    )


def _distinct(column, exact: bool):
    return F.count_distinct(column) if exact else F.approx_count_distinct(column)


def user_profile_basic(events: DataFrame, asof: dt.datetime | None = None) -> DataFrame:
    """Activity, spend, rates and rule segment of every user."""
    totals = events.groupBy("user_id").agg(
        rows().alias("total_events"),
        *kind_counts("total_views", "total_carts", "total_purchases"),
        revenue_units().alias("_spend"),
        F.max("event_time").alias("last_event_time"),
    )
    return profile_rates(totals, asof)


def profile_rates(totals: DataFrame, asof: dt.datetime | None = None) -> DataFrame:
    """Rates and segment on top of additive profile totals."""
    spent = totals.withColumn("total_spend", money("_spend")).drop("_spend")
    stamp = F.current_timestamp() if asof is None else F.lit(asof).cast("timestamp_ntz")
    return spent.select(
        "user_id",
        "total_events",
        "total_views",
        "total_carts",
        "total_purchases",
        "total_spend",
        "last_event_time",
        (F.col("total_carts") / F.col("total_events")).alias("cart_rate"),
        (F.col("total_purchases") / F.col("total_events")).alias("purchase_rate"),
        rule_segment().alias("segment_label"),
        stamp.alias("profile_updated_at"),
    )


def user_profile_full(events: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """The canonical user profile: activity, spend, diversity, lifetime.

    Three aggregates by user, joined where they are: Spark copies each row
    once per distinct count, and those copies stay narrow when sums and first
    values are computed apart. All three end hash-partitioned by user, so the
    joins add no shuffle.
    """
    totals = events.groupBy("user_id").agg(
        rows().alias("total_events"),
        *kind_counts("total_views", "total_carts", "total_purchases"),
        revenue_units().alias("_spend"),
        units_sum("price", is_kind(VIEW)).alias("_viewed"),
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
    )
    variety = events.groupBy("user_id").agg(
        _distinct("product_id", exact_distinct).alias("unique_products_seen"),
        _distinct("main_category", exact_distinct).alias("category_diversity"),
        _distinct("brand", exact_distinct).alias("brand_diversity"),
        _distinct("event_date", exact_distinct).alias("active_days"),
    )
    favourites = first_seen(events, "user_id", {"main_category": "top_category", "brand": "top_brand"})
    joined = totals.join(variety, "user_id").join(favourites, "user_id")
    kept = [c for c in joined.columns if not c.startswith(("_", "top_"))]
    return joined.select(
        *kept,
        money("_spend").alias("total_spend"),
        money_mean("_spend", "total_purchases").alias("avg_order_value"),
        money_mean("_viewed", "total_views").alias("avg_price_viewed"),
        "top_category",
        "top_brand",
        share(F.col("total_carts") - F.col("total_purchases"), "total_carts", 2, 100).alias("cart_abandonment_rate"),
        share("total_purchases", "total_views", 4, 100).alias("view_to_purchase_rate"),
        (F.col("total_purchases") > 0).alias("is_buyer"),
        F.datediff("last_seen", "first_seen").alias("lifetime_days"),
        share("total_events", "active_days", 2).alias("events_per_day"),
    )


# Names under which profile readers know the measures.
READER_NAMES = {
    "total_views": "views",
    "total_carts": "cart_adds",
    "total_purchases": "purchases",
    "unique_products_seen": "unique_products",
}


def profile_for_readers(profiles: DataFrame) -> DataFrame:
    """The canonical profile under its readers' column names."""
    return profiles.withColumnsRenamed(READER_NAMES)


def profile_summary(profiles: DataFrame) -> DataFrame:
    """Averages over all profiles (reader names)."""
    totals = profiles.agg(
        rows().alias("user_profiles"),
        units_sum("total_spend").alias("_spend"),
        *[F.sum(name).alias(f"_{name}") for name in ("views", "purchases")],
        F.sum(units("cart_abandonment_rate")).alias("_abandon"),
    )
    return totals.select(
        "user_profiles",
        money_share("_spend", "user_profiles").alias("avg_spend"),
        share("_views", "user_profiles", 2).alias("avg_views"),
        share("_purchases", "user_profiles", 2).alias("avg_purchases"),
        money_share("_abandon", "user_profiles", 4).alias("avg_cart_abandonment_rate"),
    )


def highest_spenders(profiles: DataFrame, n: int = 20) -> DataFrame:
    picked = profiles.select("user_id", "total_spend", "views", "purchases", "cart_adds", "unique_products")
    return picked.orderBy(F.desc("total_spend"), "user_id").limit(n)


def top_spender_profiles(profiles: DataFrame, n: int = 10) -> DataFrame:
    """Full-profile report of the biggest spenders."""
    picked = profiles.select(
        "user_id",
        "total_events",
        "total_purchases",
        "total_spend",
        "avg_order_value",
        "cart_abandonment_rate",
        "category_diversity",
        "lifetime_days",
    )
    return picked.orderBy(F.desc("total_spend"), "user_id").limit(n)


def high_intent_users(profiles: DataFrame, n: int = 20) -> DataFrame:
    """Users with cart activity, by purchases and spend."""
    picked = profiles.filter(F.col("cart_adds") > 0).select(
        "user_id", "views", "cart_adds", "purchases", "total_spend", "cart_abandonment_rate"
    )
    return picked.orderBy(F.desc("purchases"), F.desc("total_spend"), "user_id").limit(n)


def top_spenders(profiles: DataFrame, n: int = 20) -> DataFrame:
    """Spend per user over a profile table, largest first."""
    spend = profiles.groupBy("user_id").agg(units_sum("total_spend").alias("_u"))
    return spend.select("user_id", money("_u").alias("spend")).orderBy(F.desc("spend"), "user_id").limit(n)


def _product_totals(events: DataFrame) -> DataFrame:
    """Totals, viewers and buyers per product.

    Summing per (product, user) first makes every distinct user one row: a
    product that everybody touches is spread over its users, and no row is
    copied for the distinct counts.
    """
    per_user = events.groupBy("product_id", "user_id").agg(
        rows().alias("_n"),
        *kind_counts("_views", "_carts", "_buys"),
        units_sum("price").alias("_price"),
        F.count("price").alias("_priced"),
        revenue_units().alias("_revenue"),
        F.min("event_time").alias("_from"),
        F.max("event_time").alias("_to"),
    )
    known = F.col("user_id").isNotNull()
    return per_user.groupBy("product_id").agg(
        F.sum("_n").alias("events"),
        F.sum("_views").alias("views"),
        F.sum("_carts").alias("carts"),
        F.sum("_buys").alias("purchases"),
        F.count_if(known).alias("unique_users"),
        F.count_if(known & (F.col("_views") > 0)).alias("unique_viewers"),
        F.count_if(known & (F.col("_buys") > 0)).alias("unique_buyers"),
        F.sum("_price").alias("_price"),
        F.sum("_priced").alias("_priced"),
        F.sum("_revenue").alias("_revenue"),
        F.min("_from").alias("first_interaction"),
        F.max("_to").alias("last_interaction"),
    )


def product_stats(events: DataFrame) -> DataFrame:
    """Mutable product statistics."""
    totals = _product_totals(events).withColumnsRenamed(
        {"events": "total_interactions", "views": "view_count", "carts": "cart_count", "purchases": "purchase_count"}
    )
    attributes = ["brand", "main_category", "sub_category", "category_code"]
    described = totals.join(first_seen(events, "product_id", {name: name for name in attributes}), "product_id")
    return described.select(
        "product_id",
        *attributes,
        money_mean("_price", "_priced").alias("current_price"),
        "total_interactions",
        "view_count",
        "cart_count",
        "purchase_count",
        "unique_users",
        "unique_buyers",
        money("_revenue").alias("total_revenue"),
        "first_interaction",
        "last_interaction",
        share("purchase_count", "view_count", 4, 100).alias("conversion_rate"),
        share("purchase_count", "cart_count", 2, 100).alias("cart_to_purchase_rate"),
        engagement("view_count", "cart_count", "purchase_count").alias("popularity_score"),
    )


def top_products_by_popularity(stats: DataFrame, n: int = 10) -> DataFrame:
    picked = stats.select(
        "product_id",
        "brand",
        "main_category",
        "view_count",
        "purchase_count",
        "total_revenue",
        "conversion_rate",
        "popularity_score",
    )
    return picked.orderBy(F.desc("popularity_score"), "product_id").limit(n)


def product_performance(events: DataFrame) -> DataFrame:
    """Gold product table with distinct viewers and buyers."""
    totals = _product_totals(events).withColumnsRenamed(
        {"views": "total_views", "carts": "total_carts", "purchases": "total_purchases"}
    )
    attributes = first_seen(events, "product_id", {"brand": "brand", "main_category": "main_category"})
    return totals.join(attributes, "product_id").select(
        "product_id",
        "brand",
        "main_category",
        "total_views",
        "total_carts",
        "total_purchases",
        money("_revenue").alias("total_revenue"),
        "unique_viewers",
        "unique_buyers",
        share("total_purchases", "total_views", 4, 100).alias("conversion_rate"),
        money_mean("_price", "_priced").alias("avg_price"),
    )


def brand_metrics(events: DataFrame) -> DataFrame:
    """Brand table; a missing brand is a group of its own."""
    totals = events.groupBy("brand").agg(
        F.count_distinct("product_id").alias("product_count"),
        rows().alias("total_interactions"),
        F.count_distinct("user_id").alias("total_users"),
        kind_count(PURCHASE).alias("total_purchases"),
        revenue_units().alias("_revenue"),
        units_sum("price").alias("_price"),
        F.count("price").alias("_priced"),
        F.count_distinct("main_category").alias("categories_present"),
    )
    return totals.select(
        "brand",
        "product_count",
        "total_interactions",
        "total_users",
        "total_purchases",
        money("_revenue").alias("total_revenue"),
        money_mean("_price", "_priced").alias("avg_price"),
        "categories_present",
        money_share("_revenue", "total_users").alias("revenue_per_user"),
    )


def user_features(events: DataFrame) -> DataFrame:
    """Clustering features of every user, spend and price statistics alongside."""
    totals = events.groupBy("user_id").agg(
        F.count_distinct("event_date").alias("total_sessions"),
        *kind_counts("total_views", "total_carts", "total_purchases"),
        revenue_units().alias("_spend"),
        F.count_distinct("main_category").alias("category_diversity"),
        F.count_distinct("brand").alias("brand_diversity"),
        F.min("event_time").alias("_from"),
        F.max("event_time").alias("_to"),
        units_sum("price").alias("_price"),
        F.count("price").alias("_priced"),
        F.stddev("price").alias("_spread"),
    )
    seconds = F.unix_timestamp(F.col("_to").cast("timestamp")) - F.unix_timestamp(F.col("_from").cast("timestamp"))
    derived = totals.withColumns(
        {
            "total_spend": money("_spend"),
            "avg_order_value": F.coalesce(money_mean("_spend", "total_purchases"), F.lit(0.0)),
            "avg_viewed_price": F.coalesce(money_mean("_price", "_priced"), F.lit(0.0)),
            "price_std": F.coalesce("_spread", F.lit(0.0)),
            "cart_abandonment_rate": share(F.col("total_carts") - F.col("total_purchases"), "total_carts", 4),
            "purchase_frequency": share("total_purchases", "total_sessions", 4),
            "avg_session_duration_min": share(seconds, F.col("total_sessions") * 60, 2),
        }
    )
    return derived.select("user_id", *SEGMENT_FEATURES, "total_spend", "avg_viewed_price", "price_std")
