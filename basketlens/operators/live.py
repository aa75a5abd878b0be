"""Live events: typing, normalisation, key figures and the overlay on history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.measures import money, money_mean, units_sum
from basketlens.operators.metrics import rows


def type_live(feed: DataFrame) -> DataFrame:
    """Typed live events: an unreadable price counts as 0, an unreadable time as missing."""
    return feed.withColumns(
        {
            "event_time": F.expr("cast(try_cast(event_time as timestamp) as timestamp_ntz)"),
            "price": F.coalesce(F.expr("try_cast(price as double)"), F.lit(0.0)),
        }
    )


def normalise_live(feed: DataFrame, arrived_at: Column | None = None) -> DataFrame:
    """Complete posted events for storage.

    Missing ids are generated, a missing time is the time of arrival, a
    missing session is named after its user; date folders follow the time.
    """
    now = (F.current_timestamp() if arrived_at is None else arrived_at).cast("timestamp_ntz")
    complete = type_live(feed).withColumns(
        {
            "event_id": F.coalesce("event_id", F.expr("uuid()")),
            "event_time": F.coalesce("event_time", now),
            "session_id": F.coalesce("session_id", F.concat(F.lit("session_"), "user_id")),
        }
    )
    return complete.withColumns(
        {
            "year": F.date_format("event_time", "yyyy"),
            "month": F.date_format("event_time", "MM"),
            "day": F.date_format("event_time", "dd"),
        }
    )


def append_live(feed: DataFrame, path: str) -> None:
    """Store normalised events as JSON in ``year=/month=/day=`` folders."""
    normalise_live(feed).write.mode("append").partitionBy("year", "month", "day").json(path)


def newest_live(live: DataFrame, n: int = 20) -> DataFrame:
    """Latest live events first."""
    picked = live.select("event_id", "event_type", "product_id", "brand", "user_id", "price", "event_time", "source")
    return picked.orderBy(F.desc_nulls_last("event_time"), "event_id").limit(n)


def live_kpis(live: DataFrame) -> DataFrame:
    """Key figures of typed live events in one row."""
    categories = live.filter(F.col("category_code").isNotNull()).groupBy("category_code").agg(rows().alias("_n"))
    top = categories.orderBy(F.desc("_n"), "category_code").limit(1).select("category_code").scalar()
    totals = live.agg(
        rows().alias("live_events"),
        F.count_distinct("user_id").alias("active_users"),
        F.count_distinct("product_id").alias("unique_products"),
        F.count_distinct("session_id").alias("unique_sessions"),
        units_sum("price").alias("_gmv"),
        F.count("price").alias("_priced"),
        F.max("event_time").alias("latest_event_time"),
    )
    return totals.select(
        "live_events",
        "active_users",
        "unique_products",
        "unique_sessions",
        money("_gmv").alias("gmv"),
        money_mean("_gmv", "_priced").alias("avg_price"),
        "latest_event_time",
        F.coalesce(top, F.lit("unknown")).alias("top_category"),
    )


OVERLAY_KEYS = ["product_id", "brand", "category_code"]


def live_overlay(history: DataFrame, live: DataFrame) -> DataFrame:
    """Historical views plus live events per product; missing keys match each other."""
    counted = live.groupBy(*OVERLAY_KEYS).agg(rows().alias("live_events"))
    past, now = history.alias("h"), counted.alias("l")
    same = F.lit(True)
    for key in OVERLAY_KEYS:
        same = same & F.col(f"h.{key}").eqNullSafe(F.col(f"l.{key}"))
    joined = past.join(now, same, "left")
    seen = F.coalesce("live_events", F.lit(0).cast("long"))
    return joined.select(
        *[F.col(f"h.{key}") for key in OVERLAY_KEYS],
        "historical_views",
        seen.alias("live_events"),
        (F.col("historical_views") + seen).alias("combined_views"),
    )
