"""Explicit schemas: no reader here infers types."""

from __future__ import annotations

from pyspark.sql import types as T

from basketlens.constants import CTR_CATEGORICAL, CTR_LABEL, CTR_NUMERIC

_TYPES = {
    "string": T.StringType,
    "bigint": T.LongType,
    "int": T.IntegerType,
    "double": T.DoubleType,
    "date": T.DateType,
    "timestamp": T.TimestampType,
}


def _schema(columns: str) -> T.StructType:
    """Schema from ``name type, ...``; unlike a DDL string it needs no session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]()) for name, kind in pairs])


EVENT_RAW = _schema(
    "event_time string, event_type string, product_id bigint, category_id bigint, "
    "category_code string, brand string, price double, user_id bigint"
)

# Newer exports also carry the shop's own session key.
EVENT_RAW_WITH_SESSION = T.StructType(EVENT_RAW.fields + [T.StructField("user_session", T.StringType())])

EVENT = _schema(
    "event_id bigint, event_time timestamp, event_date date, event_year int, event_month int, "
    "event_day int, event_type string, product_id bigint, category_id bigint, "
    "category_code string, main_category string, sub_category string, brand string, "
    "price double, user_id bigint, user_session string"
)

LIVE = _schema(
    "event_id string, event_time string, event_type string, product_id string, "
    "category_code string, brand string, price string, user_id string, "
    "session_id string, source string"
)


def event_schema(with_session: bool = False) -> T.StructType:
    """Raw shop-event fields, eight of them or nine with the session key."""
    return EVENT_RAW_WITH_SESSION if with_session else EVENT_RAW


def ctr_schema() -> T.StructType:
    """The 40 fields of a click row."""
    label = [T.StructField(CTR_LABEL, T.IntegerType(), False)]
    numeric = [T.StructField(name, T.FloatType()) for name in CTR_NUMERIC]
    categorical = [T.StructField(name, T.StringType()) for name in CTR_CATEGORICAL]
    return T.StructType(label + numeric + categorical)


# Catalog tables: name -> (columns, partition columns). Monthly partitions of
# daily tables use a derived column, as Parquet tables have no transforms.
TABLES: dict[str, tuple[str, list[str]]] = {
    "events": (
        "event_time timestamp, event_date date, event_year int, event_day int, "
        "product_id bigint, category_id bigint, category_code string, main_category string, "
        "sub_category string, brand string, price double, user_id bigint, "
        "event_month int, event_type string",
        ["event_month", "event_type"],
    ),
    "daily_metrics": (
        "event_date date, total_events bigint, unique_users bigint, unique_products bigint, "
        "total_views bigint, total_carts bigint, total_purchases bigint, total_revenue double, "
        "avg_order_value double, view_to_cart_rate double, cart_to_purchase double, "
        "overall_conversion double, month string",
        ["month"],
    ),
    "product_performance": (
        "product_id bigint, brand string, main_category string, total_views bigint, "
        "total_carts bigint, total_purchases bigint, total_revenue double, "
        "unique_viewers bigint, unique_buyers bigint, conversion_rate double, avg_price double",
        [],
    ),
    "ctr_features": (
        "row_id bigint, label int, "
        + ", ".join(f"{name} float" for name in CTR_NUMERIC)
        + ", "
        + ", ".join(f"{name} string" for name in CTR_CATEGORICAL)
        + ", day int",
        ["day"],
    ),
}
