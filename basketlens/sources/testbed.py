"""The driver's star-schema tables seen as shop events, click rows and live events.

The mapping is fixed in FIXTURES.md; product ids cover all parts of the scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.constants import CART, CTR_CATEGORICAL, CTR_NUMERIC, PURCHASE, VIEW
from basketlens.operators.clean import clean_events
from basketlens.session import spread_out

# Fixed values of the mapping.
TYPE_MAP = {"view": VIEW, "click": VIEW, "signup": CART, "purchase": PURCHASE}
PRODUCT_STEP = 7919


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shop events before cleaning: invalid types and missing attributes included."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    for source, target in TYPE_MAP.items():
        kind = F.when(F.col("event_type") == source, target).otherwise(kind)
    parts = table(spark, sf_dir, "part").agg(F.count("*")).scalar()
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("event_time"),
        kind.alias("event_type"),
        F.pmod(F.col("event_id") * PRODUCT_STEP, parts).alias("product_id"),
        k.alias("k"),
        F.col("value").alias("price"),
        "user_id",
        F.concat_ws("_", "user_id", F.date_format("ts", "yyyyMMdd")).alias("user_session"),
    )
    words = F.split("p_name", " ")
    products = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat_ws(".", F.lower("p_type"), words[1], words[0]).alias("part_category"),
        F.lower("p_brand").alias("part_brand"),
    )
    return events.join(products, "product_id").select(
        "event_id",
        "event_time",
        "event_type",
        "product_id",
        F.lit(None).cast("long").alias("category_id"),
        F.when(F.col("k") % 10 != 0, F.col("part_category")).alias("category_code"),
        F.when(F.col("k") % 7 != 0, F.col("part_brand")).alias("brand"),
        "price",
        "user_id",
        "user_session",
        "k",
    )


def shop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean canonical shop events."""
    return clean_events(raw_events(spark, sf_dir).drop("k"))


def raw_text_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as an export file holds them: every field text, times with a zone suffix."""
    raw = raw_events(spark, sf_dir).drop("k", "category_id")
    text = [F.col(name).cast("string").alias(name) for name in ("event_type", "category_code", "brand", "user_session")]
    numbers = [F.col(name).cast("string").alias(name) for name in ("product_id", "price", "user_id")]
    stamp = F.concat(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")).alias("event_time")
    return raw.select("event_id", stamp, *text, *numbers)


def ctr_rows(spark: SparkSession, sf_dir: str, clustered: bool = False, spread: bool = False) -> DataFrame:
    """Line items as click rows.

    The 26 digests of a row follow from its supplier and are 1.7 kB of text.
    ``clustered`` sorts the narrow line items of each partition by supplier, for
    consumers that write whole rows: equal digests then stand in runs, which a
    column file holds once, whatever the number of suppliers. ``spread`` deals
    a small input to all cores, while its rows are narrow.
    """
    lines = table(spark, sf_dir, "lineitem")
    if spread:
        lines = spread_out(lines)
    if clustered:
        lines = lines.sortWithinPartitions("l_suppkey")
    known = F.col("l_orderkey") % 11 != 0
    numeric = [
        F.col("l_quantity"),
        F.col("l_extendedprice"),
        F.col("l_discount"),
        F.col("l_tax"),
        F.when(known, F.col("l_partkey") % 10),
        F.when(known, F.col("l_partkey") % 100),
        F.when(known, F.col("l_suppkey") % 5),
        F.col("l_linenumber"),
        F.col("l_orderkey") % 7,
        F.col("l_orderkey") % 13,
        F.col("l_partkey") % 3,
        F.col("l_suppkey") % 7,
        F.col("l_linenumber") * 2,
    ]
    return lines.select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        *[value.cast("double").alias(name) for value, name in zip(numeric, CTR_NUMERIC)],
        *[
            F.sha2(F.concat_ws("_", F.lit(i), F.col("l_suppkey")), 256).alias(name)
            for i, name in enumerate(CTR_CATEGORICAL, start=1)
        ],
        F.col("l_linenumber").alias("day"),
    )


def live_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the live feed sends them: string ids, some bad prices and times."""
    raw = raw_events(spark, sf_dir)
    return raw.select(
        F.concat(F.lit("e"), "event_id").alias("event_id"),
        F.when(F.col("k") % 17 == 0, "not-a-time")
        .otherwise(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .alias("event_time"),
        "event_type",
        F.col("product_id").cast("string").alias("product_id"),
        "category_code",
        "brand",
        F.when(F.col("k") % 13 == 0, "n/a").otherwise(F.col("price").cast("string")).alias("price"),
        F.concat(F.lit("u"), "user_id").alias("user_id"),
        F.when(F.col("k") % 5 != 0, F.col("user_session")).alias("session_id"),
        F.lit("shop").alias("source"),
    )
