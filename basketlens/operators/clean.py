"""Typing and cleaning of raw events and click rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.constants import CTR_CATEGORICAL, CTR_NUMERIC, EVENT_TYPES, MISSING_CATEGORY, UNKNOWN
from basketlens.functions.rules import stable_bucket
from basketlens.operators.quantiles import exact_quantile
from basketlens.session import materialise, spread_out

# The zone suffix and time pattern of export files.
ZONE_SUFFIX = " UTC$"
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"

FINAL_COLUMNS = [
    "event_id",
    "event_time",
    "event_date",
    "event_year",
    "event_month",
    "event_day",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "main_category",
    "sub_category",
    "brand",
    "price",
    "user_id",
    "user_session",
]


def parse_utc_time(text: str = "event_time") -> Column:
    """Export time as timestamp; null when it does not parse."""
    return F.try_to_timestamp(F.regexp_replace(text, ZONE_SUFFIX, ""), F.lit(TIME_PATTERN))


def main_category(code: str = "category_code") -> Column:
    """Text before the first dot."""
    return F.coalesce(F.substring_index(code, ".", 1), F.lit(UNKNOWN))


def sub_category(code: str = "category_code") -> Column:
    """Text after the first dot; a code without a dot has none."""
    dot = F.instr(code, ".")
    return F.when(dot > 0, F.expr(f"substring({code}, instr({code}, '.') + 1)")).otherwise(F.lit(UNKNOWN))


def clean_brand(brand: str = "brand") -> Column:
    return F.coalesce(F.trim(brand), F.lit(UNKNOWN))


def date_parts(time: str = "event_time") -> dict[str, Column]:
    return {
        "event_date": F.to_date(time),
        "event_year": F.year(time),
        "event_month": F.month(time),
        "event_day": F.dayofmonth(time),
    }


def valid_event() -> Column:
    """Known type, keys and time present, positive price."""
    present = F.lit(True)
    for name in ("product_id", "user_id", "event_time"):
        present = present & F.col(name).isNotNull()
    return F.col("event_type").isin(EVENT_TYPES) & present & (F.col("price") > 0)


def type_events(raw: DataFrame) -> DataFrame:
    """Cast text fields; drop rows without a readable time."""
    time = parse_utc_time() if _is_text(raw, "event_time") else F.col("event_time")
    casts = {"product_id": "bigint", "user_id": "bigint", "price": "double"}
    typed = raw.withColumns(
        {"event_time": time, **{name: F.expr(f"try_cast({name} as {kind})") for name, kind in casts.items()}}
    )
    return typed.filter(F.col("event_time").isNotNull()).withColumn("event_date", F.to_date("event_time"))


def clean_events(raw: DataFrame) -> DataFrame:
    """Raw shop events to the canonical schema, valid rows only.

    ``event_id`` breaks ties between events of the same instant. Sources
    without one get a hash of the row: equal rows tie, and then either order
    gives the same result.
    """
    if _is_text(raw, "event_time"):
        raw = raw.withColumn("event_time", parse_utc_time())
    if "event_id" not in raw.columns:
        raw = raw.withColumn("event_id", F.xxhash64(*raw.columns))
    optional = {"user_session": "string", "category_id": "bigint"}
    raw = raw.withColumns({name: F.lit(None).cast(kind) for name, kind in optional.items() if name not in raw.columns})
    derived = {
        **date_parts(),
        "main_category": main_category(),
        "sub_category": sub_category(),
        "brand": clean_brand(),
    }
    return raw.filter(valid_event()).withColumns(derived).select(FINAL_COLUMNS)


def _is_text(frame: DataFrame, name: str) -> bool:
    return isinstance(frame.schema[name].dataType, T.StringType)


def drop_missing_keys(frame: DataFrame, *keys: str) -> DataFrame:
    return frame.dropna(subset=list(keys))


def numeric_columns(frame: DataFrame, prefix: str = "I") -> list[str]:
    """Feature columns picked by name prefix."""
    return [name for name in frame.columns if name.startswith(prefix)]


def fill_zero(rows: DataFrame) -> DataFrame:
    """Missing numerics become 0, missing categoricals a placeholder."""
    fills: dict = {name: 0.0 for name in CTR_NUMERIC if name in rows.columns}
    fills.update({name: MISSING_CATEGORY for name in CTR_CATEGORICAL if name in rows.columns})
    return rows.na.fill(fills)


def fill_median(
    rows: DataFrame, accuracy: int = 10_000, exact: bool = False, measured: DataFrame | None = None
) -> DataFrame:
    """Missing numerics become the column's median, all found in the same passes: one, or a few for the exact ones.

    ``measured`` names the same rows in an order that is cheaper to read, as medians don't depend on it.
    """
    names = [name for name in CTR_NUMERIC if name in rows.columns]
    measured = rows if measured is None else measured
    if exact:
        medians = exact_quantile(measured, names)
    else:
        medians = measured.agg(*[F.percentile_approx(name, 0.5, accuracy).alias(name) for name in names]).first().asDict()
    fills: dict = {name: value for name, value in medians.items() if value is not None}
    fills.update({name: MISSING_CATEGORY for name in CTR_CATEGORICAL if name in rows.columns})
    return rows.na.fill(fills)


def hash_sample(rows: DataFrame, fraction: float, *keys: str) -> DataFrame:
    """A repeatable sample: the same keys are in or out on every run."""
    buckets = 1_000_000
    return rows.filter(stable_bucket(*keys, buckets=buckets) < int(round(fraction * buckets)))


def hash_split(rows: DataFrame, test: float, *keys: str) -> tuple[DataFrame, DataFrame]:
    """Repeatable train / test split on the given keys."""
    held_out = _held_out(rows, test, *keys)
    return rows.filter(~held_out), rows.filter(held_out)


def _held_out(rows: DataFrame, test: float, *keys: str) -> Column:
    alike = len({field.dataType for field in rows.select(*keys).schema}) == 1
    return stable_bucket(*keys, alike=alike) >= int(round((1 - test) * 100))


def with_flag(rows: DataFrame, test: float, *keys: str) -> DataFrame:
    """``rows`` with a flag for the test half of ``hash_split``, to be stored with them."""
    return rows.withColumn("_held_out", _held_out(rows, test, *keys))


def flagged_halves(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The halves of stored rows that ``with_flag`` has marked."""
    return flagged.filter(~F.col("_held_out")).drop("_held_out"), flagged.filter("_held_out").drop("_held_out")


def stored_split(rows: DataFrame, test: float, *keys: str, name: str, spread: bool = False) -> tuple[DataFrame, DataFrame]:
    """The halves of ``hash_split``, read from rows written once.

    The digest of the keys is taken while the rows are written and stored as a
    flag, so that passes over a half don't spell out and hash all keys again.
    """
    dealt = spread_out(rows) if spread else rows
    return flagged_halves(materialise(with_flag(dealt, test, *keys), name))
