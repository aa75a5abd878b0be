"""Data-quality checks: one aggregate pass per table, however many checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.constants import CART, CTR_LABEL, CTR_NUMERIC, EVENT_TYPES, PURCHASE, VIEW
from basketlens.functions.measures import kind_count
from basketlens.operators.metrics import rows

INFO, WARNING, CRITICAL = "info", "warning", "critical"
ROWS = "n_rows"


@dataclass
class Check:
    """A verdict over aggregate metrics of a table.

    ``metrics`` are the aggregates to compute, by name; the other columns are
    evaluated on the one row that holds them all.
    """

    name: str
    passed: Column
    value: Column
    details: Column
    severity: str | Column = WARNING
    metrics: dict[str, Column] = field(default_factory=dict)


def percent(part: str, whole: str = ROWS, empty: float = 100.0) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) * F.lit(100.0) / F.col(whole)).otherwise(F.lit(empty))


def _of_rows(part: str) -> Column:
    return F.concat_ws(" of ", F.col(part).cast("string"), F.col(ROWS).cast("string"))


def _text(value: str | Column) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(value.cast("string"), F.lit("none"))


def _missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN where the type has one."""
    absent = F.col(column).isNull()
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        absent = absent | F.isnan(column)
    return absent


def not_empty() -> Check:
    return Check("not empty", F.col(ROWS) > 0, F.col(ROWS).cast("double"), _text(ROWS), CRITICAL)


def not_all_null(df: DataFrame, column: str) -> Check:
    """Fails on a column without any value; severe from half missing."""
    metric = f"missing_{column}"
    share = percent(metric)
    severity = F.when(share < 50, F.lit(WARNING)).otherwise(F.lit(CRITICAL))
    counted = {metric: F.count_if(_missing(df, column))}
    return Check(f"{column} has values", share < 100, share, _of_rows(metric), severity, counted)


def null_at_most(column: str, threshold: float) -> Check:
    metric = f"null_{column}"
    share = percent(metric)
    counted = {metric: F.count_if(F.col(column).isNull())}
    return Check(f"{column} null <= {threshold:g}%", share <= threshold, share, _of_rows(metric), metrics=counted)


def min_distinct(column: str, expected: int) -> Check:
    metric = f"distinct_{column}"
    found = F.col(metric)
    counted = {metric: F.count_distinct(column)}
    return Check(f"{column} distinct >= {expected}", found >= expected, found.cast("double"), _text(metric), metrics=counted)


def in_range(column: str, low: float, high: float) -> Check:
    """All values within bounds; a column without values does not pass."""
    lowest, highest = f"min_{column}", f"max_{column}"
    inside = F.coalesce((F.col(lowest) >= low) & (F.col(highest) <= high), F.lit(False))
    return Check(
        f"{column} in [{low:g}, {high:g}]",
        inside,
        F.col(highest).cast("double"),
        F.when(inside, "all within").otherwise("outside or empty"),
        metrics={lowest: F.min(column), highest: F.max(column)},
    )


def allowed_values(column: str, expected: list, severity: str = WARNING) -> Check:
    """No value outside the expected set; nulls are not judged."""
    metric = f"unexpected_{column}"
    found = F.col(metric)
    counted = {metric: F.count_distinct(F.when(~F.col(column).isin(expected), F.col(column)))}
    return Check(f"{column} values known", found == 0, found.cast("double"), _text(metric), severity, counted)


def no_duplicates(keys: list[str]) -> Check:
    metric = "distinct_" + "_".join(keys)
    extra = F.col(ROWS) - F.col(metric)
    counted = {metric: F.count_distinct(F.struct(*keys))}
    return Check(f"no duplicates on {', '.join(keys)}", extra == 0, extra.cast("double"), _text(extra), metrics=counted)


def unexpected_values(df: DataFrame, column: str, expected: list) -> DataFrame:
    """The values outside the expected set, with their frequency."""
    outside = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(expected))
    return outside.groupBy(column).agg(rows().alias("n"))


def run_checks(df: DataFrame, dataset: str, checks: list[Check]) -> DataFrame:
    """One row per check: dataset, check, passed, severity, value, details."""
    metrics: dict[str, Column] = {ROWS: rows()}
    for check in checks:
        metrics.update(check.metrics)
    totals = df.agg(*[column.alias(name) for name, column in metrics.items()])
    records = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(check.name).alias("check"),
            F.coalesce(check.passed, F.lit(False)).alias("passed"),
            (F.lit(check.severity) if isinstance(check.severity, str) else check.severity).alias("severity"),
            check.value.alias("value"),
            check.details.alias("details"),
        )
        for check in checks
    ]
    return totals.select(F.inline(F.array(*records)))


def event_checks(events: DataFrame, min_users: int = 10_000, min_products: int = 10_000) -> list[Check]:
    """The event suite."""
    kinds = {f"n_{kind}": kind_count(kind) for kind in (VIEW, CART, PURCHASE)}
    views = percent(f"n_{VIEW}", empty=0.0)
    conversion = percent(f"n_{PURCHASE}", f"n_{VIEW}", empty=0.0)
    return [
        not_empty(),
        *[not_all_null(events, name) for name in ("event_time", "event_type", "product_id", "user_id", "price")],
        allowed_values("event_type", EVENT_TYPES),
        in_range("price", 0.01, 100_000),
        min_distinct("user_id", min_users),
        min_distinct("product_id", min_products),
        null_at_most("main_category", 50),
        null_at_most("brand", 70),
        Check("views are the majority", views > 50, views, _of_rows(f"n_{VIEW}"), metrics=kinds),
        Check("conversion below 10%", conversion < 10, conversion, _text(f"n_{PURCHASE}"), INFO, kinds),
    ]


def ctr_checks(clicks: DataFrame) -> list[Check]:
    """The click-row suite."""
    clicked = {"clicks": F.count_if(F.col(CTR_LABEL) == 1)}
    rate = percent("clicks", empty=0.0)
    width = len(clicks.columns)
    return [
        not_empty(),
        allowed_values(CTR_LABEL, [0, 1], CRITICAL),
        *[null_at_most(name, 80) for name in CTR_NUMERIC[:5]],
        Check("click rate within 1-10%", rate.between(1, 10), rate, _of_rows("clicks"), INFO, clicked),
        Check("at least 40 columns", F.lit(width >= 40), F.lit(float(width)), F.lit(str(width))),
    ]


def dq_events(events: DataFrame, **limits: int) -> DataFrame:
    return run_checks(events, "events", event_checks(events, **limits))


def dq_ctr(clicks: DataFrame) -> DataFrame:
    return run_checks(clicks, "clicks", ctr_checks(clicks))


def quality_report(*results: DataFrame) -> DataFrame:
    """Per dataset: counts, pass rate and status.

    Any failed critical check means FAIL, any other failure WARN.
    """
    checks = results[0]
    for more in results[1:]:
        checks = checks.unionByName(more)
    totals = checks.groupBy("dataset").agg(
        rows().alias("total_checks"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.count_if(~F.col("passed") & (F.col("severity") == CRITICAL)).alias("_critical"),
    )
    status = F.when(F.col("failed") == 0, "PASS").when(F.col("_critical") > 0, "FAIL").otherwise("WARN")
    rate = F.round(F.col("passed") / F.col("total_checks"), 4)
    return totals.select("dataset", status.alias("status"), rate.alias("pass_rate"), "total_checks", "passed", "failed")
