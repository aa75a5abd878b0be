"""Column builders shared by the aggregates.

Money is summed as fixed-point integers (1/10000 of the currency unit): the
sum does not depend on row order, stays in a long inside whole-stage codegen,
and overflows loudly under ANSI rules. Ratios multiply before they divide, so
a value that lies exactly on a rounding boundary rounds half up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketlens.constants import CART, PURCHASE, VIEW, WEIGHTS

MONEY_UNITS = 10_000


def is_kind(kind: str) -> Column:
    return F.col("event_type") == kind


def kind_count(kind: str) -> Column:
    """Rows of one event type."""
    return F.count_if(is_kind(kind))


def kind_counts(view: str, cart: str, purchase: str) -> list[Column]:
    """The three event-type counts under the given output names."""
    names = {VIEW: view, CART: cart, PURCHASE: purchase}
    return [kind_count(kind).alias(name) for kind, name in names.items()]


def units(amount: str | Column) -> Column:
    """An amount as fixed-point long."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.rint(amount * MONEY_UNITS).cast("long")


def units_sum(amount: str | Column, where: Column | None = None) -> Column:
    """Exact sum of an amount in fixed-point units, 0 for no rows."""
    value = units(amount)
    if where is not None:
        value = F.when(where, value)
    return F.coalesce(F.sum(value), F.lit(0).cast("long"))


def revenue_units() -> Column:
    return units_sum("price", is_kind(PURCHASE))


def money(total_units: str | Column) -> Column:
    """Fixed-point units back to a double."""
    total_units = F.col(total_units) if isinstance(total_units, str) else total_units
    return total_units / F.lit(float(MONEY_UNITS))


def money_mean(total_units: str | Column, rows: str | Column) -> Column:
    """Mean amount, null when there are no rows."""
    total_units = F.col(total_units) if isinstance(total_units, str) else total_units
    rows = F.col(rows) if isinstance(rows, str) else rows
    return F.when(rows > 0, total_units / (rows * F.lit(float(MONEY_UNITS))))


def share(part: str | Column, whole: str | Column, digits: int, scale: int = 1) -> Column:
    """``part / whole * scale`` rounded half up, 0.0 for an empty whole."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.when(whole > 0, F.round(part * F.lit(float(scale)) / whole, digits)).otherwise(F.lit(0.0))


def money_share(total_units: str | Column, rows: str | Column, digits: int = 2) -> Column:
    """Amount per row, rounded half up, 0.0 for no rows."""
    return F.coalesce(F.round(money_mean(total_units, rows), digits), F.lit(0.0))


def weight(default: int = 0) -> Column:
    """Implicit-feedback weight of an event."""
    rule = F
    for kind, value in WEIGHTS.items():
        rule = rule.when(is_kind(kind), F.lit(value))
    return rule.otherwise(F.lit(default)).cast("long")


def engagement(views: str, carts: str, purchases: str) -> Column:
    """Weighted interaction score, two decimals."""
    parts = [F.col(name) * F.lit(float(WEIGHTS[kind])) for name, kind in ((views, VIEW), (carts, CART), (purchases, PURCHASE))]
    return F.round(parts[0] + parts[1] + parts[2], 2)
