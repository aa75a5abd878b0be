"""Exact quantiles by rounds of histograms.

A round counts the values of a range in bins, with the least and the
largest value of each bin, and goes on with the bin that holds the wanted rank.
Bins are equal in the values' logarithm first, then, within a factor of four,
in the values. They are counted before the shuffle, so a task holds at most
``BINS`` numbers a range, whatever the number of distinct values; three or four
rounds are usual.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096


def _number(column: str) -> Column:
    """The column as a finite double; NaN and infinite values count as missing."""
    value = F.col(column).cast("double")
    return F.when(F.abs(value) <= 1.7976931348623157e308, value)


def exact_quantile(frame: DataFrame, columns: list[str], q: float = 0.5, bins: int = BINS) -> dict[str, float | None]:
    """The exact ``q`` quantile of each column, between two values by their mean weighted by rank; None without values.

    All columns share the passes. Every range that is still open gives at most
    ``bins`` rows of (bin, count, least, largest) to the driver.
    """
    aggregates = [f(_number(c)).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("n", F.count), ("a", F.min), ("b", F.max))]
    first = frame.agg(*aggregates).first()
    found: dict[tuple[int, int], float] = {}
    # (column, rank) -> the range that holds it, and the number of values below the range
    wanted: dict[tuple[int, int], tuple[float, float, int]] = {}
    places = {}
    for i in range(len(columns)):
        if first[f"n{i}"]:
            places[i] = (first[f"n{i}"] - 1) * q
            for rank in {math.floor(places[i]), math.ceil(places[i])}:
                wanted[i, rank] = (first[f"a{i}"], first[f"b{i}"], 0)
    while wanted:
        for key in [k for k, (low, high, _) in wanted.items() if low == high]:
            found[key] = wanted.pop(key)[0]
        ranges = sorted({(i, low, high) for (i, _), (low, high, _) in wanted.items()})
        if not ranges:
            break
        counted: dict[int, list] = {}
        for row in _histograms(frame, columns, ranges, bins).collect():  # at most bins rows a range
            counted.setdefault(row["range"], []).append((row["bin"], row["n"], row["low"], row["high"]))
        for (i, rank), (low, high, below) in wanted.items():
            for _, n, least, largest in sorted(counted[ranges.index((i, low, high))]):
                if rank < below + n:
                    wanted[i, rank] = (least, largest, below)
                    break
                below += n
    answers: dict[str, float | None] = dict.fromkeys(columns)
    for i, place in places.items():
        low, high, share = found[i, math.floor(place)], found[i, math.ceil(place)], place - math.floor(place)
        answers[columns[i]] = low * (1 - share) + high * share
    return answers


def _magnitude(x: Column) -> Column:
    """Grows with x, by the logarithm of its size, so that wide ranges narrow as fast as others."""
    return F.when(x == 0, 0.0).otherwise(F.signum(x) * (F.log2(F.abs(x)) + 1080))


def _histograms(frame: DataFrame, columns: list[str], ranges: list[tuple[int, float, float]], bins: int) -> DataFrame:
    """(range, bin, n, low, high) of the values within each range; bins are in the order of the values."""

    def slot(at: int, i: int, low: float, high: float) -> Column:
        value = _number(columns[i])
        x, a, b = value, F.lit(low), F.lit(high)
        if not 0 < low <= high <= 4 * low and not 0 > high >= low >= 4 * high:
            x, a, b = _magnitude(x), _magnitude(a), _magnitude(b)
        place = F.floor((x - a) / (b - a) * bins)
        inside = (value >= low) & (value <= high)
        return F.when(inside, F.struct(F.lit(at).alias("range"), F.least(place, F.lit(bins - 1)).cast("int").alias("bin"), value.alias("value")))

    slots = F.filter(F.array(*(slot(at, *r) for at, r in enumerate(ranges))), lambda s: s.isNotNull())
    values = frame.select(F.inline(slots))
    return values.groupBy("range", "bin").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
