"""Ranking metrics over item arrays, without Python workers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_column(items: str | Column) -> Column:
    return F.col(items) if isinstance(items, str) else items


def _guard(recommended: Column, actual: Column, metric: Column) -> Column:
    usable = (F.coalesce(F.size(recommended), F.lit(0)) > 0) & (F.coalesce(F.size(actual), F.lit(0)) > 0)
    return F.when(usable, metric).otherwise(F.lit(0.0))


def hits(recommended: Column, actual: Column) -> Column:
    return F.size(F.array_intersect(recommended, actual))


def precision_at_k(recommended: str | Column, actual: str | Column) -> Column:
    """Hits over the number of recommended items."""
    recommended, actual = _as_column(recommended), _as_column(actual)
    return _guard(recommended, actual, hits(recommended, actual) / F.size(recommended))


def recall_at_k(recommended: str | Column, actual: str | Column) -> Column:
    """Hits over the number of actual items."""
    recommended, actual = _as_column(recommended), _as_column(actual)
    return _guard(recommended, actual, hits(recommended, actual) / F.size(actual))


def rank_gain(rank: Column) -> Column:
    """Discounted gain of a hit at a 1-based rank."""
    return F.lit(1.0) / F.log2(rank.cast("double") + 1)


def ideal_gain(n: Column) -> Column:
    """Best reachable discounted gain with ``n`` relevant items on top."""
    return F.when(
        n > 0,
        F.aggregate(F.sequence(F.lit(1), n), F.lit(0.0), lambda total, rank: total + rank_gain(rank)),
    ).otherwise(F.lit(0.0))


def ndcg_at_k(recommended: str | Column, actual: str | Column) -> Column:
    """Normalised discounted cumulative gain with binary relevance."""
    recommended, actual = _as_column(recommended), _as_column(actual)
    gains = F.transform(
        recommended,
        lambda item, i: F.when(F.array_contains(actual, item), rank_gain(i + 1)).otherwise(F.lit(0.0)),
    )
    reached = F.aggregate(gains, F.lit(0.0), lambda total, gain: total + gain)
    best = ideal_gain(F.least(F.size(F.array_distinct(actual)), F.size(recommended)))
    return _guard(recommended, actual, reached / best)
