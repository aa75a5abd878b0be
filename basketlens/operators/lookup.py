"""Serving answers as joins of a request table with prepared tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.constants import SEGMENTS
from basketlens.functions.rules import DEMO_THRESHOLD, demo_click_probability
from basketlens.operators.metrics import top_trending

MAX_K = 50


def _check_k(k: int) -> int:
    if not 1 <= k <= MAX_K:
        raise ValueError(f"k must be within 1..{MAX_K}")
    return k


def trending_answer(trending: DataFrame, k: int = 10, category: str | None = None) -> DataFrame:
    """Top trending products, of one category when given."""
    return top_trending(trending, _check_k(k), category)


def recommend_answer(requests: DataFrame, recommendations: DataFrame, popular: DataFrame, k: int = 10) -> DataFrame:
    """Recommendations per requested user; unknown users get the popular items.

    ``recommendations`` holds (user_id, rank, product_id, score), ``popular``
    (rank, product_id) of at most ``MAX_K`` rows, which is attached to the
    unknown users as one array value.
    """
    _check_k(k)
    offer = F.struct(
        F.col("rank").cast("int").alias("rank"), "product_id", F.lit(None).cast("double").alias("score")
    )
    fallback = popular.filter(F.col("rank") <= k).agg(F.array_sort(F.collect_list(offer))).scalar()
    wanted = requests.select("user_id").distinct()
    best = recommendations.filter(F.col("rank") <= k)
    joined = wanted.join(best, "user_id", "left")
    own = F.array(
        F.struct(F.col("rank").cast("int").alias("rank"), "product_id", F.col("score").cast("double").alias("score"))
    )
    known = F.col("product_id").isNotNull()
    answers = joined.select(
        "user_id",
        F.when(known, "als").otherwise("popularity").alias("model"),
        F.inline(F.when(known, own).otherwise(fallback)),
    )
    return answers.select("user_id", "rank", "product_id", "score", "model")


def segment_label(cluster: str | Column) -> Column:
    cluster = F.col(cluster) if isinstance(cluster, str) else cluster
    return F.coalesce(_lookup(cluster, 0), F.concat(F.lit("Segment "), cluster.cast("string")))


def segment_description(cluster: str | Column) -> Column:
    return _lookup(F.col(cluster) if isinstance(cluster, str) else cluster, 1)


def segment_action(cluster: str | Column) -> Column:
    return _lookup(F.col(cluster) if isinstance(cluster, str) else cluster, 2)


def _lookup(cluster: Column, part: int) -> Column:
    pairs = [F.lit(value) for key, row in SEGMENTS.items() for value in (key, row[part])]
    return F.try_element_at(F.create_map(*pairs), cluster.cast("int"))


def segment_answer(requests: DataFrame, assignments: DataFrame) -> DataFrame:
    """Segment of each requested user; unknown users are spread by their id."""
    wanted = requests.select("user_id").distinct()
    joined = wanted.join(assignments.select("user_id", "cluster"), "user_id", "left")
    fallback = F.pmod(F.col("user_id"), F.lit(len(SEGMENTS))).cast("int")
    placed = joined.select("user_id", F.coalesce("cluster", fallback).alias("segment_id"))
    return placed.select(
        "user_id",
        "segment_id",
        segment_label("segment_id").alias("segment_label"),
        segment_description("segment_id").alias("description"),
        segment_action("segment_id").alias("recommended_action"),
    )


def demo_score_answer(requests: DataFrame) -> DataFrame:
    """Demo click score of request rows."""
    scored = requests.withColumn("click_probability", demo_click_probability())
    return scored.withColumn("prediction", (F.col("click_probability") >= DEMO_THRESHOLD).cast("int"))


def model_score_answer(model, requests: DataFrame) -> DataFrame:
    """Click probability of request rows under a fitted model."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(requests)
    return scored.select(
        *requests.columns,
        F.round(vector_to_array("probability")[1], 4).alias("click_probability"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def similar_answer(requests: DataFrame, neighbours: DataFrame, k: int = 10) -> DataFrame:
    """Similar items of each requested item from a neighbour table."""
    wanted = requests.select("item").distinct()
    best = neighbours.filter(F.col("rank") <= _check_k(k))
    return best.join(wanted, "item", "left_semi").select(
        "item", "rank", "neighbour", F.round("similarity", 4).alias("similarity")
    )
