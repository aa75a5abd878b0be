"""Implicit feedback: the user-item matrix and what is derived from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.measures import weight
from basketlens.functions.ranking import ideal_gain, rank_gain
from basketlens.operators.metrics import rows

# Ids per item block; distinct ids make it the longest possible item list.
ITEM_BLOCK = 10_000


def interaction_matrix(events: DataFrame, default: int = 0) -> DataFrame:
    """Summed weights and interaction counts per (user, product)."""
    known = events.dropna(subset=["user_id", "product_id"])
    return known.groupBy("user_id", "product_id").agg(
        F.sum(weight(default)).alias("rating"), rows().alias("interaction_count")
    )


def matrix_stats(matrix: DataFrame) -> DataFrame:
    """Size and sparsity of the matrix."""
    totals = matrix.agg(
        rows().alias("interactions"),
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("product_id").alias("items"),
    )
    cells = F.col("users").cast("double") * F.col("items")
    return totals.withColumn("sparsity", F.when(cells > 0, 1 - F.col("interactions") / cells))


def popularity(matrix: DataFrame) -> DataFrame:
    """Products by total weight; a matrix row is one user, so rows count users."""
    totals = matrix.groupBy("product_id").agg(F.sum("rating").alias("total_rating"), rows().alias("user_count"))
    return totals.orderBy(F.desc("total_rating"), "product_id")


def popular_items(matrix: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most popular products with their rank."""
    top = popularity(matrix).limit(k).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("total_rating")).alias("order"), "product_id"))).alias("_top")
    )
    ranked = top.select(F.posexplode("_top").alias("rank", "item"))
    return ranked.select((F.col("rank") + 1).alias("rank"), F.col("item.product_id").alias("product_id"))


def unseen_popular(matrix: DataFrame, k: int = 10, pool: int = 100) -> DataFrame:
    """(user_id, product_id, rank): of the ``pool`` most popular products the first ``k`` a user has no rating of."""
    ranked = popular_items(matrix, pool).agg(F.array_sort(F.collect_list(F.struct("rank", "product_id"))))
    users = matrix.select("user_id").distinct()
    offered = users.select("user_id", F.explode(ranked.scalar()).alias("_o")).select("user_id", "_o.product_id", F.col("_o.rank").alias("_place"))
    fresh = offered.join(matrix.select("user_id", "product_id"), ["user_id", "product_id"], "left_anti")
    order = Window.partitionBy("user_id").orderBy("_place")
    return fresh.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("_place")


def user_item_lists(matrix: DataFrame, block: int = ITEM_BLOCK) -> DataFrame:
    """Sorted items of each user, one row per block of the id range.

    A user may have touched the whole catalogue; blocks keep every list
    within ``block`` ids while the rows of a user together hold them all.
    """
    blocked = matrix.groupBy("user_id", F.floor(F.col("product_id") / block).alias("item_block"))
    return blocked.agg(F.array_sort(F.collect_list("product_id")).alias("items"), rows().alias("num_items"))


def dense_ids(frame: DataFrame, column: str, name: str, blocks: int = 1024) -> DataFrame:
    """A distinct int for every value of a column, close to ``0..n-1``.

    Values are numbered inside hash blocks and interleaved, which needs no
    global order; the largest id is about ``n`` as the blocks are even.
    """
    block = F.pmod(F.xxhash64(column), F.lit(blocks))
    numbered = Window.partitionBy("_block").orderBy(column)
    values = frame.select(column).distinct().withColumn("_block", block)
    rank = F.row_number().over(numbered).cast("long") - 1
    return values.select(column, (rank * blocks + F.col("_block")).cast("int").alias(name))


def ranking_metrics(recommended: DataFrame, truth: DataFrame, user: str, item: str) -> DataFrame:
    """Mean precision, recall and NDCG over users with both recommendations and truth.

    ``recommended`` holds (user, item, rank), ``truth`` distinct (user, item).
    Everything is joined and summed as rows, so a user with a very long
    history is never gathered into one array.
    """
    wanted = truth.select(user, item).withColumn("_hit", F.lit(1))
    judged = recommended.join(wanted, [user, item], "left")
    per_user = judged.groupBy(user).agg(
        rows().cast("int").alias("n_rec"),
        F.count("_hit").cast("int").alias("hits"),
        F.coalesce(F.sum(F.when(F.col("_hit") == 1, rank_gain(F.col("rank")))), F.lit(0.0)).alias("gain"),
    )
    actual = truth.groupBy(user).agg(rows().cast("int").alias("n_actual"))
    best = ideal_gain(F.least("n_rec", "n_actual"))
    scored = per_user.join(actual, user).select(
        (F.col("hits") / F.col("n_rec")).alias("precision"),
        (F.col("hits") / F.col("n_actual")).alias("recall"),
        (F.col("gain") / best).alias("ndcg"),
    )
    return scored.agg(
        rows().alias("users_evaluated"),
        *[F.round(F.avg(name), 4).alias(name) for name in ("precision", "recall", "ndcg")],
    )


def popularity_metrics(train: DataFrame, truth: DataFrame, k: int = 10) -> DataFrame:
    """Precision and recall when everyone is shown the ``k`` most popular items."""
    top = popular_items(train, k).select("product_id").withColumn("_hit", F.lit(1))
    # k rows by construction: broadcast keeps the truth, however skewed, where it is.
    judged = truth.select("user_id", "product_id").join(F.broadcast(top), "product_id", "left")
    per_user = judged.groupBy("user_id").agg(rows().alias("n_actual"), F.count("_hit").alias("hits"))
    precision = F.avg(F.col("hits") / F.lit(float(k)))
    recall = F.avg(F.col("hits") / F.col("n_actual"))
    return per_user.agg(
        rows().alias("users_evaluated"),
        F.round(precision, 4).alias("precision"),
        F.round(recall, 4).alias("recall"),
    )
