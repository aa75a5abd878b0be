"""Implicit-feedback recommendations with ALS."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.operators.clean import hash_split
from basketlens.operators.interactions import dense_ids, popularity_metrics, ranking_metrics
from basketlens.operators.metrics import rows
from basketlens.operators.neighbours import all_pairs, ranked
from basketlens.session import materialise

SEED = 42
#: Shares of the items, longest factors first, that are met before users are settled.
SHARES = (1 / 32, 1 / 16, 1 / 4)


@dataclass(frozen=True)
class AlsSize:
    rank: int = 64
    max_iter: int = 15
    reg: float = 0.1
    alpha: float = 1.0
    nonnegative: bool = True
    blocks: int = 10


# Fixed presets: the full model, the quick one and the earlier generation's.
FULL = AlsSize()
QUICK = AlsSize(rank=10, max_iter=5, nonnegative=False)
EARLIER = AlsSize(rank=20, max_iter=10, nonnegative=False)


@dataclass
class Ratings:
    """Ratings under dense ids, and the id tables to map results back."""

    rows: DataFrame
    users: DataFrame
    items: DataFrame


def index_ratings(matrix: DataFrame) -> Ratings:
    """Replace wide ids by distinct ints, as ALS wants them.

    The id tables are written once; ratings, training and mapping back all
    read the same numbers.
    """
    users = materialise(dense_ids(matrix, "user_id", "user_idx"), "user-ids")
    items = materialise(dense_ids(matrix, "product_id", "item_idx"), "item-ids")
    indexed = matrix.join(users, "user_id").join(items, "product_id")
    kept = indexed.select("user_id", "product_id", "user_idx", "item_idx", F.col("rating").cast("float").alias("rating"))
    return Ratings(materialise(kept, "ratings"), users, items)


def train(ratings: DataFrame, size: AlsSize = FULL) -> ALSModel:
    als = ALS(
        userCol="user_idx",
        itemCol="item_idx",
        ratingCol="rating",
        implicitPrefs=True,
        coldStartStrategy="drop",
        rank=size.rank,
        maxIter=size.max_iter,
        regParam=size.reg,
        alpha=size.alpha,
        nonnegative=size.nonnegative,
        numUserBlocks=size.blocks,
        numItemBlocks=size.blocks,
        seed=SEED,
    )
    return als.fit(ratings)


def best_items(users: DataFrame, items: DataFrame, k: int, shares: tuple[float, ...] = SHARES) -> DataFrame:
    """The ``k`` items with the largest products with each user's factors: (user_idx, rank, item_idx, score), exactly.

    Both tables hold (id, features). Items are met in strips of falling length;
    a product is at most both lengths multiplied, so a user whose ``k``-th score
    is above that for all items to come is settled and leaves the rounds.
    """

    def prepared(factors: DataFrame, number, name: str) -> DataFrame:
        unit = F.transform("features", lambda x: x.cast("double"))
        length = F.sqrt(F.aggregate("unit", F.lit(0.0), lambda total, x: total + x * x))
        return materialise(factors.select(number.alias("item"), unit.alias("unit")).withColumn("length", length), name)

    # Ids of users are turned below 0, as no item is left out for having its user's number.
    left, offered = prepared(users, -1 - F.col("id"), "user-factors"), prepared(items, F.col("id"), "item-factors")
    cuts = offered.agg(F.percentile_approx("length", [1 - share for share in shares])).first()[0] or []
    lists, above = None, float("inf")
    for cut in [*sorted(set(cuts), reverse=True), -1.0]:
        strip = offered.filter((F.col("length") >= cut) & (F.col("length") < above)).select("item", "unit")
        found = all_pairs(strip, left.select("item", "unit"), k).drop("rank")
        lists = materialise(ranked(found if lists is None else found.unionByName(lists.drop("rank")), k), "best-items")
        least = lists.groupBy("item").agg(rows().alias("n"), F.min("similarity").alias("least"))
        reach = F.col("length") * F.lit(cut * (1 + 1e-9)) + F.lit(1e-11)  # scores are rounded
        left = left.join(least, "item", "left").filter((F.coalesce("n", F.lit(0)) < k) | (reach >= F.col("least"))).select("item", "unit", "length")
        left, above = materialise(left, "open-users"), cut
        if left.isEmpty():
            break
    score = F.col("similarity").cast("float").cast("double").alias("score")
    return lists.select((-1 - F.col("item")).alias("user_idx"), "rank", F.col("neighbour").alias("item_idx"), score)


def recommend(model: ALSModel, ratings: Ratings, k: int = 10, requests: DataFrame | None = None) -> DataFrame:
    """Top ``k`` products of all or of the requested users: (user_id, rank, product_id, score)."""
    users = model.userFactors
    if requests is not None:
        known = requests.select("user_id").distinct().join(ratings.users, "user_id").select(F.col("user_idx").alias("id"))
        users = users.join(known, "id")
    flat = best_items(users, model.itemFactors, k)
    named = flat.join(ratings.users, "user_idx").join(ratings.items, "item_idx")
    return named.select("user_id", "rank", "product_id", "score")


def rating_error(model: ALSModel, test: DataFrame) -> DataFrame:
    """Root mean squared error on held-out ratings, and 1 / (1 + error)."""
    scored = model.transform(test)
    error = RegressionEvaluator(labelCol="rating", predictionCol="prediction", metricName="rmse").evaluate(scored)
    table = [(float(error), max(0.0, 1.0 / (1.0 + error)))]
    return test.sparkSession.createDataFrame(table, "rmse double, precision_proxy double")


def split(ratings: DataFrame, test: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Repeatable split of (user, product) pairs."""
    return hash_split(ratings, test, "user_id", "product_id")


def temporal_split(events: DataFrame, test: float = 0.2, slot_seconds: int = 3600) -> tuple[DataFrame, DataFrame]:
    """Each user's earliest events train, the last share of them tests."""
    from basketlens.operators.sessions import keyed_positions

    placed = keyed_positions(events, "user_id", slot_seconds)
    sizes = placed.groupBy("user_id").agg(rows().alias("_n"))
    marked = placed.join(sizes, "user_id")
    early = F.col("position") <= F.ceil(F.col("_n") * F.lit(1 - test))
    drop = ("_n", "position")
    return marked.filter(early).drop(*drop), marked.filter(~early).drop(*drop)


def evaluate(recommended: DataFrame, train_rows: DataFrame, truth: DataFrame, k: int = 10) -> DataFrame:
    """ALS against popularity: (model, users, precision, recall, ndcg) and the lift in percent."""
    als = ranking_metrics(recommended, truth, "user_id", "product_id").select(
        F.lit("als").alias("model"), "users_evaluated", "precision", "recall", "ndcg"
    )
    base = popularity_metrics(train_rows, truth, k).select(
        F.lit("popularity").alias("model"),
        "users_evaluated",
        "precision",
        "recall",
        F.lit(None).cast("double").alias("ndcg"),
    )
    both = als.unionByName(base)

    def lift(name: str):
        plain = base.select(name).scalar()
        return F.when(plain > 0, F.round((F.col(name) / plain - 1) * 100, 1))

    return both.withColumns({"precision_lift_pct": lift("precision"), "recall_lift_pct": lift("recall")})
