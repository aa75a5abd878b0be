"""Customer segments with k-means."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.constants import PROFILE_FEATURES, SEGMENT_FEATURES
from basketlens.operators.lookup import segment_label
from basketlens.operators.metrics import rows
from basketlens.session import materialise

SEED = 42

# Inputs of the earlier generation's four-cluster model.
EARLIER_FEATURES = ["total_events", "views", "cart_adds", "purchases", "total_spend"]


def scaled(frame: DataFrame, features: list[str], with_mean: bool = True) -> DataFrame:
    """Frame with the standardised feature vector; missing features count as 0."""
    typed = frame.withColumns({name: F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name in features})
    stages = [
        VectorAssembler(inputCols=features, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withStd=True, withMean=with_mean),
    ]
    return Pipeline(stages=stages).fit(typed).transform(typed).drop("raw_features")


def cluster(vectors: DataFrame, k: int = 5, max_iter: int = 100):
    """Fitted k-means model on scaled vectors."""
    return KMeans(k=k, seed=SEED, featuresCol="features", predictionCol="cluster", maxIter=max_iter).fit(vectors)


def segment_profiles(profiles: DataFrame, k: int = 5, max_iter: int = 10) -> DataFrame:
    """Cluster of every profile (reader names)."""
    vectors = materialise(scaled(profiles.select("user_id", *PROFILE_FEATURES), PROFILE_FEATURES), "profile-vectors")
    return cluster(vectors, k, max_iter).transform(vectors).drop("features")


def earlier_model(profiles: DataFrame, k: int = 4) -> tuple[PipelineModel, float]:
    """The earlier generation's model and its silhouette."""
    vectors = materialise(scaled(profiles.select("user_id", *EARLIER_FEATURES), EARLIER_FEATURES, False), "vectors")
    model = cluster(vectors, k, 20)
    return model, _silhouette(model.transform(vectors))


def _silhouette(clustered: DataFrame) -> float:
    return ClusteringEvaluator(predictionCol="cluster", featuresCol="features", metricName="silhouette").evaluate(clustered)


def search_k(features: DataFrame, ks: tuple[int, ...] = (3, 4, 5, 6, 7, 8), max_iter: int = 100) -> tuple[DataFrame, int]:
    """Silhouette and inertia per k, and the k with the best silhouette.

    The vectors are written once and read by every fit.
    """
    vectors = materialise(scaled(features, SEGMENT_FEATURES).select("user_id", "features"), "segment-vectors")
    tried = []
    for k in ks:
        model = cluster(vectors, k, max_iter)
        tried.append((k, round(_silhouette(model.transform(vectors)), 4), round(model.summary.trainingCost, 2)))
    best = max(tried, key=lambda row: row[1])[0]
    table = features.sparkSession.createDataFrame(tried, "k int, silhouette double, inertia double")
    return table.withColumn("best", F.col("k") == best), best


def assign_segments(features: DataFrame, k: int = 5, max_iter: int = 100) -> DataFrame:
    """Feature rows with their cluster."""
    vectors = materialise(scaled(features, SEGMENT_FEATURES), "segment-vectors")
    return cluster(vectors, k, max_iter).transform(vectors).drop("features")


def segment_counts(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("cluster").agg(rows().alias("users")).orderBy("cluster")


def segment_distribution(clustered: DataFrame) -> DataFrame:
    """Size, share, label and feature means of every cluster, in one aggregate."""
    total = clustered.agg(rows()).scalar()
    means = [F.avg(name).alias(f"mean_{name}") for name in SEGMENT_FEATURES]
    grouped = clustered.groupBy("cluster").agg(
        rows().alias("users"), F.round(F.avg("total_spend"), 2).alias("avg_spend"), *means
    )
    return grouped.select(
        "cluster",
        segment_label("cluster").alias("label"),
        "users",
        F.round(F.col("users") * F.lit(100.0) / total, 1).alias("share_pct"),
        "avg_spend",
        F.round("mean_total_purchases", 2).alias("avg_purchases"),
        F.round("mean_cart_abandonment_rate", 4).alias("avg_cart_abandon"),
        F.round("mean_category_diversity", 1).alias("avg_cat_diversity"),
        *[f"mean_{name}" for name in SEGMENT_FEATURES],
    ).orderBy("cluster")
