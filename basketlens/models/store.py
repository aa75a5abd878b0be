"""Saving and loading of fitted models and their summary."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import Word2VecModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = {"click": PipelineModel, "als": ALSModel, "item2vec": Word2VecModel, "kmeans": KMeansModel}


def save(model, path: str) -> None:
    model.write().overwrite().save(path)


def load(kind: str, path: str):
    return KINDS[kind].load(path)


def summary(spark: SparkSession, metrics: dict[str, float]) -> DataFrame:
    """One row with all metrics, ready for ``write_summary``."""
    return spark.range(1).select(*[F.lit(value).alias(name) for name, value in metrics.items()])
