"""Item embeddings from sessions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.operators.metrics import rows
from basketlens.operators.neighbours import nearest_items
from basketlens.operators.sessions import MAX_ITEMS

SEED = 42


@dataclass(frozen=True)
class Item2VecSize:
    vector: int = 128
    min_count: int = 5
    window: int = 5
    max_iter: int = 10
    partitions: int = 8


# Fixed presets: the full model and the quick one.
FULL = Item2VecSize()
QUICK = Item2VecSize(vector=32, max_iter=5, partitions=1)


def train(sequences: DataFrame, size: Item2VecSize = FULL) -> Word2VecModel:
    """Word2Vec over item sequences; a session's pieces are its sentences."""
    word2vec = Word2Vec(
        vectorSize=size.vector,
        minCount=size.min_count,
        windowSize=size.window,
        maxIter=size.max_iter,
        numPartitions=size.partitions,
        maxSentenceLength=MAX_ITEMS,
        inputCol="items",
        outputCol="session_vector",
        seed=SEED,
    )
    return word2vec.fit(sequences.select("items"))


def vectors(model: Word2VecModel) -> DataFrame:
    """(item, vector) with plain arrays."""
    return model.getVectors().select(F.col("word").alias("item"), vector_to_array("vector").alias("vector"))


def similar_items(model: Word2VecModel, requests: DataFrame | None = None, k: int = 10) -> DataFrame:
    """Nearest items of the requested ones, of all when none are named."""
    table = vectors(model)
    return nearest_items(table, table if requests is None else requests, k)


def evaluate(neighbours: DataFrame, vocabulary: DataFrame, sequences: DataFrame, pairs: DataFrame) -> DataFrame:
    """Hit rate of held-out last items, and vocabulary coverage.

    ``pairs`` holds (query_item, target_item, sessions). Sessions whose query
    item has no vector are not evaluated.
    """
    known = vocabulary.select(F.col("item").alias("query_item"))
    judged = pairs.join(known, "query_item", "left_semi")
    offered = neighbours.select(
        F.col("item").alias("query_item"), F.col("neighbour").alias("target_item"), F.lit(1).alias("_hit")
    )
    scored = judged.join(offered, ["query_item", "target_item"], "left").agg(
        F.coalesce(F.sum("sessions"), F.lit(0)).alias("sessions_evaluated"),
        F.coalesce(F.sum(F.when(F.col("_hit") == 1, F.col("sessions"))), F.lit(0)).alias("hits"),
    )
    vocab = vocabulary.agg(rows()).scalar()
    items = sequences.select(F.explode("items").alias("item")).agg(F.count_distinct("item")).scalar()
    return scored.select(
        "sessions_evaluated",
        "hits",
        F.when(F.col("sessions_evaluated") > 0, F.round(F.col("hits") / F.col("sessions_evaluated"), 4))
        .otherwise(F.lit(0.0))
        .alias("hit_rate"),
        vocab.alias("vocab_size"),
        F.round(vocab / items, 4).alias("coverage"),
    )
