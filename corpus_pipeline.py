"""Cleaning and packing of a corpus, stage by stage.

Each stage is one operator of ``basketlens.llm`` on all that the stage before
kept; its result is written to the shared folder and read again.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketlens.llm import minhash, packing, quality_qda, substring_dedup, toxicity  # noqa: E402
from basketlens.llm.common import table  # noqa: E402
from basketlens.llm.queries import vocabulary  # noqa: E402
from basketlens.session import delete_folders, forget, materialise, recorded  # noqa: E402

#: Folders that the last stage called has left for its result.
_LEFT: list[str] = []


def freeing(stage):
    """A stage that first deletes what the one before left, whose result is written by then, as ``docs`` is that result.

    Hence one pipeline at a time in a process. A folder that ``docs`` reads stays.
    """

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _LEFT:
            read = docs.inputFiles()
            delete_folders(spark, [p for p in _LEFT if not any(p.split("://")[-1] in f for f in read)])
            _LEFT.clear()
        with recorded() as paths:
            made = stage(spark, docs, sf_dir)
        _LEFT.extend(paths)
        return made

    run.__name__, run.__doc__ = stage.__name__, stage.__doc__
    return run


@freeing
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays under 0.5."""
    return toxicity.keep_ordinary(docs, table(spark, sf_dir, "labels"))


@freeing
def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality reaches 0.3."""
    return quality_qda.keep_good(docs, table(spark, sf_dir, "labels"))


@freeing
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.keep_one(docs)


@freeing
def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 35 words or more that stand more than once."""
    return substring_dedup.clean(docs)


@freeing
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of 4096 tokens."""
    return packing.pack(packing.pieces(docs, vocabulary("word_bpe_49k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", drop_repeats),
    ("packing", pack),
]

#: Trained models and tokenizers are not SQL; tests compare each stage with a plain version on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's result is deleted when the next one's is written."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "corpus-" + name.replace(" ", "-"))
        forget(*before)
        before = [docs]
    return docs
