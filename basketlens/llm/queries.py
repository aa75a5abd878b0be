"""The operators' registered queries over the given tables, and their SQL twins."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketlens.llm import (
    byte_bpe,
    chat_format,
    embedding_dedup,
    hard_negatives,
    license_scan,
    minhash,
    packing,
    quality_qda,
    quality_rules,
    sharding,
    substring_dedup,
    toxicity,
    vector_codes,
)
from basketlens.llm.common import table


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; BASKETLENS_TOKENIZERS names another folder than the installed one."""
    folder = os.environ.get("BASKETLENS_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated quality of every document by shrunk quadratic discriminants."""
    return quality_qda.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without its repeated 35-word windows."""
    return substring_dedup.digest(substring_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated toxicity of every document by compression distance."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the hashed n-gram verdict of every document."""
    return quality_rules.rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by global distinct pre-tokens, decoded again, as digests."""
    from public_tokenizers import PATTERN

    path = vocabulary("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.encode(docs, path, PATTERN, scan=True, follow=(byte_bpe.digests(path), byte_bpe.DIGEST))


def op6_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard; shards hold 64 MiB at most."""
    return sharding.shards(table(spark, sf_dir, "documents"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at a cosine of 0.93 or more."""
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document: five-word shingles, similarity 0.8 or more."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    return license_scan.digest(license_scan.scan(table(spark, sf_dir, "documents")))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their place in sequences of 4096 tokens."""
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json")))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-byte code of every vector, by codebooks that all vectors refine."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of each hundredth vector, by its five positives."""
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's examples, read back from their texts as digests."""
    turns = chat_format.with_tricky(table(spark, sf_dir, "conversations"))
    return chat_format.digest(chat_format.conversation_texts(turns))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_qda": op1_quality_qda,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_toxicity": op3_toxicity,
        "op4_quality_rules": op4_quality_rules,
        "op5_byte_bpe": op5_byte_bpe,
        "op6_extendible_sharding": op6_extendible_sharding,
        "op7_embedding_dedup": op7_embedding_dedup,
        "op8_minhash_dedup": op8_minhash_dedup,
        "op9_license_scan": op9_license_scan,
        "op10_best_fit_packing": op10_best_fit_packing,
        "op11_vector_codes": op11_vector_codes,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_chat_format": op13_chat_format,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_extendible_sharding": sharding.SHARDS_SQL.format(limit=sharding.LIMIT),
        "op11_vector_codes": vector_codes.SQL,
        "op12_hard_negatives": hard_negatives.SQL,
        "op13_chat_format": chat_format.SQL,
    }
