"""Quality rules on counts, and a hashed n-gram logistic regression for what passes them.

One pass over the texts yields the counts and the regression's margin; the
margin is turned into a probability that was calibrated on labelled rows the
fit has not seen, and compared with a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm import textstats
from basketlens.llm.common import Powers, Words, fit_logistic, labelled, mix, sigmoid, slices
from basketlens.session import materialise

#: Hash buckets, a power of two.
BITS = 16
#: Lengths of byte n-grams.
CHARS = (3, 4)
#: Labelled rows of each class that the regression is fitted on: those with the smallest hash of their id.
FIT_ROWS = 1000
THRESHOLD = 0.5

COUNTS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, margin double"


def buckets(words: Words, hashes: np.ndarray, bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket of each n-gram, offset of each row) for words, word pairs, and byte n-grams of each length.

    Every kind has a region of its own among the 2**bits buckets.
    """
    kinds = 2 + len(CHARS)
    room = (1 << bits) // kinds
    out = []
    n_rows = len(words.offsets) - 1
    rows = words.rows()

    def add(values: np.ndarray, offsets: np.ndarray) -> None:
        out.append(((values % np.uint64(room)).astype(np.int32) + len(out) * room, offsets))

    add(hashes >> np.uint64(20), words.first)
    pairs = np.flatnonzero(rows[1:] == rows[:-1])
    add(
        mix(hashes[pairs] * np.uint64(3) + hashes[pairs + 1]) >> np.uint64(20),
        np.concatenate([[0], np.cumsum(np.bincount(rows[pairs], minlength=n_rows))]),
    )
    data = words.data.astype(np.uint32)
    lengths = np.diff(words.offsets)
    for n in CHARS:
        value = np.zeros(max(0, len(data) - n + 1), np.uint32)
        for k in range(n):
            value = value * np.uint32(0x01000193) + data[k : k + len(value)] + np.uint32(1)
        value = (value * np.uint32(0x9E3779B1)) >> np.uint32(8)
        here = np.maximum(lengths - n + 1, 0)
        offsets = np.concatenate([[0], np.cumsum(here)])
        if len(value) and (lengths < len(data)).any():
            inside = np.zeros(len(data) + 1, np.int32)
            np.add.at(inside, words.offsets[:-1][here > 0], 1)
            np.subtract.at(inside, (words.offsets[:-1] + here)[here > 0], 1)
            value = value[np.cumsum(inside[: len(value)]) > 0]
        add(value.astype(np.uint64), offsets)
    return out


def _margins(parts: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray) -> np.ndarray:
    """Sum over kinds of the mean weight of a row's n-grams; a kind without n-grams adds nothing."""
    total = np.zeros(len(parts[0][1]) - 1)
    for bucket, offsets in parts:
        total += textstats.per_row(weights[bucket], offsets) / np.maximum(np.diff(offsets), 1)
    return total


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(y, text) -> (y, buckets, values) of training rows."""
    for batch in batches:
        for piece in slices(batch, "text"):
            words = Words(piece.column("text"))
            parts = buckets(words, words.hashes())
            n = piece.num_rows
            keys, values = [], []
            for row in range(n):
                k, v = [], []
                for bucket, offsets in parts:
                    own, counts = np.unique(bucket[offsets[row] : offsets[row + 1]], return_counts=True)
                    k.append(own)
                    v.append(counts / max(1, counts.sum()))
                keys.append(np.concatenate(k).astype(np.int32).tobytes())
                values.append(np.concatenate(v).astype(np.float32).tobytes())
            yield pa.record_batch(
                [piece.column("y"), pa.array(keys, pa.binary()), pa.array(values, pa.binary())], names=["y", "keys", "values"]
            )


def _fit(rows: list, bits: int = BITS, ridge: float = 1e-5, steps: int = 150) -> np.ndarray:
    """Class-balanced logistic regression by accelerated gradient steps on scaled features."""
    if not rows or len({r.y for r in rows}) < 2:
        return np.zeros(1 << bits)
    keys = [np.frombuffer(r["keys"], np.int32) for r in rows]
    values = np.concatenate([np.frombuffer(r["values"], np.float32) for r in rows]).astype(float)
    row = np.repeat(np.arange(len(rows)), [len(k) for k in keys])
    key = np.concatenate(keys)
    y = np.array([r.y for r in rows], float)
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    # Scaling: rare buckets move as easily as frequent ones, up to a floor.
    scale = 1 / np.sqrt(np.bincount(key, values * values * share[row], 1 << bits) + 1e-6)
    values = values * scale[key]
    power = float(np.bincount(row, values * values).max())
    beta, back, t = np.zeros(1 << bits), np.zeros(1 << bits), 1.0
    rate = 4.0 / power
    for _ in range(steps):
        z = np.bincount(row, values * back[key], len(rows))
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        after = back - rate * (np.bincount(key, values * (share * (p - y))[row], 1 << bits) + ridge * back)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        beta, back, t = after, after + (t - 1) / t2 * (after - beta), t2
    return beta * scale


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> np.ndarray:
    """Weights from labelled rows that are neither held out nor kept for calibration."""
    teach = labelled(docs, labels, "quality").where(~calibrating())
    chosen = None
    for label in (0, 1):
        some = teach.where(F.col("y") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
        chosen = some if chosen is None else chosen.unionByName(some)
    rows = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .join(F.broadcast(chosen), "doc_id")  # 2 * fit_rows ids at most
        .select("y", "text")
        .mapInArrow(_features, "y int, keys binary, values binary")
        .collect()
    )
    return _fit(rows)


def calibrating():
    """A quarter of the ids, for calibration alone."""
    return F.pmod(F.xxhash64(F.col("doc_id")), F.lit(4)) == 0


def measure(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """COUNTS of every row; null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        table = shared.value.astype(np.float64)
        for batch in batches:
            for piece in slices(batch, "text"):
                words = Words(piece.column("text"))
                hashes = words.hashes()
                _, again = textstats.line_counts(words)
                yield pa.record_batch(
                    [
                        piece.column("doc_id"),
                        pa.array(np.diff(words.first)),
                        pa.array(textstats.word_chars(words)),
                        pa.array(textstats.symbols(words)),
                        pa.array(again),
                        pa.array(textstats.repeated(words, hashes, powers)),
                        pa.array(_margins(buckets(words, hashes), table)),
                    ],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "margin"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, COUNTS)


def base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rules(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score) of every row.

    ``score`` is the calibrated probability of label 1; without labels of both
    classes it is the share of label 1, and 1 without any label. Equal rows get
    equal results, empty and null texts fail the base rules.
    """
    measured = materialise(measure(docs, train(docs, labels, fit_rows)), "quality-margins")
    teach = labelled(docs, labels, "quality").where(calibrating())
    # At most 1,001 steps of the margin.
    bins = (
        measured.join(teach, "doc_id")
        .groupBy(F.greatest(F.lit(-500), F.least(F.lit(500), F.round(F.col("margin") * 20))).alias("m"), "y")
        .count()
        .collect()
    )
    a, b = calibrate(bins)
    return measured.withColumn("score", sigmoid(F.lit(a) + F.lit(b) * F.col("margin"))).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & (F.col("score") >= threshold)).alias("kept"),
        "score",
    )


def calibrate(bins: list, step: float = 20.0) -> tuple[float, float]:
    """Intercept and slope from (m, y, count) rows, slope not below zero."""
    if not bins:
        return 700.0, 0.0
    x = np.array([[r.m / step] for r in bins], float)
    y, w = np.array([r.y for r in bins], float), np.array([r["count"] for r in bins], float)
    share = float((w * y).sum() / w.sum())
    if share in (0.0, 1.0):
        return (700.0 if share else -700.0), 0.0
    a, b = fit_logistic(x, y, w, ridge=1e-6)
    return (float(a), float(b)) if b > 0 else (float(np.log(share / (1 - share))), 0.0)
