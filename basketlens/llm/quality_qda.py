"""Quality by regularised quadratic discriminants on transformed document statistics.

Each class gets a mean and a covariance, pulled towards the pooled covariance
and a multiple of the identity by shrinkage. A document's score is the
difference of the classes' log densities, from Mahalanobis distances by
Cholesky factors that are computed once, calibrated on labelled rows kept apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from basketlens.llm import textstats
from basketlens.llm.common import Powers, Words, appended, held_out, labelled, sigmoid
from basketlens.llm.quality_rules import calibrate, calibrating
from basketlens.session import materialise

#: Share of the pooled covariance, and of the identity, in a class covariance.
POOLED, ROUND = 0.2, 0.05
THRESHOLD = 0.3
FEATURES = 16


def statistics(words: Words, powers: Powers, kinds: np.ndarray) -> np.ndarray:
    """(rows, FEATURES) transformed statistics: logs of sizes, logits of shares smoothed by one; finite for empty texts too."""
    hashes = words.hashes()
    n = np.diff(words.first).astype(float)
    size = np.diff(words.offsets).astype(float)
    counts = textstats.class_counts(words, kinds).astype(float)
    lines, again = textstats.line_counts(words)
    pairs = [
        *((counts[:, k], size) for k in range(len(textstats.CLASSES))),
        (again.astype(float), lines.astype(float)),
        (textstats.repeated(words, hashes, powers).astype(float), n),
        (textstats.distinct(words, hashes).astype(float), n),
    ]
    shares = [np.log((part + 1) / np.maximum(whole - part + 1, 1)) for part, whole in pairs]
    marks = counts[:, textstats.CLASSES.index("symbol")] + counts[:, textstats.CLASSES.index("mark")]
    return np.column_stack(
        [
            *shares,
            np.log1p(n),
            np.log((size + 1) / (n + 1)),
            np.log((n + 1) / (lines + 1)),
            np.log((marks + 1) / (n + 1)),
        ]
    )


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with __llm_x, the statistics of each row."""

    def make():
        powers, kinds = Powers(), textstats.class_table()

        def run(piece: pa.RecordBatch) -> list[pa.Array]:
            x = statistics(Words(piece.column("text")), powers, kinds)
            offsets = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
            return [pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))]

        return run

    return appended(docs, "__llm_x array<double>", make)


def moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sums and sums of products of ``_x`` for each class ``y``, added up by task and then over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            y = batch.column("y").to_numpy()
            x = batch.column("__llm_x").flatten().to_numpy().reshape(len(y), -1)
            x = np.column_stack([np.ones(len(x)), x])
            for label in np.unique(y):
                part = x[y == label]
                sums[int(label)] = sums.get(int(label), 0) + part.T @ part
        for label, total in sums.items():
            flat = total.ravel()
            yield pa.record_batch(
                [pa.array(np.full(len(flat), label, np.int32)), pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)],
                names=["y", "i", "v"],
            )

    added = rows.select("y", "__llm_x").mapInArrow(run, "y int, i int, v double").groupBy("y", "i").agg(F.sum("v").alias("v")).collect()
    out = {}
    for label in {r.y for r in added}:
        own = {r.i: r.v for r in added if r.y == label}
        d = int(round(len(own) ** 0.5))
        m = np.array([own[i] for i in range(d * d)]).reshape(d, d)
        out[label] = (m[0, 0], m[0, 1:], m[1:, 1:])
    return out


class Discriminant:
    """Means and inverse Cholesky factors of the two classes, on standardised features."""

    def __init__(self, sums: dict[int, tuple[float, np.ndarray, np.ndarray]], pooled: float = POOLED, round_: float = ROUND):
        n = sum(s[0] for s in sums.values())
        mean = sum(s[1] for s in sums.values()) / n
        scatter = sum(s[2] for s in sums.values()) / n - np.outer(mean, mean)
        self.mean, self.scale = mean, 1 / np.sqrt(np.maximum(np.diag(scatter), 1e-6))
        centres, spreads = {}, {}
        for label, (count, first, second) in sums.items():
            centre = first / count
            spread = second / count - np.outer(centre, centre)
            centres[label] = (centre - mean) * self.scale
            spreads[label] = (spread * self.scale).T * self.scale
        joint = sum(spreads[k] * sums[k][0] for k in spreads) / n
        self.parts = {}
        for label, spread in spreads.items():
            # The fewer rows a class has, the more of the pooled covariance it takes.
            few = len(mean) / (sums[label][0] + len(mean))
            share = min(1.0, pooled + (1 - pooled) * few)
            mixed = (1 - share) * spread + share * joint
            mixed = (1 - round_) * mixed + round_ * max(np.trace(mixed) / len(mean), 1e-3) * np.eye(len(mean))
            factor = np.linalg.cholesky(mixed)
            inverse = np.linalg.solve(factor, np.eye(len(mean)))
            self.parts[label] = (centres[label], inverse, -np.log(np.diag(factor)).sum())

    def difference(self, x: np.ndarray) -> np.ndarray:
        """log density of class 1 less that of class 0, softened beyond 50 to its logarithm."""
        z = (x - self.mean) * self.scale
        logs = {}
        for label, (centre, inverse, constant) in self.parts.items():
            d = (z - centre) @ inverse.T
            logs[label] = constant - 0.5 * (d * d).sum(1)
        diff = logs[1] - logs[0]
        return np.sign(diff) * np.where(np.abs(diff) > 50, 50 + np.log1p(np.maximum(np.abs(diff) - 50, 0)), np.abs(diff))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and others) with ``_score``; the texts are read once.

    All labelled rows that are not held out are used: three quarters of the ids for
    the densities, the rest for the calibration. With labels of one class only, the
    score is 1 or 0 for all; without labels it is 1. Null text counts as empty;
    equal texts get equal scores.
    """
    measured = materialise(measure(docs), "quality-statistics")
    teach = labelled(docs, labels, "quality")
    small = measured.select(F.col("doc_id").cast("long").alias("doc_id"), "__llm_x")
    known = small.join(teach, "doc_id")
    sums = moments(known.where(~calibrating()))
    model = Discriminant(sums) if len(sums) == 2 else None

    def differences(column: pa.Array) -> np.ndarray:
        n = len(column)
        return model.difference(column.flatten().to_numpy().reshape(n, -1)) if n and model is not None else np.zeros(n)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column("y"), pa.array(differences(batch.column("__llm_x")))], names=["y", "m"])

    bins = (
        known.where(calibrating() if model is not None else F.lit(True))
        .select("y", "__llm_x")
        .mapInArrow(margins, "y int, m double")
        .groupBy(F.round(F.col("m") * 10).alias("m"), "y")  # differences are softened, so there are some thousand steps
        .count()
        .collect()
    )
    a, b = calibrate(bins, 10.0)
    schema = StructType([*docs.schema.fields, StructField("__llm_margin", DoubleType())])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([*batch.columns[:-1], pa.array(differences(batch.column("__llm_x")))], names=names)

    return measured.mapInArrow(run, schema).withColumn("__llm_score", sigmoid(F.lit(a) + F.lit(b) * F.col("__llm_margin"))).drop("__llm_margin")


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``; see ``scored``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return scored(docs, labels).select(
        "doc_id", held_out().alias("held_out"), F.col("__llm_score").alias("score"), (F.col("__llm_score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, as they are."""
    return scored(docs, labels).where(F.col("__llm_score") >= threshold).drop("__llm_score")
