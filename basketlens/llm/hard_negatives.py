"""Hard negatives of anchors, found by angular triangle filtering.

Every row stores its norm and its angles to a few reference directions. The
angle between two rows is at least the difference and at most the sum of their
angles to a reference, which gives an interval of cosines; times both norms it
bounds their score. Only rows whose interval overlaps a window that is still
open are scored, in integers.

Anchors meet rows on a grid: blocks of anchors by strips of rows. A task holds
the anchors of its cell with their best finds and reads the strip in slices, so
it gives at most ``NEGATIVES`` rows a window, however many rows tie.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from basketlens.llm.vectors import EXACT, integers, longest, packed, products, unpacked, usable
from basketlens.session import materialise

SCALE, POSITIVES, NEGATIVES = 256, 5, 10
#: A negative's score, in hundredths of the positive's.
LOW, HIGH = 30, 90
#: Largest integer component: a hundred times a score of 2**12 components fits a long.
LARGEST = 1 << 22
#: Reference directions, and rows they are chosen from.
REFERENCES, SAMPLE = 8, 1024
#: Anchors of a grid cell, fewest rows of a strip, pairs looked at at once.
BLOCK, STRIP, PAIRS = 4096, 4096, 1 << 20
#: Slack of angles and, relative to both norms, of bounds; arc cosines near 1 are good to some 2e-8.
ANGLE_SLACK, BOUND_SLACK = 1e-6, 1e-9
#: A score below all scores, for places that are still free.
NONE = -(1 << 62)
#: Below this share of pairs that pass the filter they are scored one by one, else as a block.
SPARSE = 0.05

GRID = "block int, strip int, anchor boolean, row long, vec_id long, label int, norm double, q binary, angles binary, windows binary"


def directions(rows: DataFrame, width: int) -> np.ndarray:
    """Unit vectors far from each other, chosen from the ``SAMPLE`` rows of smallest hash."""
    some = rows.orderBy(F.xxhash64("row"), "row").select("q").limit(SAMPLE).collect()
    v = np.array([np.frombuffer(r[0], np.int32) for r in some], float).reshape(-1, width)
    norms = np.linalg.norm(v, axis=1)
    v = v[norms > 0] / norms[norms > 0, None]
    chosen: list[int] = []
    nearest = np.full(len(v), -2.0)
    while len(chosen) < min(REFERENCES, len(v)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, v @ v[chosen[-1]])
    return v[chosen] if chosen else np.eye(1, width)


def _measured(rows: DataFrame, references: np.ndarray) -> DataFrame:
    """``rows`` with their norms and angles to the references; a zero vector has angles 0 and, by its norm, scores 0."""
    width = references.shape[1]
    schema = StructType([*rows.schema.fields, *StructType.fromDDL("norm double").fields, StructField("angles", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = unpacked(batch.column("q"), np.int32, width).astype(float)
            norm = np.linalg.norm(q, axis=1)
            cosine = (q @ references.T) / np.where(norm > 0, norm, 1)[:, None]
            angles = np.where(norm[:, None] > 0, np.arccos(np.clip(cosine, -1, 1)), 0.0)
            yield pa.record_batch([*batch.columns, pa.array(norm), packed(angles)], names=schema.fieldNames())

    return rows.mapInArrow(run, schema)


def bounds(norm_a: np.ndarray, angles_a: np.ndarray, norm_b: np.ndarray, angles_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of all pairs of two sets of rows, rounded outwards."""
    least = np.zeros((len(norm_a), len(norm_b)))
    most = np.full((len(norm_a), len(norm_b)), np.pi)
    for r in range(angles_a.shape[1]):
        a, b = angles_a[:, r, None], angles_b[None, :, r]
        np.maximum(least, np.abs(a - b), out=least)
        both = a + b
        np.minimum(most, np.minimum(both, 2 * np.pi - both), out=most)
    norms = norm_a[:, None] * norm_b[None]
    slack = BOUND_SLACK * norms + BOUND_SLACK
    low = norms * np.cos(np.minimum(most + ANGLE_SLACK, np.pi)) - slack
    high = norms * np.cos(np.maximum(least - ANGLE_SLACK, 0)) + slack
    return low, high


class Finds:
    """The best rows so far of each window: at most ``size``, highest score first, ties in the order they came."""

    def __init__(self, windows: int, size: int):
        self.size = size
        self.score = np.full((windows, size), NONE)
        self.vec_id = np.zeros((windows, size), np.int64)
        self.row = np.full((windows, size), -1)

    @property
    def bar(self) -> np.ndarray:
        """A later row must score more than this to enter its window."""
        return self.score[:, -1]

    def add(self, window: np.ndarray, score: np.ndarray, vec_id: np.ndarray, row: np.ndarray) -> None:
        """Rows that came after all before, ordered by window and coming."""
        if not len(window):
            return
        hit = np.unique(window)
        w = np.concatenate([np.repeat(hit, self.size), window])
        s = np.concatenate([self.score[hit].ravel(), score])
        v = np.concatenate([self.vec_id[hit].ravel(), vec_id])
        r = np.concatenate([self.row[hit].ravel(), row])
        order = np.lexsort((-s, w))  # stable: those that came first stay first
        w = w[order]
        place = np.arange(len(w)) - np.searchsorted(w, w)
        top = place < self.size
        order, w, place = order[top], w[top], place[top]
        self.score[w, place], self.vec_id[w, place], self.row[w, place] = s[order], v[order], r[order]

    def table(self, anchors: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
        w, k = np.nonzero(self.row >= 0)
        return pa.record_batch(
            [pa.array(x) for x in (anchors[w], places[w].astype(np.int32), self.score[w, k], self.vec_id[w, k], self.row[w, k])],
            names=["anchor", "place", "score", "vec_id", "row"],
        )


FINDS = "anchor long, place int, score long, vec_id long, row long"


def _scores(a: np.ndarray, b: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Integer scores of the pairs marked in ``wanted``, in its order."""
    i, j = np.nonzero(wanted)
    if len(i) > SPARSE * wanted.size:
        return products(a, b)[i, j]
    kind = float if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] < EXACT else np.int64
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), PAIRS // 64):
        some = slice(at, at + PAIRS // 64)
        out[some] = np.einsum("ij,ij->i", a[i[some]].astype(kind), b[j[some]].astype(kind))
    return out


def _cells(width: int, references: int, same: bool) -> Callable:
    """Streams the cells of a grid: the anchors of a cell come first, its rows after them by id.

    With ``same``, the best rows of the anchor's label are found; else the best
    ones of other labels within each of the anchor's windows.
    """
    size = POSITIVES if same else NEGATIVES

    class Cell:
        def __init__(self, batches: list[pa.RecordBatch]):
            names = ("row", "label", "norm")
            self.row, self.label, self.norm = (np.concatenate([b.column(n).to_numpy() for b in batches]) for n in names)
            self.q = np.concatenate([unpacked(b.column("q"), np.int32, width) for b in batches])
            self.angles = np.concatenate([unpacked(b.column("angles"), np.float64, references) for b in batches])
            n = len(self.row)
            if same:
                self.low, self.high = np.full((n, 1), NONE), np.full((n, 1), -NONE)
            else:
                spans = np.concatenate([unpacked(b.column("windows"), np.int64, 2 * POSITIVES) for b in batches])
                self.low, self.high = spans[:, ::2], spans[:, 1::2]
            self.finds = Finds(self.low.size, size)

        def meet(self, batch: pa.RecordBatch) -> None:
            step = max(1, PAIRS // len(self.row))
            for at in range(0, batch.num_rows, step):
                self._meet(batch.slice(at, step))

        def _meet(self, batch: pa.RecordBatch) -> None:
            row, vec_id, label, norm = (batch.column(n).to_numpy() for n in ("row", "vec_id", "label", "norm"))
            q, angles = unpacked(batch.column("q"), np.int32, width), unpacked(batch.column("angles"), np.float64, references)
            bar = self.finds.bar.reshape(self.low.shape)
            # A row must lie in one of the anchor's windows and pass its bar.
            need = np.where(self.low <= self.high, np.maximum(self.low, bar + 1), -NONE)
            least, most = need.min(1).astype(float), self.high.max(1).astype(float)
            low, high = bounds(self.norm, self.angles, norm, angles)
            wanted = (high >= least[:, None]) & (low <= most[:, None]) & (self.row[:, None] != row[None])
            wanted &= (self.label[:, None] == label[None]) == same
            if not wanted.any():
                return
            i, j = np.nonzero(wanted)
            score = _scores(self.q, q, wanted)
            spans = self.low.shape[1]
            for w in range(spans):
                fits = (score >= need[i, w]) & (score <= self.high[i, w])
                a, b = i[fits], j[fits]
                self.finds.add(a * spans + w, score[fits], vec_id[b], row[b])

        def table(self) -> pa.RecordBatch:
            spans = self.low.shape[1]
            return self.finds.table(np.repeat(self.row, spans), np.tile(np.arange(spans), len(self.row)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, waiting, cell = None, [], None
        for batch in batches:
            keys = np.stack([batch.column("block").to_numpy(), batch.column("strip").to_numpy(), batch.column("anchor").to_numpy(zero_copy_only=False)], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                if start == end:
                    continue
                here, part = tuple(keys[start, :2]), batch.slice(start, end - start)
                if here != key:
                    if cell is not None:
                        yield cell.table()
                    key, waiting, cell = here, [], None
                if keys[start, 2]:
                    waiting.append(part)
                elif waiting or cell is not None:
                    if cell is None:
                        cell, waiting = Cell(waiting), []
                    cell.meet(part)
        if cell is not None:
            yield cell.table()

    return run


def _on_grid(rows: DataFrame, anchors: DataFrame, blocks: int, strips: int, width: int, references: int, same: bool) -> DataFrame:
    """What the cells find: every anchor stands once in each strip, every row once in each block of anchors."""
    number = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    strip = F.pmod(F.xxhash64(F.lit(7), "row"), F.lit(strips)).cast("int")
    names = ["row", "vec_id", "label", "norm", "q", "angles"]
    windows = F.lit(None).cast("binary") if same else F.col("windows")
    left = anchors.select(number.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("strip"), F.lit(True).alias("anchor"), *names, windows.alias("windows"))
    right = rows.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), strip.alias("strip"), F.lit(False).alias("anchor"), *names, F.lit(None).cast("binary").alias("windows"))
    dealt = left.unionByName(right).repartition(2 * blocks * strips, "block", "strip")
    ordered = dealt.sortWithinPartitions("block", "strip", F.desc("anchor"), "vec_id", "row")
    return ordered.mapInArrow(_cells(width, references, same), FINDS)


def _best(finds: DataFrame, size: int) -> DataFrame:
    """The first ``size`` finds of each window over all strips, numbered from 1."""
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id", "row")
    return finds.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def mine(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Rows with a null id, label or vector, or with null or non-finite components,
    take no part, nor do components over 2**22 / 256 in size (scores could pass
    a long). Shorter vectors count as filled up with zeros. Every row stands for
    itself: a repeated row is another row, and a repeated anchor has its results
    twice. Ties of score and id are between rows that look alike in the result.
    A window without a row gives none, an empty table no rows; negative positive
    scores have empty windows. Other columns are not looked at.
    """
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("int")
    kept = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), relabelled.alias("label"), F.col(vector).cast("array<double>").alias("v")
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("v", (LARGEST - 1) / SCALE))
    width = max(1, longest(kept, "v"))
    # Row numbers are only fixed once they are written.
    numbered = materialise(integers(kept, "v", SCALE, width).select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "q"), "mining-rows")
    references = directions(numbered, width)
    rows = materialise(_measured(numbered, references), "mining-angles")
    anchors = rows.where(F.col("vec_id") % 100 == 0)
    total, queries = rows.agg(F.count("*"), F.count_if(F.col("vec_id") % 100 == 0)).first()
    # Strips grow with the root of the rows, so that finds of all strips stay far fewer than pairs.
    strips = max(1, math.ceil(total / max(STRIP, 32 * math.isqrt(total))))
    blocks = max(1, math.ceil(queries / BLOCK))

    grid = (blocks, strips, width, len(references))
    positives = materialise(
        _best(_on_grid(rows, anchors, *grid, same=True), POSITIVES).select("anchor", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
        "mining-positives",
    )
    open_windows = positives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("found"))
    spans = anchors.join(open_windows.withColumnRenamed("anchor", "row"), "row")
    windowed = spans.mapInArrow(_windows, StructType([*anchors.schema.fields, StructField("windows", BinaryType())]))
    negatives = _best(_on_grid(rows, windowed, *grid, same=False), NEGATIVES).select(
        "anchor", (F.col("place") + 1).alias("place"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    ids = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return negatives.join(positives.join(ids, "anchor"), ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least and largest score of each of an anchor's windows, of a positive it lacks an empty one."""
    for batch in batches:
        spans = np.zeros((batch.num_rows, 2 * POSITIVES), np.int64)
        spans[:, ::2] = 1
        for i, found in enumerate(batch.column("found").to_pylist()):
            for w, one in enumerate(found):
                score = one["positive_score"]
                spans[i, 2 * w : 2 * w + 2] = -(-LOW * score // 100), HIGH * score // 100
        columns = [c for n, c in zip(batch.schema.names, batch.columns) if n != "found"]
        yield pa.record_batch([*columns, packed(spans)], names=[n for n in batch.schema.names if n != "found"] + ["windows"])


#: The same by all scores of the anchors, over tables whose ids and vectors are distinct and of one length.
SQL = f"""
WITH k AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM k a JOIN k b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {POSITIVES}),
n AS (
  SELECT p.*, other AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}
"""
