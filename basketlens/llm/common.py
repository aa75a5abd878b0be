"""What several operators share: vectorised words, hashes, held-out rows, components.

Text functions work on UTF-8 buffers of Arrow columns with numpy, a bounded
piece at a time; no Python object is made per word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketlens.session import forget, materialise

#: Bytes of text that are hashed at once.
PIECE = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_LANES = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD1342543DE82EF95))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from every fit: crc32 of the id's text divisible by five; a null id counts as not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, label 0/1) of the ids that may teach a model; repeated labels of an id are averaged and halves go to 1."""
    return (
        labels.select("doc_id", F.col(column).cast("double").alias("y"))
        .where("doc_id IS NOT NULL AND y IS NOT NULL")
        .where(~held_out())
        .groupBy("doc_id")
        .agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    )


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, as long as asked for."""

    def __init__(self, base: int = _BASE):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            for name, b in (("up", self.base), ("down", self.inverse)):
                steps = np.full(n, b, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def spans(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Scrambled polynomial hashes of values[start:end]; the same content gives the same hash anywhere."""
        if not len(starts):
            return np.zeros(0, np.uint64)
        self.upto(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=sums[1:])
        lengths = (ends - starts).astype(np.uint64)
        return mix((sums[ends] - sums[starts]) * self.down[starts] + mix(lengths))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offset of each row (one more than rows); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, wide)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that each slice has about ``limit`` bytes of text, one row at least."""
    _, offsets = buffers(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
    pa.default_memory_pool().release_unused()


class Words:
    """The words (runs of bytes other than blank, tab to carriage return) of a column of texts.

    ``starts``/``ends`` are byte positions in ``data``; ``first`` has the number of
    the first word of each row, and the number of words at its end.
    """

    BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])

    def __init__(self, column: pa.Array):
        self.data, self.offsets = buffers(column)
        n = len(self.data)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = ~self.BLANK[self.data]
        begin = inside[1:] & ~inside[:-1]
        stop = inside[:-1] & ~inside[1:]
        cuts = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        cuts = cuts[inside[cuts] & inside[cuts + 1]]  # a row ends and the next begins inside a run
        begin[cuts] = stop[cuts] = True
        self.starts, self.ends = np.flatnonzero(begin[:n]) if n else np.zeros(0, np.int64), np.flatnonzero(stop)
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, lane: int = 0) -> np.ndarray:
        """64 bits a word, piece by piece: a sum of scrambled (byte, place in the word), scrambled again.

        Lanes are independent names of the same words.
        """
        out = np.empty(len(self), np.uint64)
        at = 0
        while at < len(self):
            to = max(at + 1, int(np.searchsorted(self.starts, self.starts[at] + PIECE)))
            low, high = self.starts[at], self.ends[to - 1]
            starts, ends = self.starts[at:to] - low, self.ends[at:to] - low
            place = np.arange(high - low) - np.repeat(starts, np.diff(np.append(starts, high - low)))
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(mix((place.astype(np.uint64) << np.uint64(8)) + self.data[low:high] + _LANES[lane]), out=sums[1:])
            out[at:to] = mix(sums[ends] - sums[starts] + mix((ends - starts).astype(np.uint64) ^ _LANES[lane]))
            at = to
        return out

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def bytes_of(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()


def window_hashes(hashes: np.ndarray, width: int, powers: Powers) -> np.ndarray:
    """A hash for each run of ``width`` entries, by first entry; empty if there are fewer."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    at = np.arange(n)
    return powers.spans(hashes, at, at + width)


def appended(docs: DataFrame, extra: str, make, limit: int = PIECE) -> DataFrame:
    """``docs`` with all its columns and those of ``extra`` (a schema), which ``make()(slice)`` yields as a list of arrays.

    One pass, no exchange: what a filter needs besides the rows travels with them.
    Columns of operators begin with ``__llm_``, which is reserved; any other name may occur in ``docs``.
    """
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(extra).fields])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = make()
        for batch in batches:
            for piece in slices(batch, "text", limit):
                yield pa.record_batch([*piece.columns, *measure(piece)], names=names)

    return docs.mapInArrow(run, schema)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Weighted logistic regression by damped Newton steps; the first coefficient is the intercept and not penalised."""
    x = np.column_stack([np.ones(len(x)), x]).astype(float)
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge * max(weight.sum(), 1.0))
    penalty[0] = 1e-9

    def loss(b):
        z = x @ b
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * (penalty * b * b).sum())

    now = loss(beta)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        gradient = x.T @ (weight * (p - y)) + penalty * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step, scale = np.linalg.solve(hessian, gradient), 1.0
        while scale > 1e-6 and (after := loss(beta - scale * step)) > now:
            scale /= 2
        if scale <= 1e-6 or abs(now - after) < 1e-10 * max(1.0, abs(now)):
            break
        beta, now = beta - scale * step, after
    return beta


def sigmoid(margin: Column) -> Column:
    """Overflow-safe logistic function of a column."""
    z = F.greatest(F.least(margin, F.lit(700.0)), F.lit(-700.0))
    return 1 / (1 + F.exp(-z))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of every end of ``edges`` (a, b): the smallest id that can be reached.

    Large-star and small-star rounds: each round groups by node, and at least
    halves the depth of the trees; a hub's neighbours are reduced by a minimum
    before they meet, never gathered. An edge gives one edge in either star, so
    rounds don't grow; only the first, which may hang many edges on one root,
    looks for equal ones. Every round is written to the shared folder. Ends when
    a round changes no edge.
    """
    pairs = materialise(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    seen = None
    for _ in range(rounds):
        # Large star: neighbours above a node are hung on the smallest of the node and its neighbours.
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: a node and its smaller neighbours are hung on the smallest of those; the edge to that one hangs the node.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = F.when(F.col("b") > F.col("m"), F.col("b")).otherwise(F.col("a"))
        after = large.join(low, "a").select(hung.alias("a"), F.col("m").alias("b"))
        after = materialise(after.distinct() if seen is None else after, "links")
        state = after.agg(*(F.sum(F.xxhash64(*names).cast("decimal(38,0)")) for names in (("a", "b"), ("b", "a")))).first()
        forget(pairs)
        pairs = after
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return pairs.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("id"), "component").unionByName(
        pairs.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )


def rounded_up(amount: float, per: float) -> int:
    return max(1, math.ceil(amount / per))
