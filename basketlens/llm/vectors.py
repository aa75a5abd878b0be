"""Integer vectors: what the operators on embeddings with integer scores share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

#: Sums of products of integers below this are exact in double precision.
EXACT = 1 << 53


def usable(vector: str, largest: float) -> Column:
    """Vectors that are not null and hold numbers within ``largest`` only; NaN counts above any number."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x) <= largest, F.lit(False)))


def integer_rows(column: pa.Array, scale: float, width: int) -> np.ndarray:
    """floor(scale * x) of a column of lists of numbers, a row a vector, zeros behind shorter ones."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    lengths = np.diff(offsets)
    out = np.zeros((len(column), width), np.int64)
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], lengths)] = np.floor(scale * values.astype(float))
    return out


def packed(matrix: np.ndarray) -> pa.Array:
    """A binary value a row, fixed width, little-endian."""
    n, width = matrix.shape
    data = np.ascontiguousarray(matrix).tobytes()
    offsets = (np.arange(n + 1) * width * matrix.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def unpacked(column: pa.Array, kind, width: int) -> np.ndarray:
    """The matrix that ``packed`` made."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, width), kind)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view(kind).reshape(len(column), width)


def integers(rows: DataFrame, vector: str, scale: float, width: int) -> DataFrame:
    """``rows`` with ``vector`` replaced by the binary column ``q`` of its 32-bit integers."""
    names = [c for c in rows.columns if c != vector]
    schema = StructType([*(rows.schema[c] for c in names), StructField("q", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = packed(integer_rows(batch.column(vector), scale, width).astype(np.int32))
            yield pa.record_batch([*(batch.column(c) for c in names), q], names=[*names, "q"])

    return rows.mapInArrow(run, schema)


def longest(rows: DataFrame, vector: str) -> int:
    """Components of the longest vector, 0 if there are none."""
    return rows.agg(F.max(F.size(vector))).first()[0] or 0


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of two integer matrices, exact: in double precision where no sum can be rounded."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T
