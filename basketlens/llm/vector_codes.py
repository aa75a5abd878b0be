"""Compression of vectors to four-byte codes, with nearest entries found in a GNAT.

Vectors become integers and are cut into four parts; each part position has a
codebook of at most 256 entries, refined in four rounds of exact integer
k-means. A codebook is searched through a geometric near-neighbour access tree:
every node has split points, an entry belongs to its nearest split point, and
for every pair of split point and child the tree stores the least and the
largest distance between the two. A request whose distance to a split point
lies outside such a range by more than its best distance so far can't have its
nearest entry in that child, so the whole subtree is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from basketlens.llm.vectors import EXACT, integers, longest, unpacked, usable
from basketlens.session import materialise

PARTS, ENTRIES, SCALE, ROUNDS = 4, 256, 1024, 4
#: Largest integer component; beyond it squared distances would not fit a long.
LARGEST = 1 << 27
#: Split points of a node, and entries that need no node of their own.
ARITY = LEAF = 16
#: Vectors that are searched at once.
SLICE = 1 << 13
#: Relative slack of distances in double precision; square roots and sums are exact to some 1e-15.
SLACK = 1e-12
#: Rows of one label are joined with its sum in so many groups.
SALTS = 32


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of two integer matrices."""
    reach = float(np.abs(a).max(initial=0)) + float(np.abs(b).max(initial=0))
    if reach * reach * a.shape[1] < EXACT:
        a, b = a.astype(float), b.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None]).astype(np.int64)
    out = np.empty((len(a), len(b)), np.int64)
    for j in range(len(b)):
        step = a.astype(np.int64) - b[j].astype(np.int64)
        out[:, j] = (step * step).sum(1)
    return out


class Gnat:
    """A GNAT over the rows of an integer matrix; ``members`` are their numbers in the codebook."""

    def __init__(self, entries: np.ndarray, members: np.ndarray | None = None):
        self.members = np.arange(len(entries)) if members is None else members
        self.children: list[Gnat | None] = []
        if len(entries) <= LEAF:
            self.splits, self.points = self.members, entries
            return
        chosen = self._spread(entries)
        self.splits, self.points = self.members[chosen], entries[chosen]
        d2 = squares(entries, self.points)
        home = d2.argmin(1)
        home[chosen] = np.arange(len(chosen))
        d = np.sqrt(d2.astype(float))
        self.low = np.empty((len(chosen), len(chosen)))
        self.high = np.empty_like(self.low)
        rest = np.ones(len(entries), bool)
        rest[chosen] = False
        for j in range(len(chosen)):
            mine = rest & (home == j)
            self.low[:, j], self.high[:, j] = (d[mine].min(0), d[mine].max(0)) if mine.any() else (np.inf, -np.inf)
            self.children.append(Gnat(entries[mine], self.members[mine]) if mine.any() else None)

    @staticmethod
    def _spread(entries: np.ndarray) -> np.ndarray:
        """Split points far from each other: each the entry farthest from those before, the first one from the mean."""
        middle = np.floor(entries.mean(0)).astype(np.int64)[None]
        chosen = [int(squares(entries, middle)[:, 0].argmax())]
        least = squares(entries, entries[chosen])[:, 0]
        while len(chosen) < ARITY:
            free = least.copy()
            free[chosen] = -1
            chosen.append(int(free.argmax()))
            least = np.minimum(least, squares(entries, entries[chosen[-1:]])[:, 0])
        return np.array(chosen)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of the nearest entry of each row, ties to the lower number; distances computed."""
        number = np.full(len(parts), np.iinfo(np.int64).max)
        best = np.full(len(parts), np.iinfo(np.int64).max)
        return number, best, self._search(parts, np.arange(len(parts)), number, best)

    def _search(self, parts: np.ndarray, rows: np.ndarray, number: np.ndarray, best: np.ndarray) -> int:
        d2 = squares(parts[rows], self.points)
        for i, entry in enumerate(self.splits):
            better = (d2[:, i] < best[rows]) | ((d2[:, i] == best[rows]) & (entry < number[rows]))
            best[rows[better]], number[rows[better]] = d2[better, i], entry
        work = d2.size
        if not self.children:
            return work
        d, home = np.sqrt(d2.astype(float)), d2.argmin(1)
        for at_home in (True, False):  # the likeliest child first, so that the others meet a small best distance
            for j, child in enumerate(self.children):
                if child is None:
                    continue
                some = np.flatnonzero((home == j) == at_home)
                reach = np.sqrt(best[rows[some]].astype(float))[:, None]
                slack = SLACK * (d[some] + reach + self.high[:, j])
                over = d[some] - reach > self.high[:, j] + slack
                under = d[some] + reach < self.low[:, j] - slack
                some = some[~(over | under).any(1)]
                if len(some):
                    work += child._search(parts, rows[some], number, best)
        return work


def search(books: list[np.ndarray], q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry numbers and squared distances by vector and part."""
    return _search([Gnat(b) for b in books], q)


def _search(trees: list[Gnat], q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = q.shape[1] // PARTS
    numbers = np.empty((len(q), PARTS), np.int64)
    errors = np.empty((len(q), PARTS), np.int64)
    for at in range(0, len(q), SLICE):
        some = slice(at, at + SLICE)
        for p, tree in enumerate(trees):
            part = q[some, p * width : (p + 1) * width].astype(np.int64)
            numbers[some, p], errors[some, p], _ = tree.nearest(part)
    return numbers, errors


def _refined(rows: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Every entry replaced by the floored mean of the parts nearest to it.

    A task adds up its own parts and gives a row an entry in use; Spark adds
    those, and PARTS x ENTRIES rows of sums reach the driver.
    """
    width = books[0].shape[1]
    names = [f"s{c}" for c in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        sums = np.zeros((PARTS, ENTRIES, width + 1), np.int64)
        for batch in batches:
            q = unpacked(batch.column("q"), np.int32, PARTS * width)
            for at in range(0, len(q), SLICE):
                some = q[at : at + SLICE]
                numbers, _ = _search(trees, some)
                for p in range(PARTS):
                    sums[p, :, width] += np.bincount(numbers[:, p], minlength=ENTRIES)
                    for c in range(width):  # 2 ** 13 integers of 27 bits: exact in double precision
                        sums[p, :, c] += np.bincount(numbers[:, p], some[:, p * width + c], ENTRIES).astype(np.int64)
        p, e = np.nonzero(sums[:, :, width])
        found = sums[p, e]
        columns = [pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(found[:, width])]
        yield pa.record_batch([*columns, *(pa.array(found[:, c]) for c in range(width))], names=["p", "e", "n", *names])

    partial = rows.select("q").mapInArrow(run, "p int, e int, n long, " + ", ".join(f"{c} long" for c in names))
    total = partial.groupBy("p", "e").agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", *names)))
    after = [b.copy() for b in books]
    for row in total.collect():  # PARTS x ENTRIES rows at most
        after[row["p"]][row["e"]] = [int(row[c]) // int(row["n"]) for c in names]
    return after


def fit(rows: DataFrame, width: int) -> list[np.ndarray]:
    """The four codebooks after all rounds; the first ones are the vectors of the 256 smallest ids."""
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "q").select("q").limit(ENTRIES).collect()
    start = np.array([np.frombuffer(r[0], np.int32) for r in first], np.int64).reshape(len(first), PARTS * width)
    books = [start[:, p * width : (p + 1) * width] for p in range(PARTS)]
    for _ in range(ROUNDS if len(start) else 0):
        books = _refined(rows, books)
    return books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()


def _coded(rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    width = books[0].shape[1]
    schema = StructType([rows.schema["vec_id"], rows.schema["label"], StructField("code", StringType()), StructField("error", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        for batch in batches:
            numbers, errors = _search(trees, unpacked(batch.column("q"), np.int32, PARTS * width))
            codes = [bytes(n).hex() for n in numbers.astype(np.uint8)]
            yield pa.record_batch(
                [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors.sum(1))],
                names=schema.fieldNames(),
            )

    return rows.select("vec_id", "label", "q").mapInArrow(run, schema)


def compress(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector that can be coded.

    Left out are vectors that are null, hold null or non-finite components, or
    components over 2**27 / 1024 in size, whose squared distances could pass a
    long. Shorter vectors, and lengths not divisible by four, count as filled
    up with zeros; an empty vector is all zeros. Repeated rows are coded each;
    rows of one id compete for the first codebook by their integers; a null id
    comes last there. Null labels share a sum. An empty table gives no rows.
    Other columns are not looked at, whatever their names.
    """
    spark = embeddings.sparkSession
    kept = embeddings.select("vec_id", "label", F.col(vector).cast("array<double>").alias("v")).where(usable("v", (LARGEST - 1) / SCALE))
    width = max(1, -(-longest(kept, "v") // PARTS))
    rows = materialise(integers(kept, "v", SCALE, PARTS * width), "vector-integers")
    books = fit(rows, width)
    if not len(books[0]):
        return spark.createDataFrame([], StructType([embeddings.schema["vec_id"], *StructType.fromDDL(RESULT).fields]))
    coded = materialise(_coded(rows, books), "vector-codes")
    # A label's rows meet its sum in SALTS groups; Spark broadcasts the sums instead if they are small.
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    spread = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    sums = sums.select(F.col("label").alias("_label"), "label_error", spread.alias("_salt"))
    salted = coded.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    met = salted.join(sums, F.col("label").eqNullSafe(F.col("_label")) & (salted["_salt"] == sums["_salt"]))
    return met.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


RESULT = "code string, error long, label_error long, codebooks_sha256 string"


def _assigned(k: int) -> str:
    return f"""a{k} AS (
  SELECT id, p, any_value(part) AS part, arg_min(e, d * {ENTRIES} + e) AS e, min(d) AS d FROM (
    SELECT q.id, q.p, q.part, b.e,
           list_sum(list_transform(range(1, len(q.part) + 1), lambda c: (q.part[c] - b.part[c]) * (q.part[c] - b.part[c])))::BIGINT AS d
    FROM q JOIN b{k} b ON q.p = b.p) GROUP BY id, p)"""


def _means(k: int) -> str:
    return f"""m{k} AS (
  SELECT p, e, list(m ORDER BY c) AS part FROM (
    SELECT p, e, c, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*))::BIGINT // count(*) AS m
    FROM (SELECT p, e, generate_subscripts(part, 1) AS c, unnest(part) AS x FROM a{k}) GROUP BY p, e, c) GROUP BY p, e),
b{k + 1} AS (SELECT b.p, b.e, coalesce(m.part, b.part) AS part FROM b{k} b LEFT JOIN m{k} m ON b.p = m.p AND b.e = m.e)"""


#: The same by all distances, over tables whose vectors have one length divisible by four.
SQL = f"""
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT id, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS part FROM k, range({PARTS}) t(p)),
b0 AS (SELECT p, id - 1 AS e, part FROM q WHERE id <= {ENTRIES}),
{",".join(f"{_assigned(k)},{_means(k)}" for k in range(ROUNDS))},
{_assigned(ROUNDS)},
h AS (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{ROUNDS}),
r AS (SELECT id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM r JOIN k USING (id), h
"""
