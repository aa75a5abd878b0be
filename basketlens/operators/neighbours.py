"""Nearest items by cosine similarity: exact, or through an inverted-file index whose recall is audited.

Both forms run on a grid of groups, blocks of requests and strips of items. A
vector is shipped once a block of its group, not once a request; a task holds
one block with its best items so far and reads a strip in slices, so it gives
at most ``k`` rows a request, however many items tie.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.operators.metrics import rows
from basketlens.session import materialise

#: Requests of a block, fewest items of a strip, requests and items scored at once, finds of a request there that are few.
BLOCK, STRIP, TILE, FEW = 4096, 4096, 1024, 64
#: Similarities are compared at this precision, below which products of equal vectors may differ.
SCORE_DIGITS = 12
#: Most cells of an index, vectors a cell is fitted on, and rounds of fitting.
CELLS, SAMPLE, ROUNDS = 1024, 64, 8
#: Requests of an audit, cells first probed, and the share of neighbours that must be found.
AUDIT, PROBES, RECALL = 256, 4, 0.95


def unit_vectors(vectors: DataFrame, item: str, vector: str) -> DataFrame:
    """(item, unit) with unit-length double vectors; a zero vector stays zero."""
    values = F.transform(vector, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate("values", F.lit(0.0), lambda total, x: total + x * x))
    # An array of one (values, length) keeps the length out of the inner loop, where it would be taken again for each component.
    measured = vectors.select(F.col(item).alias("item"), values.alias("values")).select("item", F.array(F.struct("values", norm.alias("norm"))).alias("one"))
    scaled = F.transform("one", lambda v: F.when(v["norm"] > 0, F.transform(v["values"], lambda x: x / v["norm"])).otherwise(v["values"]))
    return measured.select("item", F.get(scaled, F.lit(0)).alias("unit"))


def nearest_items(
    vectors: DataFrame,
    requests: DataFrame,
    k: int = 10,
    item: str = "item",
    vector: str = "vector",
    block: int = BLOCK,
    strip: int = STRIP,
) -> DataFrame:
    """The ``k`` most similar other items of each requested item, by all similarities.

    ``requests`` holds item ids in column ``item``. Returns
    (item, neighbour, similarity, rank); ties go to the smaller id.
    """
    units = materialise(unit_vectors(vectors, item, vector), "units")
    wanted = units.join(requests.select(F.col(item).alias("item")).distinct(), "item", "left_semi")
    return all_pairs(units, wanted, k, block, strip)


def all_pairs(units: DataFrame, wanted: DataFrame, k: int, block: int = BLOCK, strip: int = STRIP) -> DataFrame:
    """The ``k`` items of ``units`` with the largest products with each of ``wanted``, both (item, unit), but for itself."""
    total, asked = units.count(), wanted.count()
    one = F.lit(0).alias("cell")
    sizes = units.sparkSession.createDataFrame([(0, _blocks(asked, block), _strips(total, strip))], "cell int, blocks int, strips int")
    return ranked(_searched(units.select("*", one), wanted.select("*", one), sizes, k), k)


class ItemIndex:
    """An inverted file: vectors by the nearest of up to ``CELLS`` centres.

    Centres are fitted on at most ``SAMPLE`` vectors a cell, those of smallest
    hash; every vector is filed. A request searches the cells of its nearest
    centres. How many is settled by an audit: sampled requests are also answered
    by all similarities, and the probes are doubled until ``RECALL`` of their
    neighbours are found, at worst until all cells are probed, which is exact.
    Numbers of probes that leave too many neighbours in other cells are passed over
    without a search; what counts is the recall of a search.
    """

    def __init__(self, vectors: DataFrame, item: str = "item", vector: str = "vector", cells: int | None = None):
        self.units = materialise(unit_vectors(vectors, item, vector), "units")
        self.name = item
        total = self.units.count()
        wanted = min(CELLS, max(1, math.isqrt(total))) if cells is None else cells
        sample = self.units.orderBy(F.xxhash64("item"), "item").select("unit").limit(wanted * SAMPLE).collect()
        self.centres = _fitted(np.array([r[0] for r in sample]), wanted) if sample else np.zeros((0, 1))
        self.filed = materialise(self._cells(self.units), "filed")
        self.held = np.zeros(len(self.centres), np.int64)  # vectors by cell
        for cell, held in self.filed.groupBy("cell").agg(rows()).collect():  # a row a cell
            self.held[cell] = held
        self.recall: float | None = None
        self.probes = min(PROBES, len(self.centres))

    def _cells(self, units: DataFrame) -> DataFrame:
        """``units`` with the number of their nearest centre."""
        centres = self.centres
        schema = T.StructType([*units.schema.fields, T.StructField("cell", T.IntegerType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    near = _matrix(part.column("unit")) @ centres.T
                    yield pa.record_batch([*part.columns, pa.array(near.argmax(1).astype(np.int32))], names=schema.fieldNames())

        return units.select("item", "unit").mapInArrow(run, schema) if len(centres) else units.select("*", F.lit(0).alias("cell")).limit(0)

    def _asked(self, wanted: DataFrame, probes: int, needs: np.ndarray) -> DataFrame:
        """Requests with the bits of the cells they probe, one row for each strip that ``needs`` (cells x strips) asks of them."""
        centres, needs = self.centres, needs.astype(np.float32)
        schema = T.StructType([*wanted.select("item", "unit").schema.fields, T.StructField("strip", T.IntegerType()), T.StructField("probed", T.BinaryType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    near = _matrix(part.column("unit")) @ centres.T
                    probed = np.zeros(near.shape, bool)
                    np.put_along_axis(probed, (-near).argsort(1, kind="stable")[:, :probes], True, 1)
                    request, strip = np.nonzero(probed.astype(np.float32) @ needs)
                    bits = pa.array([row.tobytes() for row in np.packbits(probed, axis=1)], pa.binary())
                    take = pa.array(request)
                    yield pa.record_batch([*(c.take(take) for c in part.columns), pa.array(strip.astype(np.int32)), bits.take(take)], names=schema.fieldNames())

        return wanted.select("item", "unit").mapInArrow(run, schema)

    def _search(self, wanted: DataFrame, k: int, probes: int, block: int, strip: int) -> DataFrame:
        """The cells' vectors lie end to end and are cut into strips, so a strip has many small cells or a piece of a
        large one. A request goes to a strip once, for all its cells there: at worst what all similarities ship.
        """
        blocks, strips = _blocks(wanted.count(), block), _strips(self.held.sum(), strip)
        size, end = max(1, -(-int(self.held.sum()) // strips)), self.held.cumsum()
        first, last = (end - self.held) // size, (end - 1) // size
        needs = (first[:, None] <= np.arange(strips)) & (np.arange(strips) <= last[:, None]) & (self.held > 0)[:, None]
        places = [(cell, int(end[cell] - n), int(n)) for cell, n in enumerate(self.held)]
        placed = self.filed.join(F.broadcast(wanted.sparkSession.createDataFrame(places, "cell int, start long, held long")), "cell")
        place = F.col("start") + F.pmod(F.xxhash64(F.lit(7), "item"), F.col("held"))
        left = self._asked(wanted, probes, needs).select(
            F.lit(-1).alias("cell"), _block(F.lit(blocks)), "strip", F.lit(True).alias("asks"), "item", "unit", "probed"
        )
        right = placed.select(
            "cell", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.floor(place / size).cast("int").alias("strip"),
            F.lit(False).alias("asks"), "item", "unit", F.lit(None).cast("binary").alias("probed"),
        )
        return ranked(_dealt(left, right, blocks * strips, k), k)

    def audit(self, k: int = 10, least: float = RECALL, block: int = BLOCK, strip: int = STRIP) -> float:
        """Settle ``probes``; the recall that the sampled requests reach, 1 without vectors."""
        sample = materialise(self.units.orderBy(F.xxhash64(F.lit(1), "item"), "item").limit(AUDIT), "audit")
        truth = materialise(all_pairs(self.units, sample, k, block, strip), "truth")
        self.recall = 1.0
        order = self._orders(sample)
        filed = truth.join(self.filed.select(F.col("item").alias("neighbour"), "cell"), "neighbour")
        places = np.array([order[r["item"]][r["cell"]] for r in filed.select("item", "cell").collect()])  # k a sampled request
        while self.probes < len(self.centres) and (places < self.probes).sum() < least * len(places):
            self.probes = min(2 * self.probes, len(self.centres))
        while len(self.centres):
            found = self._search(sample, k, self.probes, block, strip)
            hits = found.join(truth, ["item", "neighbour"], "left_semi").count()
            self.recall = hits / max(1, truth.count())
            if self.recall >= least or self.probes == len(self.centres):
                break
            self.probes = min(2 * self.probes, len(self.centres))
        return self.recall

    def _orders(self, sample: DataFrame) -> dict:
        """For each of a few requests, the place of every cell among those it probes first."""
        asked = sample.select("item", "unit").collect()
        if not asked or not len(self.centres):
            return {}
        first = (-(np.array([r["unit"] for r in asked]) @ self.centres.T)).argsort(1, kind="stable")
        return dict(zip((r["item"] for r in asked), first.argsort(1)))

    def nearest(self, requests: DataFrame, k: int = 10, block: int = BLOCK, strip: int = STRIP) -> DataFrame:
        """As ``nearest_items``, over the probed cells only; audited first, if it wasn't."""
        if self.recall is None:
            self.audit(k)
        wanted = self.units.join(requests.select(F.col(self.name).alias("item")).distinct(), "item", "left_semi")
        return self._search(wanted, k, self.probes, block, strip)


def _fitted(sample: np.ndarray, cells: int) -> np.ndarray:
    """Unit centres by rounds of assigning and averaging; an empty cell takes the vector farthest from its centre."""
    centres = sample[:: max(1, len(sample) // cells)][:cells].copy()
    for _ in range(ROUNDS):
        near = sample @ centres.T
        cell = near.argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, sample)
        empty = np.flatnonzero(np.bincount(cell, minlength=len(centres)) == 0)
        sums[empty] = sample[near.max(1).argsort(kind="stable")[: len(empty)]]
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
    return centres


def _parts(n: int, size: int) -> int:
    return max(1, -(-int(n) // size))


def _blocks(n: int, block: int) -> int:
    """Blocks grow with the root of the requests, so that copies of the items stay far fewer than pairs."""
    return _parts(n, max(block, 32 * math.isqrt(n) if block == BLOCK else block))


def _strips(n: int, strip: int) -> int:
    """Strips grow with the root of the items, so that finds of all strips stay far fewer than pairs."""
    n = int(n)
    return _parts(n, max(strip, 32 * math.isqrt(n) if strip == STRIP else strip))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sizes(units: np.ndarray) -> np.ndarray:
    """Lengths, to scale by: 1 for zero and non-finite vectors."""
    size = np.linalg.norm(units, axis=1)
    return np.where(np.isfinite(size) & (size > 0), size, 1.0)


def _places(flags: np.ndarray) -> np.ndarray:
    """Where few flags are true, as places in the flattened array: eight are looked at together."""
    flat = flags.ravel()
    if len(flat) % 8:
        return np.flatnonzero(flat)
    some = np.flatnonzero(flat.view(np.uint64))
    at, place = np.nonzero(flat.reshape(-1, 8)[some])
    return some[at] * 8 + place


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("item"), blocks).cast("int").alias("block")


def _searched(items: DataFrame, asked: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """The best items (item, neighbour, similarity) of each request in each strip of all items.

    ``sizes`` has the blocks of requests and strips of items, for the one cell that all are in.
    """
    strip = F.pmod(F.xxhash64(F.lit(7), "item"), F.col("strips")).cast("int")
    probed = F.lit(None).cast("binary").alias("probed")
    left = asked.join(sizes, "cell").select(
        "cell", _block(F.col("blocks")), F.explode(F.expr("sequence(0, strips - 1)")).alias("strip"), F.lit(True).alias("asks"), "item", "unit", probed
    )
    right = items.join(sizes, "cell").select(
        "cell", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), strip.alias("strip"), F.lit(False).alias("asks"), "item", "unit", probed
    )
    tasks = sizes.agg(F.sum(F.col("blocks").cast("long") * F.col("strips"))).first()[0] or 1
    return _dealt(left, right, tasks, k)


def _dealt(left: DataFrame, right: DataFrame, tasks: int, k: int) -> DataFrame:
    """Requests and items meet by (block, strip)."""
    dealt = left.unionByName(right).repartition(min(2 * tasks, 10_000), "block", "strip")
    ordered = dealt.sortWithinPartitions("block", "strip", F.desc("asks"), "cell", "item")
    kind = right.schema["item"].dataType
    answer = T.StructType([T.StructField("item", kind), T.StructField("neighbour", kind), T.StructField("similarity", T.DoubleType())])
    return ordered.mapInArrow(_streamed(k), answer)


def _streamed(k: int) -> Callable:
    """Requests of a grid cell come first, its items after them by the cells of an index, in order of their ids.

    Requests with bits of probed cells meet the items of these only.
    """

    class Block:
        def __init__(self, batches: list[pa.RecordBatch]):
            self.asked = pa.chunked_array([b.column("item") for b in batches]).combine_chunks()
            self.names = self.asked.to_numpy(zero_copy_only=False)
            self.units = np.concatenate([_matrix(b.column("unit")) for b in batches])
            self.size = _sizes(self.units)
            self.rough = (self.units / self.size[:, None]).astype(np.float32)
            self.score = np.full((len(self.names), k), -np.inf)
            self.found = np.full((len(self.names), k), self.names[0], self.names.dtype)
            bits = [bits for b in batches for bits in b.column("probed").to_pylist()]
            self.probed = None if bits[0] is None else np.unpackbits(np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), -1), axis=1).T

        def meet(self, batch: pa.RecordBatch, cell: int) -> None:
            """Tiles are scored in single precision; only what may be among the best is scored exactly."""
            who = np.arange(len(self.names)) if self.probed is None else np.flatnonzero(self.probed[cell])
            if not len(who):
                return
            offered, units = batch.column("item").to_numpy(zero_copy_only=False), _matrix(batch.column("unit"))
            size, asking = _sizes(units).max(), self.rough if self.probed is None else self.rough[who]
            rough, slack = (units / size).astype(np.float32), (units.shape[1] + 8) * 2.0**-23
            for at in range(0, len(units), TILE):
                items, names, near = units[at : at + TILE], offered[at : at + TILE], rough[at : at + TILE].T
                for start in range(0, len(who), TILE):
                    rows = who[start : start + TILE]
                    least = self.score[rows, -1] / (self.size[rows] * size) - slack
                    scores = asking[start : start + TILE] @ near
                    if len(items) > k + 1 and np.isneginf(least).any():
                        # The request itself may be among the items, so that one more than k must be as good.
                        best = np.partition(np.where(np.isnan(scores), -np.inf, scores), -k - 1, axis=1)[:, -k - 1]
                        least = np.maximum(least, best - 2 * slack)
                    hopeful = scores >= least.astype(np.float32)[:, None]
                    request, place = np.divmod(_places(hopeful), len(items))
                    if not len(request):
                        continue
                    held = np.bincount(request, minlength=len(rows))
                    if held.max() > FEW:
                        self.offer_all(rows[held > FEW], items, names)
                        few = held[request] <= FEW
                        request, place = request[few], place[few]
                    scores = np.einsum("ij,ij->i", self.units[rows[request]], items[place])
                    self.offer(rows, request, np.round(scores, SCORE_DIGITS), names[place])

        def offer_all(self, rows: np.ndarray, items: np.ndarray, names: np.ndarray) -> None:
            """Score all ``items``, which come by their ids; of more than ``k`` the best go on, of equal ones the first."""
            scores = np.round(self.units[rows] @ items.T, SCORE_DIGITS)
            scores[np.isnan(scores) | (self.names[rows][:, None] == names[None])] = -np.inf
            best = scores > -np.inf
            if scores.shape[1] > k:
                least = np.partition(scores, -k, axis=1)[:, -k, None]
                best &= scores >= least
                tied = np.flatnonzero(best.sum(1) > k)
                equal = scores[tied] == least[tied]
                best[tied] &= ~equal | (equal.cumsum(1) <= k)
            request, place = np.nonzero(best)
            self.offer(rows, request, scores[request, place], names[place])

        def offer(self, rows: np.ndarray, request: np.ndarray, scores: np.ndarray, names: np.ndarray) -> None:
            """Merge finds, in order of ``request`` (a place in ``rows``), into the best so far."""
            into = rows[request]
            # Within a cell later items with equal scores have larger ids; a later cell may hold smaller ones.
            better = (scores >= self.score[into, -1]) & (scores > -np.inf) & (self.names[into] != names)
            request, scores, names = request[better], scores[better], names[better]
            if not len(request):
                return
            some, request, held = np.unique(request, return_inverse=True, return_counts=True)
            slot = np.arange(len(request)) - (held.cumsum() - held)[request]
            into = rows[some]
            new, ids = np.full((len(some), held.max()), -np.inf), np.full((len(some), held.max()), names[0], self.found.dtype)
            new[request, slot], ids[request, slot] = scores, names
            both, ids = np.concatenate([self.score[into], new], 1), np.concatenate([self.found[into], ids], 1)
            if self.probed is not None:
                by_id = ids.argsort(1, kind="stable")
                both, ids = np.take_along_axis(both, by_id, 1), np.take_along_axis(ids, by_id, 1)
            top = (-both).argsort(1, kind="stable")[:, :k]
            self.score[into], self.found[into] = np.take_along_axis(both, top, 1), np.take_along_axis(ids, top, 1)

        def table(self) -> pa.RecordBatch:
            request, place = np.nonzero(np.isfinite(self.score))
            near = pa.array(self.found[request, place], self.asked.type)
            return pa.record_batch([self.asked.take(pa.array(request)), near, pa.array(self.score[request, place])], names=["item", "neighbour", "similarity"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, waiting, block = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "strip", "asks", "cell")], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                if start == end:
                    continue
                here, part = tuple(keys[start, :2]), batch.slice(start, end - start)
                if here != key:
                    if block is not None:
                        yield block.table()
                    key, waiting, block = here, [], None
                if keys[start, 2]:
                    waiting.append(part)
                elif waiting or block is not None:
                    if block is None:
                        block, waiting = Block(waiting), []
                    block.meet(part, keys[start, 3])
        if block is not None:
            yield block.table()

    return run


def ranked(found: DataFrame, k: int) -> DataFrame:
    by_score = Window.partitionBy("item").orderBy(F.desc("similarity"), "neighbour")
    return found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
