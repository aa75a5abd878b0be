"""Near-equal vectors by NN-descent.

Equal vectors of a label are one node. A neighbour graph starts from orders by
random projections, and is refined by joining nodes through a common neighbour
until little changes. Edges at the threshold, checked in double precision, give
components. A node whose whole list is over the threshold may have more links
than its list can hold. Such nodes look for neighbours outside their component,
in lists and orders that leave it out, until no component is linked to another;
then their lists are enlarged to the component, which is compared tile by tile.
An audit compares some nodes with all others and asks for another descent with
longer lists if too few of their links were found; after the last one that falls
short, all pairs of a part are compared tile by tile.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import components
from basketlens.session import materialise

THRESHOLD = 0.93
#: Neighbours of a list, orders by projections to start from, nodes of a block or a meeting, nodes of a tile.
LIST, ORDERS, BLOCK, TILE = 16, 3, 64, 512
#: Half-precision cosines are this near to the exact ones.
SLACK = 0.01
#: A round that changes less than this share of the list entries is the last.
SETTLED = 0.002
#: Audited nodes of each kind (without links, listed, in a whole component), the share of a node's links that has to be found, descents.
AUDIT, RECALL, TRIES = 256, 0.95, 3


def _unit(values: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows."""
    values = values / np.abs(values).max(1, keepdims=True)
    return values / np.sqrt((values * values).sum(1, keepdims=True))


def _same(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Borders of runs of equal entries."""
    start = 0
    for i in range(1, len(sizes) + 1):
        if i == len(sizes) or sizes[i] != sizes[start]:
            yield start, i
            start = i


def nodes_of(vectors: DataFrame) -> DataFrame:
    """(c, part, low, copies, exact, half): a node for each distinct (label, embedding) that can link with anything."""
    x = F.col("embedding").cast("array<double>")
    usable = (
        F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & (F.size("embedding") > 0)
        & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        & F.exists(x, lambda v: v != 0)
    )
    own = vectors.where(usable).select("vec_id", "label", x.alias("embedding"))
    grouped = own.groupBy("label", "embedding").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            exact, half = [], []
            for v in batch.column("embedding"):
                unit = _unit(v.values.to_numpy()[None])[0]
                exact.append(unit.tobytes())
                half.append(unit.astype(np.float16).tobytes())
            yield pa.record_batch(
                [batch.column(c) for c in ("c", "part", "low", "copies", "label")] + [batch.column("embedding"), pa.array(exact, pa.binary()), pa.array(half, pa.binary())],
                names=["c", "part", "low", "copies", "label", "embedding", "exact", "half"],
            )

    kind = vectors.schema["label"].dataType.simpleString()
    numbered = grouped.select(
        F.monotonically_increasing_id().alias("c"),
        F.xxhash64("label", F.size("embedding")).alias("part"),
        F.col("low").cast("long").alias("low"),
        "copies",
        "label",
        "embedding",
    )
    return materialise(
        numbered.mapInArrow(
            run, f"c long, part long, low long, copies long, label {kind}, embedding array<double>, exact binary, half binary"
        ),
        "vector-nodes",
    )


def _ordered(keep: int):
    """Neighbours of other owners within half-overlapping blocks of an order.

    Of a run of rows of one owner only the first and the last stand in a block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: list[tuple] = []

        def block(rows):
            c, own = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
            m = np.frombuffer(b"".join(r[3] for r in rows), np.float16).reshape(len(rows), -1).astype(np.float32)
            yield from _best(c, own, m @ m.T, np.full(len(c), -2.0), keep)

        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("part", "c", "own", "half"))):
                if carry and row[0] != carry[0][0]:
                    if len(carry) > 1:
                        yield from block(carry)
                    carry = []
                if len(carry) > 1 and row[2] == carry[-1][2] == carry[-2][2]:
                    carry[-1] = row
                    continue
                carry.append(row)
                if len(carry) == BLOCK:
                    yield from block(carry)
                    carry = carry[BLOCK // 2 :]
        if len(carry) > 1:
            yield from block(carry)

    return run


def _best(c: np.ndarray, own: np.ndarray, cosines: np.ndarray, bar: np.ndarray, keep: int) -> Iterator[pa.RecordBatch]:
    """Each row's best columns over its bar, those of its owner left out."""
    cosines[own[:, None] == own[None]] = -3
    keep = min(keep, len(c) - 1)
    best = np.argpartition(-cosines, keep - 1, axis=1)[:, :keep]
    value = np.take_along_axis(cosines, best, 1)
    use = value > bar[:, None]
    yield pa.record_batch(
        [pa.array(np.repeat(c, keep)[use.ravel()]), pa.array(c[best][use]), pa.array(value[use].astype(np.float32))],
        names=["a", "b", "cosine"],
    )


def _projected(k: int):
    """(c, part, own, code, half): signs on random directions, drawn from the order's number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            halves = batch.column("half").to_pylist()
            codes = np.zeros(len(halves), np.int64)
            for s, e in _same([len(h) for h in halves]):
                m = np.frombuffer(b"".join(halves[s:e]), np.float16).reshape(e - s, -1).astype(np.float32)
                planes = np.random.default_rng(1000 + k).standard_normal((m.shape[1], 24)).astype(np.float32)
                codes[s:e] = ((m @ planes) > 0) @ (1 << np.arange(24))[::-1]
            yield pa.record_batch(
                [batch.column("c"), batch.column("part"), batch.column("own"), pa.array(codes), batch.column("half")],
                names=["c", "part", "own", "code", "half"],
            )

    return run


def _top(edges: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")
    return (
        edges.groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
        .withColumn("r", F.row_number().over(order))
        .where(F.col("r") <= keep)
        .select("a", "b", "cosine")
    )


def _meet(keep: int):
    """Members of a common neighbour, in chunks of BLOCK: better neighbours among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def meet():
            if len(rows) > 1:
                c, own = np.array([r[1] for r in rows]), np.array([r[4] for r in rows])
                m = np.frombuffer(b"".join(r[3] for r in rows), np.float16).reshape(len(rows), -1).astype(np.float32)
                yield from _best(c, own, m @ m.T, np.array([r[2] for r in rows]), keep)

        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("v", "m", "bar", "half", "own"))):
                if rows and (row[0] != rows[0][0] or len(rows) == BLOCK):
                    yield from meet()
                    rows = []
                rows.append(row)
        yield from meet()

    return run


def graph(
    nodes: DataFrame, keep: int = LIST, orders: int = ORDERS, seed: int = 0, beside: DataFrame | None = None
) -> DataFrame:
    """(a, b, cosine): each node's ``keep`` best neighbours of its part, after NN-descent.

    ``nodes`` may have ``own``, the owner of a node: neighbours have another owner.
    Pairs of ``beside`` (a, b) meet like neighbours, but are in no list.
    """
    if "own" not in nodes.columns:
        nodes = nodes.withColumn("own", F.col("c"))
    edges = None
    for k in range(seed, seed + orders):
        started = (
            nodes.select("c", "part", "own", "half").mapInArrow(_projected(k), "c long, part long, own long, code long, half binary")
            .repartitionByRange("part", "code", "c")
            .sortWithinPartitions("part", "code", "c")
            .mapInArrow(_ordered(keep), "a long, b long, cosine float")
        )
        edges = started if edges is None else edges.unionByName(started)
    lists = materialise(_top(edges, keep), "neighbours")
    for turn in count():
        bars = lists.groupBy("a").agg(F.min("cosine").alias("low"), F.count("*").alias("n"))
        known = nodes.select("c", "half", "own").join(bars, nodes.c == bars.a, "left").select(
            F.col("c").alias("m"),
            "half",
            "own",
            # A short list takes any neighbour.
            F.when(F.col("n") >= keep, F.col("low").cast("double")).otherwise(F.lit(-2.0)).alias("bar"),
        )
        pairs = lists.select("a", "b") if beside is None else lists.select("a", "b").union(beside.select("a", "b"))
        both = pairs.select(F.col("a").alias("v"), F.col("b").alias("m")).union(
            pairs.select(F.col("b").alias("v"), F.col("a").alias("m"))
        ).distinct()
        closer = (
            both.join(known, "m")
            .repartition("v")
            # Other chunks of a hub's members each time.
            .sortWithinPartitions("v", F.xxhash64("m", F.lit(seed), F.lit(turn)))
            .mapInArrow(_meet(keep), "a long, b long, cosine float")
        )
        after = materialise(_top(lists.unionByName(closer), keep), "neighbours")
        kept = after.join(lists, ["a", "b"], "left_semi").count()
        now = after.count()
        lists = after
        if now - kept <= SETTLED * max(now, 1):
            break
    return lists


def links_of(lists: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a < b: listed pairs whose exact cosine is at least the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                float(np.dot(np.frombuffer(x, np.float64), np.frombuffer(y, np.float64))) >= threshold
                for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())
            ]
            yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    near = lists.where(F.col("cosine") >= threshold - SLACK)
    pairs = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    exact = nodes.select("c", "exact")
    return (
        pairs.join(exact.select(F.col("c").alias("a"), F.col("exact").alias("x")), "a")
        .join(exact.select(F.col("c").alias("b"), F.col("exact").alias("y")), "b")
        .select("a", "b", "x", "y")
        .mapInArrow(run, "a long, b long")
    )


def _tiled(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        left = group["side"].to_numpy()
        c, copies = group["c"].to_numpy(), group["copies"].to_numpy()
        m = np.frombuffer(b"".join(group["exact"].to_pylist()), np.float64).reshape(len(c), -1)
        one, two = np.flatnonzero(left == 0), np.flatnonzero(left == 1)
        if not len(two):  # a tile with itself
            hit = (m @ m.T) >= threshold
            np.fill_diagonal(hit, False)
            ids, counts = c, hit @ copies
        else:
            hit = (m[one] @ m[two].T) >= threshold
            ids, counts = np.concatenate([c[one], c[two]]), np.concatenate([hit @ copies[two], hit.T @ copies[one]])
        return pa.table({"c": pa.array(ids), "n": pa.array(counts.astype(np.int64))})

    return run


def _joined(threshold: float):
    """Edges that join the linked nodes of two tiles, fewer than nodes."""

    def run(group: pa.Table) -> pa.Table:
        c = group["c"].to_numpy()
        m = np.frombuffer(b"".join(group["exact"].to_pylist()), np.float64).reshape(len(c), -1)
        hit = (m @ m.T) >= threshold
        np.fill_diagonal(hit, True)
        low, before = np.arange(len(c)), None
        while before is None or (low != before).any():
            before, low = low, np.where(hit, low[None], len(c)).min(1)
        use = low != np.arange(len(c))
        return pa.table({"a": pa.array(c[use]), "b": pa.array(c[low[use]])})

    return run


def tiles(members: DataFrame):
    """``members`` (component, c, copies, exact) grouped by the pairs of tiles of their component."""
    size = members.groupBy("component").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    dealt = members.join(size, "component").withColumn("t", F.pmod(F.xxhash64("c"), F.col("tiles")).cast("int"))
    pairs = dealt.select("*", F.explode(F.expr("sequence(0, tiles - 1)")).alias("u")).select(
        "component",
        F.least("t", "u").alias("i"),
        F.greatest("t", "u").alias("j"),
        (F.col("t") > F.col("u")).cast("int").alias("side"),
        "c",
        "copies",
        "exact",
    )
    return pairs.groupBy("component", "i", "j")


def enlarged(members: DataFrame, threshold: float) -> DataFrame:
    """(c, n): links of every node with its whole component, each pair of tiles in a task of its own.

    ``members`` has (component, c, copies, exact); nothing is emitted a pair.
    """
    return tiles(members).applyInArrow(_tiled(threshold), "c long, n long").groupBy("c").agg(F.sum("n").alias("n"))


def exhaustive(nodes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(id, component) of linked nodes and (c, n) of all nodes, by comparing all pairs of each part."""
    members = nodes.select(F.col("part").alias("component"), "c", "copies", "exact")
    edges = tiles(members).applyInArrow(_joined(threshold), "a long, b long")
    return materialise(components(edges), "vector-groups"), enlarged(members, threshold)


def groups_of(links: DataFrame, full: DataFrame) -> DataFrame:
    """(id, component, whole) of every node that is linked or ``full`` (c); whole components have a full node."""
    tree = materialise(components(links), "vector-tree")
    alone = full.join(tree, full.c == tree.id, "left_anti").select(F.col("c").alias("id"), F.col("c").alias("component"))
    tree = tree.unionByName(alone)
    whole = tree.join(full, tree.id == full.c).select("component").distinct().withColumn("whole", F.lit(True))
    return materialise(
        tree.join(whole, "component", "left").select("id", "component", F.coalesce("whole", F.lit(False)).alias("whole")),
        "vector-groups",
    )


def merged(
    nodes: DataFrame, lists: DataFrame, links: DataFrame, full: DataFrame, threshold: float, keep: int, seed: int
) -> tuple[DataFrame, DataFrame]:
    """Links with those that full lists hid, and the groups they make; see ``groups_of``.

    A pair is in neither list only if both of its nodes are full. So the nodes of
    whole components go through the descent again with their own component left
    out, until no link joins two of them.
    """
    while True:
        grouped = groups_of(links, full)
        whole = grouped.where("whole").select(F.col("id").alias("c"), F.col("component").alias("own"))
        members = materialise(nodes.select("c", "part", "half").join(whole, "c"), "vector-members")
        many = members.groupBy("part").agg(F.min("own").alias("x"), F.max("own").alias("y")).where("x < y").select("part")
        if many.isEmpty():
            return links, grouped
        members = materialise(members.join(many, "part", "left_semi"), "vector-members")
        ids = members.select("c")
        beside = lists.join(ids.withColumnRenamed("c", "a"), "a", "left_semi").join(ids.withColumnRenamed("c", "b"), "b", "left_semi")
        outside = graph(members, keep, seed=seed, beside=materialise(beside.select("a", "b"), "neighbours"))
        found = materialise(links_of(outside, nodes, threshold), "vector-links")
        if found.isEmpty():
            return links, grouped
        links = materialise(links.unionByName(found).distinct(), "vector-links")
        seed += ORDERS


def recall(nodes: DataFrame, links: DataFrame, grouped: DataFrame, threshold: float, audit: int = AUDIT, seed: int = 0) -> float:
    """Mean share of a node's links with all other nodes that were found; 1 without links.

    ``audit`` nodes each (smallest hashes) are asked of those without component,
    in a listed one and in a whole one, and stand for all nodes of their kind. Means
    are taken of nodes with few, with some and with more links than a list has; the
    least counts, so large groups don't outweigh small ones. A link is found if it
    is listed or lies in a whole component (``grouped``: id, component, whole).
    """
    kind = F.when(F.col("component").isNull(), 0).when(F.col("whole"), 2).otherwise(1)
    judged = materialise(
        nodes.select("c", "part", "exact")
        .join(grouped.select(F.col("id").alias("c"), "component", "whole"), "c", "left")
        .select("c", "part", "exact", F.when(F.col("whole"), F.col("component")).alias("inside"), kind.alias("kind")),
        "vector-audit",
    )
    weight: dict[int, float] = {}
    by_part: dict[int, list] = {}
    for r in judged.groupBy("kind").count().collect():
        asked = judged.where(F.col("kind") == r.kind).orderBy(F.xxhash64("c", F.lit(seed))).limit(audit).collect()
        for one in asked:
            weight[one.c] = r["count"] / len(asked)
            by_part.setdefault(one.part, []).append((one.c, -1 if one.inside is None else one.inside, bytes(one.exact)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, part = batch.column("c").to_numpy(), batch.column("part").to_numpy()
            inside = batch.column("inside").fill_null(-2).to_numpy()
            raw = batch.column("exact").to_pylist()
            for p in np.unique(part).tolist():
                if p in by_part:
                    at = np.flatnonzero(part == p)
                    m = np.frombuffer(b"".join(raw[i] for i in at), np.float64).reshape(len(at), -1)
                    ids, own = (np.array([r[k] for r in by_part[p]], np.int64) for k in (0, 1))
                    asked = np.frombuffer(b"".join(r[2] for r in by_part[p]), np.float64).reshape(len(ids), -1)
                    hit = ((m @ asked.T) >= threshold) & (c[at][:, None] != ids[None])
                    same = hit & (inside[at][:, None] == own[None])
                    x, y = np.nonzero(hit & ~same)
                    # Links within whole components are counted here, the others are looked up.
                    a, n = np.concatenate([ids, ids[y]]), np.concatenate([same.sum(0), np.ones(len(x), np.int64)])
                    b = pa.array(np.concatenate([ids, c[at][x]]), mask=np.arange(len(a)) < len(ids))
                    yield pa.record_batch([pa.array(a), b, pa.array(n)], names=["a", "b", "n"]).filter(pa.array(n > 0))

    true = judged.select("c", "part", "exact", "inside").mapInArrow(run, "a long, b long, n long")
    listed = links.select(F.col("a").alias("x"), F.col("b").alias("y"), F.lit(True).alias("listed"))
    per_node = (
        true.select("*", F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
        .join(listed, ["x", "y"], "left")
        .groupBy("a")
        .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("b").isNull() | F.col("listed"), F.col("n")).otherwise(0)).alias("found"))
        .collect()
    )
    shares = []
    for low, high in ((1, 4), (4, LIST), (LIST, float("inf"))):
        some = [(weight[r.a], r.found / r.n) for r in per_node if low <= r.n < high]
        if some:
            shares.append(sum(w * x for w, x in some) / sum(w for w, _ in some))
    return min(shares, default=1.0)


def counted(nodes: DataFrame, links: DataFrame, grouped: DataFrame, threshold: float) -> DataFrame:
    """(c, n): links of every linked node, copies included; whole components (see ``groups_of``) are compared again."""
    ends = links.select(F.col("a").alias("c"), F.col("b").alias("d")).union(links.select("b", "a"))
    inside = grouped.where("whole").join(nodes.select("c", "copies", "exact"), F.col("id") == F.col("c")).select("component", "c", "copies", "exact")
    part = grouped.where("NOT whole").select(F.col("id").alias("c"))
    listed = (
        ends.join(part, "c", "left_semi")
        .join(nodes.select(F.col("c").alias("d"), "copies"), "d")
        .groupBy("c")
        .agg(F.sum("copies").alias("n"))
    )
    return enlarged(inside, threshold).unionByName(listed)


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, keep: int = LIST) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label).

    Links join vectors of one label with a cosine of at least ``threshold``.
    Vectors that are null, zero, or hold null or non-finite components, and rows
    without a label, have no link and are kept. Equal rows are links of each
    other; rows of one vec_id share its component.
    """
    nodes = nodes_of(vectors)
    lists = None
    for turn in range(TRIES):
        size = keep << turn
        fresh = graph(nodes, size, seed=turn * ORDERS)
        lists = fresh if lists is None else materialise(_top(lists.unionByName(fresh), size), "neighbours")
        links = materialise(links_of(lists, nodes, threshold), "vector-links")
        near = lists.where(F.col("cosine") >= threshold - SLACK).groupBy(F.col("a").alias("c")).count()
        full = materialise(near.where(F.col("count") >= size).select("c"), "vector-full")
        links, grouped = merged(nodes, lists, links, full, threshold, size, (turn + TRIES) * ORDERS)
        if recall(nodes, links, grouped, threshold, seed=turn) >= RECALL:
            grouped, counts = grouped.select("id", "component"), counted(nodes, links, grouped, threshold)
            break
    else:
        grouped, counts = exhaustive(nodes, threshold)
    named = (
        nodes.select("c", "label", "embedding", "low", "copies")
        .join(grouped.select(F.col("id").alias("c"), "component"), "c", "left")
        .join(counts, "c", "left")
        .select("label", "embedding", "low", F.coalesce("component", "c").alias("component"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    named = materialise(named, "vector-named")
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "component").select("label", "embedding", "n_links", "component_id")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.join(named, ["label", "embedding"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
