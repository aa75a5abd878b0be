"""Near duplicates by ProbMinHash signatures of weighted word shingles.

Equal texts form one class before anything else. A class's shingles (runs of
five words, weighted by how often they occur) are points that arrive in a
Poisson process; the first arrival at each of the signature's places is kept,
and generation ends once no later arrival can win. Equal places estimate the
probability Jaccard similarity. Bands of places give buckets; in a bucket,
members are compared with a few pivots, not with each other. Verified links are
joined to components, and buckets that still hold several components are
compared tile by tile: a task holds two tiles of a bucket, compares members of
different components and gives no more links than join them. So a component is
whole, although no group is expanded into all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import Powers, Words, components, mix, slices
from basketlens.session import forget, materialise

WIDTH, SIMILARITY = 5, 0.8
#: 25 bands of 4 places: a pair at similarity 0.8 is missed with a probability of 2e-6.
BANDS, PLACES = 25, 4
#: Estimates under the similarity less this are not verified: five standard deviations of the estimate.
MARGIN = 0.2
#: Pivots of each bucket before components are compared; members and shingles of a tile then.
PIVOT_ROUNDS, TILE, TILE_SHINGLES = 3, 512, 1 << 18


def shingles(words: Words, powers: Powers, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, count) of the distinct shingles of each row, by row and hash; under ``width`` words are one shingle."""
    hashes = words.hashes()
    n = np.diff(words.first)
    number = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    rows = np.repeat(np.arange(len(n)), number)
    start = words.first[:-1][rows] + (np.arange(len(rows)) - np.repeat(np.cumsum(number) - number, number))
    key = powers.spans(hashes, start, start + np.minimum(n[rows], width))
    order = np.lexsort((key, rows))
    key, rows = key[order], rows[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    return rows[at], key[at], np.diff(np.append(at, len(key)))


def signature(rows: np.ndarray, keys: np.ndarray, weights: np.ndarray, n: int, places: int) -> np.ndarray:
    """(n, places) 32-bit ProbMinHash signatures; rows without elements are zeros.

    An element with weight w arrives at the times of a Poisson process of rate w,
    each time at a random place, all of it drawn from its hash. Arrivals after the
    time by which all places are filled (with high probability) can't win and are
    not generated; rows where a place stayed empty get twice the time.
    """
    keys = mix(keys ^ np.uint64(0x5851F42D4C957F2D))  # keys in arithmetic progression would share draws
    out = np.zeros(n * places, np.uint64)
    total = np.bincount(rows, weights, n)
    wanted = total > 0
    horizon = np.where(wanted, places / np.maximum(total, 1e-300) * (math.log(places) + 6), 0)
    todo = wanted
    while todo.any():
        first = np.full(n * places, np.inf)
        who = np.zeros(n * places, np.uint64)
        live = np.flatnonzero(todo[rows])
        r, e, w = rows[live], keys[live], weights[live].astype(float)
        time, k = np.zeros(len(r)), 0
        while len(r):
            draw = mix(e + np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1)) % (1 << 64)))
            time = time - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / w
            keep = time <= horizon[r]
            r, e, w, time, draw = r[keep], e[keep], w[keep], time[keep], draw[keep]
            place = r * places + (mix(draw ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(places)).astype(np.int64)
            before = first[place]
            np.minimum.at(first, place, time)
            won = (time == first[place]) & (time < before)
            who[place[won]] = e[won]
            k += 1
        done = todo & np.isfinite(first.reshape(n, places)).all(1)
        filled = np.repeat(done, places)
        out[filled] = who[filled]
        horizon = horizon * 2
        todo = todo & ~done
    return (mix(out) >> np.uint64(32)).astype(np.uint32).reshape(n, places) * wanted[:, None].astype(np.uint32)


def _signed(width: int, bands: int, places: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for piece in slices(batch, "text"):
                n = piece.num_rows
                rows, keys, counts = shingles(Words(piece.column("text")), powers, width)
                signs = signature(rows, keys, counts, n, bands * places)
                yield pa.record_batch(
                    [
                        piece.column("doc_id"),
                        piece.column("key"),
                        pa.array(np.bincount(rows, minlength=n)),
                        pa.array([s.tobytes() for s in signs], pa.binary()),
                    ],
                    names=["doc_id", "key", "n_shingles", "sign"],
                )

    return run


def _bands(bands: int, places: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = batch.column("c").to_numpy()
            if not len(c):
                continue
            signs = np.frombuffer(b"".join(batch.column("sign").to_pylist()), np.uint32).reshape(len(c), bands, places)
            value = np.repeat(np.arange(bands, dtype=np.uint64)[None], len(c), 0) + np.uint64(1)
            for k in range(places):
                value = mix(value * np.uint64(0x9E3779B97F4A7C15) + signs[:, :, k].astype(np.uint64))
            yield pa.record_batch(
                [
                    pa.array(np.repeat(c, bands)),
                    pa.array(value.ravel().view(np.int64)),
                    pa.array(np.tile(np.arange(bands, dtype=np.int32), len(c))),
                ],
                names=["c", "bucket", "band"],
            )

    return run


def _across(bands: int, places: int, width: int, similarity: float):
    """Two tiles of a bucket -> links (a, b) of its components that join them: fewer than the members, however many pairs are similar.

    Pairs of different components with near signatures are compared exactly, in
    the first band they share only; a link joins its components at once, so
    later pairs of them are passed over.
    """

    def run(group: pa.Table) -> pa.Table:
        side, c = group["side"].to_numpy(), group["c"].to_numpy()
        first, band = group["component"].to_numpy(), int(group["band"][0].as_py())
        home = first.copy()
        signs = np.frombuffer(b"".join(group["sign"].to_pylist()), np.uint32).reshape(len(c), bands, places)
        rows, keys, counts = shingles(Words(group["text"]), Powers(), width)
        cut = np.searchsorted(rows, np.arange(len(c) + 1))
        size = np.bincount(rows, counts, len(c))
        plain = np.maximum.reduceat(counts, cut[:-1]) == 1
        kinds, number = np.unique(keys, return_inverse=True)
        share = counts / size[rows]
        own = np.zeros(len(kinds))
        one = np.flatnonzero(side == 0)
        two = np.flatnonzero(side == 1)
        links = []
        for i in one.tolist():
            other = two if len(two) else one[one > i]
            other = other[home[other] != home[i]]
            same = signs[other] == signs[i]
            near = other[(same.mean((1, 2)) >= similarity - MARGIN) & ~same[:, :band].all(2).any(1)]
            if not len(near):
                continue
            lengths = cut[near + 1] - cut[near]
            starts = np.cumsum(lengths) - lengths
            entries = np.arange(lengths.sum()) + np.repeat(cut[near] - starts, lengths)
            mine = slice(cut[i], cut[i + 1])
            own[number[mine]] = share[mine]
            met = own[number[entries]]
            own[number[mine]] = 0
            common = np.add.reduceat((met > 0).astype(float), starts)
            exact = common / (size[i] + size[near] - common)  # of shingles that occur once each
            bound = np.add.reduceat(np.minimum(met, share[entries]), starts)  # no similarity is above it
            for j, like, most in zip(near.tolist(), exact.tolist(), bound.tolist()):
                if home[j] == home[i] or most < similarity - 1e-9:
                    continue
                if not (plain[i] and plain[j]):
                    like = probability_jaccard((keys[mine], counts[mine]), (keys[cut[j] : cut[j + 1]], counts[cut[j] : cut[j + 1]]))
                if like >= similarity:
                    links.append((int(first[i]), int(first[j])))
                    home[home == home[j]] = home[i]
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _links_across(grouped: DataFrame, classes: DataFrame, texts: DataFrame, bands: int, places: int, width: int, similarity: float) -> DataFrame:
    """Links (a, b) between the components of buckets with several, tile by tile; a tile has TILE members and TILE_SHINGLES shingles on average."""
    sized = grouped.join(classes.select("c", "n_shingles"), "c")
    tiles = F.ceil(F.greatest(F.count("*") / TILE, F.sum("n_shingles") / TILE_SHINGLES)).cast("int")
    size = sized.groupBy("bucket").agg(tiles.alias("tiles"))
    dealt = grouped.join(size, "bucket").withColumn("t", F.pmod(F.xxhash64("c"), F.col("tiles")).cast("int"))
    copies = dealt.select("*", F.explode(F.expr("sequence(0, tiles - 1)")).alias("u")).select(
        "bucket", "band", F.least("t", "u").alias("i"), F.greatest("t", "u").alias("j"), (F.col("t") > F.col("u")).cast("int").alias("side"), "c", "component"
    )
    whole = copies.join(classes.select("c", "sign").join(texts, "c"), "c")
    return whole.groupBy("bucket", "i", "j").applyInArrow(_across(bands, places, width, similarity), "a long, b long")


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard of two (sorted keys, counts)."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    wa, wb = a[1].astype(float), b[1].astype(float)
    left, right = wa.sum() - wa[i].sum(), wb.sum() - wb[j].sum()
    x, y = wa[i], wb[j]
    ratios, which = np.unique(x / y, return_inverse=True)
    shares = np.bincount(which, x)
    # sum over all elements of max(wa, ratio * wb); only one side has the elements that aren't common
    return float(sum(s / (np.maximum(x, q * y).sum() + left + q * right) for q, s in zip(ratios, shares)))


def _verified(width: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for piece in slices(batch, "text_a", 1 << 20):
                sides = []
                for name in ("text_a", "text_b"):
                    rows, keys, counts = shingles(Words(piece.column(name)), powers, width)
                    cut = np.searchsorted(rows, np.arange(piece.num_rows + 1))
                    sides.append([(keys[s:e], counts[s:e]) for s, e in zip(cut[:-1], cut[1:])])
                like = np.array([probability_jaccard(a, b) for a, b in zip(*sides)])
                yield pa.record_batch([piece.column("a"), piece.column("b"), pa.array(like)], names=["a", "b", "similarity"]).filter(
                    pa.array(like >= similarity)
                )

    return run


def _verify(pairs: DataFrame, classes: DataFrame, texts: DataFrame, width: int, similarity: float, places: int) -> DataFrame:
    """Pairs (a, b) whose texts are similar enough; the signatures are compared first."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, places) for c in ("sign_a", "sign_b"))
            keep = (x == y).mean(1) >= similarity - MARGIN
            yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    signs = classes.select("c", "sign")
    close = (
        pairs.join(signs.select(F.col("c").alias("a"), F.col("sign").alias("sign_a")), "a")
        .join(signs.select(F.col("c").alias("b"), F.col("sign").alias("sign_b")), "b")
        .select("a", "b", "sign_a", "sign_b")
        .mapInArrow(near, "a long, b long")
    )
    return (
        close.join(texts.select(F.col("c").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("c").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(_verified(width, similarity), "a long, b long, similarity double")
        .select("a", "b")
    )


def text_key(text: str = "text"):
    """128 bits of a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")))


def near_duplicates(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    width: int = WIDTH,
    bands: int = BANDS,
    places: int = PLACES,
) -> DataFrame:
    """(doc_id, key, class_id, kept) for every row of ``docs`` (doc_id, text); ``key`` is the text's md5.

    Rows of one class are linked by chains of texts that are equal or whose
    weighted shingles are similar by at least ``similarity``; ``class_id`` is its
    smallest doc_id, ``kept`` is true for rows of that id and its smallest key (rows that are equal in both
    are all kept). Texts without words (null ones too) are linked with
    nothing but equal texts. Null ids only name a class that has no other.
    """
    n_places = bands * places
    rows = materialise(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_key().alias("key")).mapInArrow(
            _signed(width, bands, places), "doc_id long, key binary, n_shingles long, sign binary"
        ),
        "minhash-rows",
    )
    classes = materialise(
        rows.groupBy("key")
        .agg(F.min("doc_id").alias("low"), F.max("n_shingles").alias("n_shingles"), F.first("sign").alias("sign"))
        .withColumn("c", F.monotonically_increasing_id()),
        "minhash-classes",
    )
    every = classes.where("n_shingles > 0").select("c", "sign").mapInArrow(_bands(bands, places), "c long, bucket long, band int")
    shared = every.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = materialise(every.join(shared, "bucket"), "minhash-members")
    wanted = members.select("c").distinct().join(classes.select("c", "key"), "c")
    texts = materialise(
        docs.select(text_key().alias("key"), F.col("text").cast("string").alias("text"))
        .join(wanted, "key")
        .dropDuplicates(["c"])
        .select("c", "text"),
        "minhash-texts",
    )
    # The pivots are the members with the smallest hashes, by a hash each.
    least = [F.min_by("c", F.xxhash64(F.lit(k), "c")) for k in range(PIVOT_ROUNDS)]
    pivots = members.groupBy("bucket").agg(*(x.alias(f"p{k}") for k, x in enumerate(least)))
    pivots = pivots.select("bucket", F.array_distinct(F.array(*(f"p{k}" for k in range(PIVOT_ROUNDS)))).alias("pivots"))
    pairs = members.join(pivots, "bucket").select("c", F.explode("pivots").alias("pivot")).where("c <> pivot")
    pairs = pairs.select(F.least("c", "pivot").alias("a"), F.greatest("c", "pivot").alias("b")).distinct()
    links = materialise(_verify(pairs, classes, texts, width, similarity, n_places), "minhash-links")
    tree = materialise(components(links), "minhash-tree")
    found = classes.select("c", "key", "low").join(tree.withColumnRenamed("id", "c"), "c", "left")
    found = materialise(found.withColumn("component", F.coalesce("component", "c")), "minhash-found")
    grouped = members.join(found.select("c", "component"), "c")
    several = (
        grouped.groupBy("bucket")
        .agg(F.min("component").alias("x"), F.max("component").alias("y"))
        .where("x <> y")
        .select("bucket")
    )
    grouped = materialise(grouped.join(several, "bucket"), "minhash-split")
    across = materialise(_links_across(grouped, classes, texts, bands, places, width, similarity), "minhash-across")
    forget(classes, members, texts, links, tree, grouped)
    named = found.select("key", "low", "component")
    if not across.isEmpty():
        joined = components(across).select(F.col("id").alias("component"), F.col("component").alias("joined"))
        named = materialise(
            named.join(joined, "component", "left").select("key", "low", F.coalesce("joined", "component").alias("component")), "minhash-named"
        )
        forget(found)
    forget(across)
    lowest = named.groupBy("component").agg(
        F.min("low").alias("class_id"),
        F.min(F.struct(F.col("low").isNull(), F.col("low"), F.col("key"))).getField("key").alias("first_key"),
    )
    return (
        rows.select("doc_id", "key")
        .join(named.join(lowest, "component").select("key", "class_id", "first_key"), "key")
        .select(
            "doc_id",
            "key",
            "class_id",
            (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("first_key"))).alias("kept"),
        )
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay: one of each class, all columns as they were."""
    kept = near_duplicates(docs, **options).where("kept").select(F.col("doc_id").alias("__llm_id"), F.col("key").alias("__llm_key")).distinct()
    keyed = docs.withColumns({"__llm_id": F.col("doc_id").cast("long"), "__llm_key": text_key()})
    both = keyed.join(
        kept.select(F.col("__llm_id").alias("__llm_i"), F.col("__llm_key").alias("__llm_k")), F.col("__llm_id").eqNullSafe(F.col("__llm_i")) & (F.col("__llm_key") == F.col("__llm_k"))
    )
    return both.dropDuplicates(["__llm_key"]).drop("__llm_id", "__llm_key", "__llm_i", "__llm_k")
