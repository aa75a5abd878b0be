"""Repeated passages by recompression.

Words are named by content hashes, so names agree on all tasks without an
exchange. Recompression rounds then name runs of one symbol and pairs of
neighbours; which pairs merge depends on the two symbols alone, so equal
passages get equal symbols except near their ends, by at most ``reach`` words.
Of the symbols that lie ``reach`` words inside a window, the one with the
smallest hash stands for the window (an anchor, with the words around it in
its name): two equal windows have equal anchors at the same place.

Spark counts anchors over all documents, then, of anchors that occur more than
once, their surroundings (all windows that an anchor stands for): where these
are equal too, all of the windows are repeats. Only where surroundings of an
anchor differ, windows are spelt out, once for each kind of surroundings, as
128-bit names, and counted in turn. The words under a window that occurs more
than once go. Surroundings and the second half of a window's name are built on
other hashes of the words than anchors and its first half, so what one hash
took for equal another one verifies. Windows inside long runs have no anchor and are always spelt out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import Powers, Words, mix, slices, window_hashes
from basketlens.session import materialise

WINDOW = 35
#: Pair rounds; a symbol holds at most 2**LEVELS words unless it is a run.
LEVELS = 2

_BASE_2 = 0xD1342543DE82EF95
#: Stands for the name of texts with windows that have no anchor.
FREE = np.uint64(0x0F2EE0F2EE0F2EE)


def reach(levels: int = LEVELS) -> int:
    """Words at either end of a passage whose symbols may depend on what lies outside.

    A run at the edge takes one word in; then each pair round may take the
    outermost whole symbol (2**r words before round r), and each run of pairs
    another one of the doubled size.
    """
    return 1 + sum((1 << r) + ((1 << (r + 1)) if r < levels - 1 else 0) for r in range(levels))


def recompress(names: np.ndarray, rows: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbol, first word, is a run) after run and pair rounds over words of several rows."""
    at = np.arange(len(names))
    symbol, frozen = names, np.zeros(len(names), bool)
    for level in range(levels):
        # Runs: neighbours of one name become one symbol that does not depend on their number.
        if len(symbol) > 1:
            same = (symbol[1:] == symbol[:-1]) & (rows[at[1:]] == rows[at[:-1]]) & ~frozen[1:] & ~frozen[:-1]
            head = np.concatenate([[True], ~same])
            run = np.concatenate([same, [False]]) & head
            symbol = np.where(run, mix(symbol + np.uint64(0x52D1 + level)), symbol)[head]
            frozen, at = (frozen | run)[head], at[head]
        # Pairs: a symbol's side in this round is a bit of its hash, so no symbol is wanted by two neighbours.
        if len(symbol) > 1:
            side = mix(symbol ^ np.uint64(0xA5A5 + level)) >> np.uint64(63)
            merge = (
                (side[:-1] == 0) & (side[1:] == 1) & ~frozen[:-1] & ~frozen[1:] & (rows[at[1:]] == rows[at[:-1]])
            )
            left = np.concatenate([merge, [False]])
            symbol = np.where(left, mix(symbol * np.uint64(3) + np.roll(symbol, -1) + np.uint64(0x9A17 + level)), symbol)
            stay = ~np.concatenate([[False], merge])
            symbol, frozen, at = symbol[stay], frozen[stay], at[stay]
    return symbol, at, frozen


def anchors(names: np.ndarray, rows: np.ndarray, ends: np.ndarray, window: int, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """(window start, anchor word or -1) of every window that fits its row; ``ends`` has the end of each word's row."""
    n = len(names)
    symbol, at, frozen = recompress(names, rows, levels)
    rank = np.full(n, np.iinfo(np.uint64).max)
    rank[at[~frozen]] = mix(symbol[~frozen] ^ np.uint64(0x0DDBA11)) >> np.uint64(1)
    place = np.arange(n, dtype=np.int32)
    first, span = reach(levels), window - 2 * reach(levels) - (1 << levels) + 1
    # Leftmost smallest rank of ``span`` words from each word on, by doubling.
    best, where, width = rank, place, 1
    while width < span:
        step = min(width, span - width)
        other, there = best[step:], where[step:]
        better = other < best[: len(other)]
        best = np.concatenate([np.where(better, other, best[: len(other)]), best[len(other) :]])
        where = np.concatenate([np.where(better, there, where[: len(there)]), where[len(there) :]])
        width += step
    start = np.flatnonzero(place + window <= ends)
    chosen = where[start + first].astype(np.int64)
    chosen[best[start + first] == np.iinfo(np.uint64).max] = -1
    return start, chosen


class _Rows:
    """Hashes, row limits and anchors of a slice of texts."""

    def __init__(self, column: pa.Array, powers: Powers, window: int, levels: int):
        self.words = Words(column)
        self.names = self.words.hashes()
        self.rows = self.words.rows()
        self.ends = self.words.first[1:][self.rows]
        self.start, self.anchor = anchors(self.names, self.rows, self.ends, window, levels)

    def around(self, at: np.ndarray, powers: Powers, levels: int) -> np.ndarray:
        """Names of anchors: the words from ``reach`` before to ``reach + 2**levels`` behind."""
        r = reach(levels)
        return powers.spans(self.names, at - r, at + r + (1 << levels))


def _find(window: int, levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, second = Powers(), Powers(_BASE_2)
        for batch in batches:
            for piece in slices(batch, "text"):
                x = _Rows(piece.column("text"), powers, window, levels)
                has = x.anchor >= 0
                # The windows of an anchor are neighbours.
                at, first, n = np.unique(x.anchor[has], return_index=True, return_counts=True)
                start = x.start[has][first]
                near = second.spans(x.words.hashes(1), start, start + n - 1 + window)
                near = mix(near + mix((at - start).astype(np.uint64)))
                free = np.unique(x.rows[x.start[~has]])
                row = np.concatenate([x.rows[at], free])
                take, none = pa.array(row), np.zeros(len(free), np.uint64)
                yield pa.record_batch(
                    [
                        piece.column("doc_id").take(take),
                        piece.column("__llm_h").take(take),
                        pa.array(np.concatenate([at - x.words.first[row[: len(at)]], np.full(len(free), -1)]).astype(np.int32)),
                        pa.array(np.concatenate([at - start, none]).astype(np.int32)),
                        pa.array(np.concatenate([n, none]).astype(np.int32)),
                        pa.array(np.concatenate([x.around(at, powers, levels), none + FREE]).view(np.int64)),
                        pa.array(np.concatenate([near, none]).view(np.int64)),
                    ],
                    names=["doc_id", "h", "at", "back", "n", "name", "near"],
                )

    return run


def _spell(window: int, levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, second = Powers(), Powers(_BASE_2)
        for batch in batches:
            for piece in slices(batch, "text", 1 << 20):
                x = _Rows(piece.column("text"), powers, window, levels)
                weight = np.zeros(len(x.names) + 1, np.int32)
                lists = piece.column("places")
                row = np.repeat(np.arange(piece.num_rows), np.diff(lists.offsets.to_numpy()))
                asked = lists.flatten()
                place = asked.field("at").to_numpy().astype(np.int64)
                real = place >= 0
                weight[x.words.first[row[real]] + place[real]] = asked.field("weight").to_numpy()[real]
                weight = np.where(x.anchor < 0, 1, weight[x.anchor])
                chosen = x.start[weight > 0]
                one = window_hashes(x.names, window, powers)[chosen]
                two = window_hashes(x.words.hashes(1), window, second)[chosen]
                row = x.rows[chosen]
                take = pa.array(row)
                yield pa.record_batch(
                    [
                        piece.column("doc_id").take(take),
                        piece.column("__llm_h").take(take),
                        pa.array((chosen - x.words.first[row]).astype(np.int32)),
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                        pa.array(weight[weight > 0].astype(np.int32)),
                    ],
                    names=["doc_id", "h", "start", "one", "two", "weight"],
                )

    return run


def repeats(docs: DataFrame, window: int = WINDOW, levels: int = LEVELS) -> DataFrame:
    """``docs`` (doc_id, text and others) with __llm_starts: (start, n) of neighbouring windows that occur more than once; null if none.

    Every row counts, so the windows of equal rows are repeats of each other.
    Texts of under ``window`` words, empty and null ones have no window.
    """
    if window - 2 * reach(levels) < 1 << levels:
        raise ValueError("the window is too short for so many levels")
    spark = docs.sparkSession
    # Rows are known by their id and a hash of their text; rows that share both are equal, and so are their results.
    whole = docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")}).withColumn(
        "__llm_h", F.xxhash64("text")
    )
    found = whole.select("doc_id", "text", "__llm_h").mapInArrow(
        _find(window, levels), "doc_id long, h long, at int, back int, n int, name long, near long"
    )
    many = found.groupBy("name").agg(F.count("*").alias("k")).where("k > 1").select("name")
    free = spark.range(1).select(F.lit(int(np.uint64(FREE).view(np.int64))).alias("name"))
    shared = materialise(found.join(many.unionByName(free).distinct(), "name", "left_semi"), "anchors")
    # Anchors with equal surroundings: all their windows are repeats.
    around = materialise(
        shared.where("at >= 0")
        .groupBy("name", "near")
        .agg(F.count("*").alias("k"), F.min(F.struct("doc_id", "h", "at")).alias("one")),
        "surroundings",
    )
    # Where an anchor's surroundings differ, the windows of each kind are spelt out once; kinds of several places weigh more.
    mixed = around.where("k = 1").select("name").distinct()
    asked = around.join(mixed, "name", "left_semi").select("one.*", F.least("k", F.lit(2)).cast("int").alias("weight"))
    free = shared.where("at < 0").select("doc_id", "h", "at", F.lit(1).alias("weight")).distinct()
    places = (
        asked.unionByName(free)
        .groupBy("doc_id", "h")
        .agg(F.collect_list(F.struct("at", "weight")).alias("places"))
        .select(F.col("doc_id").alias("__llm_i"), F.col("h").alias("__llm_g"), "places")
    )
    same = F.col("doc_id").eqNullSafe(F.col("__llm_i")) & (F.col("__llm_h") == F.col("__llm_g"))
    spelt = (
        whole.join(places, same)
        .select("doc_id", "__llm_h", "text", "places")
        .mapInArrow(_spell(window, levels), "doc_id long, h long, start int, one long, two long, weight int")
    )
    twice = spelt.groupBy("one", "two").agg(F.sum("weight").alias("k")).where("k > 1").select("one", "two")
    several = around.where("k > 1").select("name", "near")
    starts = (
        spelt.join(twice, ["one", "two"], "left_semi")
        .select("doc_id", "h", "start", F.lit(1).alias("n"))
        .unionByName(shared.join(several, ["name", "near"], "left_semi").select("doc_id", "h", (F.col("at") - F.col("back")).alias("start"), "n"))
        .groupBy("doc_id", "h")
        .agg(F.collect_set(F.struct("start", "n")).alias("__llm_starts"))
        .select(F.col("doc_id").alias("__llm_i"), F.col("h").alias("__llm_g"), "__llm_starts")
    )
    return whole.join(starts, same, "left").drop("__llm_h", "__llm_i", "__llm_g")


def _cut(window: int):
    def cut(text: pa.Scalar, starts: pa.Scalar) -> tuple[int, int, bytes]:
        """Number of words, of words that go, and the words that stay joined by a blank."""
        words = (text.as_py() or "").encode().split()
        n = len(words)
        if starts.is_valid and n:
            at = starts.values.field("start").to_numpy()
            cover = np.zeros(n + 1, np.int64)
            np.add.at(cover, at, 1)
            np.subtract.at(cover, np.minimum(at + starts.values.field("n").to_numpy() - 1 + window, n), 1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(cover[:n]) == 0).tolist()]
        return n, n - len(words), b" ".join(words)

    return cut


def remove_repeats(docs: DataFrame, window: int = WINDOW, levels: int = LEVELS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): ``kept`` are the words that stay, joined by a blank."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = _cut(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", 1 << 23):
                n, gone, kept = zip(*map(cut, piece.column("text"), piece.column("__llm_starts")))
                yield pa.record_batch(
                    [piece.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept"],
                )

    return repeats(own, window, levels).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def digest(removed: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256)."""
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def clean(docs: DataFrame, window: int = WINDOW, levels: int = LEVELS) -> DataFrame:
    """``docs`` (doc_id, text, others as they are) with the words that stay; texts that lose nothing are unchanged.

    A column ``n_chars`` follows the text.
    """
    cut, schema = _cut(window), docs.schema
    counts = "n_chars" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", 1 << 23):
                texts, starts = piece.column("text"), piece.column("__llm_starts")
                new = [cut(t, s)[2].decode() if s.is_valid else t.as_py() for t, s in zip(texts, starts)]
                columns = dict(zip(piece.schema.names[:-1], piece.columns[:-1]))
                columns["text"] = pa.array(new, texts.type)
                if counts:
                    old = columns["n_chars"]
                    sizes = [len(t) if s.is_valid else c for t, s, c in zip(new, starts, old.to_pylist())]
                    columns["n_chars"] = pa.array(sizes, old.type)
                yield pa.record_batch(list(columns.values()), names=list(columns))

    return repeats(docs, window, levels).mapInArrow(run, schema)
