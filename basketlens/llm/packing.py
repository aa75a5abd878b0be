"""Best-fit packing of token sequences, certified by lower bounds.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt over
parts of bounded size; each part is packed by best-fit decreasing and compares
its number of sequences with the largest of a family of dual-feasible-function
bounds. A part at its bound is optimal and rests. Parts with a gap give up
the pieces of their loose sequences, those are dealt anew over fewer parts,
and packed again, until the whole meets the bound of all pieces, or one last
part has packed what was left.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import rounded_up
from basketlens.session import materialise

CAPACITY = 4096
#: Pieces that one task packs at once.
PART_PIECES = 100_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: White space of Unicode besides what str.split also takes for white space, handled by the tokenizer itself.
_ODD = "\x1c\x1d\x1e\x1f"


class Chunks(dict):
    """White-space-free chunk -> its packed ids.

    For tokenizers that split at white space, so that chunks don't influence each
    other. A chunk is normalised, pre-split and merged by the tokenizer's own
    parts; plain words are remembered apart from their case and end mark. Memory
    is bounded: a full generation of entries becomes the older one, from which
    entries in use are taken over, and the one before it is dropped.
    """

    LIMIT = 150_000
    ENDS = ".,!?;:"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.marks = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.merge = self.tokenizer.model.tokenize
        self.older: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}
        # The pre-tokenizer's character for each byte of a letter of several bytes.
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        latin = map(chr, range(0x80, 0x250))
        self.spelt = {ord(c): split(c)[0][0] for c in latin if c.isalpha()}

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def parts(self, chunk: str) -> bytes:
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(chunk))
        return array("I", [t.id for part, _ in split for t in self.merge(part)]).tobytes()

    @staticmethod
    def plain(word: str) -> bool:
        """Composed Latin letters only: one part of the pre-tokenizer, lowered letter by letter."""
        return word.isalpha() and (word.isascii() or (max(word) < "\u0250" and is_normalized("NFC", word)))

    def word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            found = self.older_words.get(word)
            if found is None:
                if word.isascii() and word.isalpha():
                    found = array("I", [t.id for t in self.merge(word)]).tobytes()
                elif self.plain(word):
                    found = array("I", [t.id for t in self.merge(word.translate(self.spelt))]).tobytes()
                else:
                    found = self.parts(word)
            if len(self.words) >= self.LIMIT:
                self.older_words, self.words = self.words, {}
            self.words[word] = found
        return found

    def __missing__(self, chunk: str) -> bytes:
        found = self.older.get(chunk)
        if found is None:
            core = chunk if chunk.isalpha() else chunk.rstrip(self.ENDS)
            low = core.lower()
            if core.isalpha() and (core.isascii() or (self.plain(core) and self.plain(low))):
                found = self.word(low)
                if len(core) < len(chunk):
                    found += self.word(chunk[len(core) :])
            else:
                found = self.word(chunk.lower()) if chunk.isascii() else self.parts(chunk)
        if len(self) >= self.LIMIT:
            self.older = dict(self)
            self.clear()
        self[chunk] = found
        return found

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text; texts that spell an added token, or hold odd control characters, are encoded in one go."""
        if any(m in text for m in self.marks) or any(c in text for c in _ODD):
            return np.array(self.whole(text), "<u4")
        return np.frombuffer(b"".join(map(self.__getitem__, text.split())), "<u4")


def _pieces(path: str, capacity: int, end: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks(path)
        last = np.array([end], "<u4")
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.concatenate([chunks.ids(text.as_py() or ""), last])
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    raw = part.tobytes()
                    out.append((doc_id, piece, start, len(part), zlib.crc32(raw), raw if with_ids else None))
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            n = 6 if with_ids else 5
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns[:n], kinds)], names=names[:n])

    return run


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = 1, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of ``docs`` (doc_id, text).

    A document's ids end with ``end``; null and empty texts are that id alone.
    Only documents over ``capacity`` are cut, at its multiples. Rows with equal
    or null doc_id keep pieces of their own.
    """
    schema = PIECES + (", ids binary" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _pieces(path, capacity, end, with_ids), schema
    )


def dual_feasible(lengths: np.ndarray, capacity: int) -> int:
    """The best of a family of lower bounds on the number of bins.

    Each function maps lengths so that what fits one bin sums to at most one:
    the identity; for a threshold t, lengths over capacity - t count whole, those
    under t nothing; and rounding down to multiples of capacity/k for lengths that
    are no multiple of capacity/(k+1).
    """
    if not len(lengths):
        return 0
    sizes, counts = np.unique(lengths, return_counts=True)
    counts = counts.astype(object)  # exact sums
    best = -(-int((sizes.astype(object) * counts).sum()) // capacity)
    for t in sizes[sizes * 2 <= capacity]:
        big, small = sizes > capacity - t, sizes < t
        middle = ~big & ~small
        total = int(counts[big].sum()) * capacity + int((sizes[middle].astype(object) * counts[middle]).sum())
        best = max(best, -(-total // capacity))
    for k in range(1, 21):
        scaled = sizes.astype(object) * (k + 1)
        value = np.where(scaled % capacity == 0, sizes.astype(object) * k, scaled // capacity * capacity)
        best = max(best, -(-int((value * counts).sum()) // (capacity * k)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each length by best-fit decreasing (ties in the given order)."""
    bins = np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, opened = 0, 0  # bit r of rooms: some bin has r tokens left
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            target = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, target = capacity, opened
            opened += 1
        bins[i] = target
        left = room - size
        if left:
            if not by_room[left]:
                rooms |= 1 << left
            by_room[left].append(target)
    return bins


def _pack(capacity: int, last: bool):
    """One part -> its rows with ``sequence`` and ``position``, and whether they rest.

    With a gap to the bound, the loosest sequences are given up: as many as
    together have twice the room that closing the gap would take.
    """

    def run(group: pa.Table) -> pa.Table:
        order = np.lexsort(
            (
                group["tie"].to_numpy(),
                group["piece"].to_numpy(),
                group["doc_id"].fill_null(-(1 << 63)).to_numpy(),
                -group["length"].to_numpy(),
            )
        )
        group = group.take(pa.array(order))
        lengths = group["length"].to_numpy()
        bins = best_fit(lengths, capacity)
        used = np.bincount(bins, weights=lengths).astype(np.int64) if len(bins) else np.zeros(0, np.int64)
        rests = np.ones(len(used), bool)
        gap = len(used) - dual_feasible(lengths, capacity)
        if not last and gap > 0:
            loosest = np.argsort(used, kind="stable")
            room = np.cumsum(capacity - used[loosest])
            rests[loosest[: 1 + np.searchsorted(room, 2 * gap * capacity)]] = False
        by_bin = np.lexsort((np.arange(len(bins)), bins))
        position = np.empty(len(bins), np.int64)
        sums = np.cumsum(lengths[by_bin]) - lengths[by_bin]
        first = np.searchsorted(bins[by_bin], np.arange(len(used)))
        position[by_bin] = sums - sums[first][bins[by_bin]] if len(bins) else sums
        return pa.table(
            {
                **{c: group[c] for c in group.column_names},
                "bin": pa.array(bins),
                "offset": pa.array(position),
                "rests": pa.array(rests[bins]),
            }
        )

    return run


def pack(items: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES, rounds: int = 6) -> DataFrame:
    """``items`` (PIECES and any other columns) with ``sequence_id`` and ``offset``.

    Sequences hold at most ``capacity`` tokens without gaps. Full pieces are a
    sequence each. A round has about a fourth as many parts as the one before;
    the last has one part of at most ``part_pieces`` pieces, or, when more are left
    after ``rounds``, keeps its parts. No pieces: no rows.
    """
    extra = [c for c in items.columns if c not in ("part", "bin", "offset", "rests", "tie", "sequence_id")]
    # A number of its own for each row deals equal rows over all parts.
    items = materialise(items.select(*extra, F.monotonically_increasing_id().alias("tie")), "pieces")
    full = items.where(F.col("length") >= capacity)
    rest = items.where(F.col("length") < capacity)
    finished = [
        full.select(*extra, F.lit(0).cast("long").alias("offset"), F.col("tie").alias("sequence_id"))
    ]
    n = rest.count()
    parts = rounded_up(n, part_pieces)
    for k in range(rounds if n else 0):
        last = parts == 1 or k == rounds - 1
        dealt = rest.withColumn("part", F.pmod(F.xxhash64(F.lit(k), "tie"), F.lit(parts)).cast("long"))
        types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields)
        packed = materialise(
            dealt.groupBy("part").applyInArrow(_pack(capacity, last), f"{types}, bin long, offset long, rests boolean"), "packed"
        )
        # Negative ids: round, part and bin, apart from the full pieces' ids, which are not negative.
        name = -1 - (F.lit(k).cast("long") * (1 << 59) + F.col("part") * (1 << 24) + F.col("bin"))
        finished.append(packed.where("rests").select(*extra, "offset", name.alias("sequence_id")))
        if last:
            break
        rest = packed.where("NOT rests").select(*extra, "tie")
        n = rest.count()
        if not n:
            break
        parts = max(parts // 4, rounded_up(n, part_pieces))
    out = finished[0]
    for frame in finished[1:]:
        out = out.unionByName(frame)
    return out


def assemble(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids array<bigint>, doc_ids, starts) of ``pack``'s rows that carry ``ids``; a sequence has ``capacity`` ids at most."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("offset")
        ids = np.frombuffer(b"".join(group["ids"].to_pylist()), "<u4").astype(np.int64)
        return pa.table(
            {
                "sequence_id": group["sequence_id"].slice(0, 1),
                "ids": pa.array([ids], pa.list_(pa.int64())),
                "doc_ids": pa.array([group["doc_id"].to_pylist()], pa.list_(pa.int64())),
                "starts": pa.array([group["offset"].to_pylist()], pa.list_(pa.int64())),
            }
        )

    return (
        packed.select("sequence_id", "offset", "doc_id", "ids")
        .groupBy("sequence_id")
        .applyInArrow(run, "sequence_id long, ids array<bigint>, doc_ids array<bigint>, starts array<bigint>")
    )
