"""Byte-level BPE: every distinct pre-token is encoded once, wherever it occurs.

1. Blocks of documents are cut into pre-tokens. A block keeps the sequence of
   each document as numbers into the block's own list of distinct pre-tokens;
   sequence and list leave the block separately.
2. The lists are shuffled by pre-token. One task sees all blocks' entries of a
   pre-token in a row (sorted), runs the merges once and answers every entry.
   An entry is one (block, pre-token), so that even a word of every document
   has no more rows than there are blocks.
3. Answers go back to their block, where the sequences are turned into ids by
   position. Decoding looks ids up in the table of token bytes.

Sequences never meet the pre-tokens' shuffle, and nothing is gathered per word.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.session import materialise

#: A block ends once it holds so many characters; one document is never cut.
BLOCK_CHARS = 16_000_000

#: White space of the splitting pattern (the Unicode property, which lacks 0x1C to 0x1F).
_BLANK = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: No match of the pattern crosses the borders of these runs, except that a blank may lead a run.
_RUN = f" ?[^{_BLANK}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+"

#: Fixed parts of the public splitting pattern: words, and marks, are pre-tokens of their own, with a blank before them.
_WORDS, _MARKS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+|", r"| ?[^\s\p{L}\p{N}]+|"


class _Stacked(Exception):
    """A blank follows white space, or may: the text can't be cut at blanks."""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _own_pattern(pattern: str) -> str:
    """The pattern with white space spelt out, since engines differ on control characters."""
    return pattern.replace(r"[^\s", f"[^{_BLANK}").replace(r"(?!\S)", f"(?![^{_BLANK}])").replace(r"\s", f"[{_BLANK}]")


class Runs(dict):
    """Blank-free piece -> numbers of the pre-tokens of a blank and that piece; split on first use."""

    def __init__(self, pattern: str):
        import regex

        self.pieces = regex.compile(_own_pattern(pattern)).findall
        self.whole = re.compile(_RUN).findall
        self.plain = pattern.startswith(_WORDS) and _MARKS in pattern
        self.entries: dict[str, int] = {}
        self.first: dict[str, tuple[int, ...]] = {}

    @staticmethod
    def letters(word: str) -> bool:
        """Latin letters only, on which all engines agree."""
        return word.isalpha() and (word.isascii() or max(word) < "\u0250")

    def number(self, text: str) -> tuple[int, ...]:
        entries = self.entries
        if self.plain:  # a word, or a word and a mark, needs no pattern
            word = text[1:] if text[:1] == " " else text
            if self.letters(word):
                return (entries.setdefault(text, len(entries)),)
            if word[-1:] in ".,;:!?" and self.letters(word[:-1]):
                first = entries.setdefault(text[:-1], len(entries))
                return first, entries.setdefault(word[-1], len(entries))
        return tuple([entries.setdefault(w, len(entries)) for w in self.pieces(text)])

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if not piece or piece[-1] in _BLANK:  # so that no such piece is ever known
            raise _Stacked
        if self.plain and piece.isascii() and piece.isalpha():  # most are
            found = self[piece] = (self.entries.setdefault(" " + piece, len(self.entries)),)
        else:
            found = self[piece] = self.number(" " + piece)
        return found

    def numbers(self, text: str) -> np.ndarray:
        """The text's pre-tokens as numbers.

        Unless white space stands before a blank (or a blank at the end), no
        match crosses a blank's left side, so texts are cut at blanks.
        """
        return np.fromiter(chain.from_iterable(self.found(text)), np.int32)

    def found(self, text: str) -> Iterator[tuple[int, ...]]:
        try:
            head, rest = self.parted(text)
            return chain((self.number(head),), list(map(self.__getitem__, rest)))
        except _Stacked:
            return self.runs(text)

    def parted(self, text: str) -> tuple[str, list[str]]:
        head, *rest = text.split(" ")
        if rest and head and head[-1] in _BLANK:
            raise _Stacked
        return head, rest

    def runs(self, text: str) -> Iterator[tuple[int, ...]]:
        return iter([self.first.get(r) or self.first.setdefault(r, self.number(r)) for r in self.whole(text)])

    def learn(self, text: str) -> None:
        """Numbers the text's pre-tokens, in the same order."""
        try:
            head, rest = self.parted(text)
            self.number(head)
            deque(map(self.__getitem__, filterfalse(self.__contains__, rest)), maxlen=0)
        except _Stacked:
            self.runs(text)

    def forget(self) -> None:
        self.clear(), self.first.clear(), self.entries.clear()


def _packed(values: np.ndarray) -> bytes:
    """Compressed array: values of under 65,536 as two bytes, else four."""
    kind = np.uint16 if not len(values) or values.max() < 1 << 16 else np.uint32
    raw = values.astype(kind)
    planes = np.frombuffer(raw.tobytes(), np.uint8).reshape(-1, raw.itemsize).T.tobytes()
    return bytes([raw.itemsize]) + zstandard.ZstdCompressor(level=3).compress(planes)


def _unpacked(blob: bytes) -> np.ndarray:
    width = blob[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), np.uint8)
    return planes.reshape(width, -1).T.copy().view(np.uint16 if width == 2 else np.uint32).ravel()


def _blocks(pattern: str, block_chars: int, sequences: bool):
    """Documents -> the sequences (block, doc_id, sequence) or the pre-tokens (block, entry, word) of each block.

    Pre-tokens are numbered in order of appearance in both.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        runs = Runs(pattern)
        part, blocks, size = TaskContext.get().partitionId(), 0, 0
        rows: list[tuple[int | None, bytes]] = []

        def flush():
            nonlocal size, blocks
            block = (part << 32) | blocks
            if sequences:
                for at in range(0, len(rows), 1000):
                    ids, packed = zip(*rows[at : at + 1000])
                    yield pa.record_batch(
                        [pa.array(np.full(len(ids), block)), pa.array(ids, pa.int64()), pa.array(packed, pa.binary())],
                        names=["block", "doc_id", "sequence"],
                    )
            else:
                words = pa.array(list(runs.entries), pa.large_string())
                order = pc.sort_indices(words)  # neighbours share beginnings, which compresses
                for at in range(0, len(words), 50_000):
                    entry = order.slice(at, 50_000)
                    yield pa.record_batch(
                        [pa.array(np.full(len(entry), block)), entry.cast(pa.int32()), words.take(entry).cast(pa.binary())],
                        names=["block", "entry", "word"],
                    )
            runs.forget(), rows.clear()
            blocks, size = blocks + 1, 0

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                if sequences:
                    rows.append((doc_id, _packed(runs.numbers(text))))
                else:
                    runs.learn(text)
                size += len(text) + 64
                if size >= block_chars:
                    yield from flush()
        yield from flush()

    return run


def _answer(path: str, pattern: str):
    """Entries sorted by pre-token -> (block, packed numbers, packed lengths, packed ids), many entries a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})._core_bpe.encode_single_piece
        held: list[tuple[np.ndarray, ...]] = []

        def flush():
            block, entry, size, flat = (np.concatenate(x) for x in zip(*held))
            held.clear()
            starts = np.cumsum(size) - size
            by_block = np.argsort(block, kind="stable")
            block, entry, size = block[by_block], entry[by_block], size[by_block]
            flat = flat[_places(starts[by_block], size)]
            cuts = np.flatnonzero(np.diff(block, prepend=block[:1] - 1))
            ends = np.append(0, np.cumsum(size))
            parts = list(zip(cuts.tolist(), np.append(cuts[1:], len(block)).tolist()))
            yield pa.record_batch(
                [
                    pa.array(block[cuts]),
                    pa.array([_packed(entry[i:j]) for i, j in parts], pa.binary()),
                    pa.array([_packed(size[i:j]) for i, j in parts], pa.binary()),
                    pa.array([_packed(flat[ends[i] : ends[j]]) for i, j in parts], pa.binary()),
                ],
                names=["block", "entries", "lengths", "ids"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column(2).dictionary_encode()
            ids = list(map(encode, words.dictionary.to_pylist()))
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            known, which = np.fromiter(chain.from_iterable(ids), np.int64), words.indices.to_numpy()
            at = _places((np.cumsum(sizes) - sizes)[which], sizes[which])
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64), sizes[which], known[at]))
            if sum(len(x[0]) for x in held) >= 200_000:
                yield from flush()
        if held:
            yield from flush()

    return run


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, run after run."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers of a block, then its sequences (sorted so) -> (doc_id, ids as little-endian 32-bit numbers)."""
    block, answers, lengths, starts, flat = None, [], None, None, None
    for batch in batches:
        docs, ids = [], []
        for row in zip(*(batch.column(i) for i in range(6))):
            here, doc_id, sequence, entries, sizes, tokens = (x.as_py() for x in row)
            if here != block:
                block, answers, lengths = here, [], None
            if sequence is None:
                answers.append((entries, sizes, tokens))
                continue
            if lengths is None:
                parts = [tuple(_unpacked(x).astype(np.int64) for x in a) for a in answers]
                entry, size, flat = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(3))
                lengths, starts = np.zeros(len(entry), np.int64), np.zeros(len(entry), np.int64)
                lengths[entry] = size
                starts[entry] = np.cumsum(size) - size
                answers = []
            number = _unpacked(sequence).astype(np.int64)
            docs.append(doc_id)
            ids.append(flat[_places(starts[number], lengths[number])].astype("<u4").tobytes())
        if docs:
            yield pa.record_batch([pa.array(docs, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "ids"])


def encode(docs: DataFrame, path: str, pattern: str, block_chars: int = BLOCK_CHARS, scan: bool = False, follow: tuple[Callable, str] | None = None) -> DataFrame:
    """(doc_id, ids) for every row of ``docs`` (doc_id, text); ids are packed little-endian unsigned 32-bit numbers.

    Null and empty texts have no ids. Rows with the same or a null doc_id keep a
    row each. Other columns are not read. A block must fit a task: it holds
    ``block_chars`` characters or a single longer document.

    Both kinds of rows of step 1 come from a reading of their own, so the rows
    must come in the same order each time. ``scan`` says that ``docs`` is a plain
    scan of files, which does; other inputs are first written to the shared folder.
    ``follow`` (function on Arrow batches, result schema) is applied to the rows in
    the same pass, which saves a Python process a task.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    if not scan:
        docs = materialise(docs, "bpe-texts")
    words = (
        docs.mapInArrow(_blocks(pattern, block_chars, False), "block long, entry int, word binary")
        .repartition("word")
        .sortWithinPartitions("word")
        .mapInArrow(_answer(path, pattern), "block long, entries binary, lengths binary, ids binary")
    )
    empty = F.lit(None).cast("binary")
    sequences = docs.mapInArrow(_blocks(pattern, block_chars, True), "block long, doc_id long, sequence binary").select(
        "block", "doc_id", "sequence", empty.alias("entries"), empty.alias("lengths"), empty.alias("ids")
    )
    answers = words.select("block", F.lit(None).cast("long").alias("doc_id"), empty.alias("sequence"), "entries", "lengths", "ids")
    return (
        sequences.unionByName(answers)
        .repartition("block")
        .sortWithinPartitions(F.col("block"), F.col("sequence").isNotNull())
        .mapInArrow(*((_assemble, "doc_id long, ids binary") if follow is None else (_after(follow[0]), follow[1])))
    )


def _after(then: Callable) -> Callable:
    return lambda batches: then(_assemble(batches))


def decoder(path: str) -> Callable:
    """Batches (doc_id, ids) -> (doc_id, ids, bytes), by the table of token bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(path)
        tokens = np.full(1 + max(ranks.values()), None, object)  # an id without a token fails
        tokens[list(ranks.values())] = list(ranks)
        for batch in batches:
            text = [b"".join(tokens[np.frombuffer(ids, "<u4")].tolist()) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(text, pa.binary())], names=["doc_id", "ids", "bytes"])

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text bytes as ``bytes``) of ``encode``'s rows; the token-byte table is fixed, some 50,000 rows."""
    return encoded.select("doc_id", "ids").mapInArrow(decoder(path), "doc_id long, ids binary, bytes binary")


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(path: str) -> Callable:
    """Batches (doc_id, ids) -> DIGEST rows of the ids and of what they decode to."""
    decoded = decoder(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.char.add(" ", np.arange(1 + max(read_ranks(path).values())).astype(str)).astype("S")  # of one width, filled up by NUL
        for batch in decoded(batches):
            counts, shas = [], []
            for ids in batch.column(1).to_pylist():
                numbers = np.frombuffer(ids, "<u4")
                counts.append(len(numbers))
                shas.append(hashlib.sha256(names[numbers].tobytes().translate(None, b"\0")[1:]).hexdigest())
            texts = [hashlib.sha256(t).hexdigest() for t in batch.column(2).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(shas), pa.array(texts)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run
