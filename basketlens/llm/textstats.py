"""Per-document counts from whole texts, vectorised over slices of Arrow batches."""

from __future__ import annotations

import numpy as np

from basketlens.llm.common import Powers, Words, window_hashes

SYMBOLS = b"#*$%&|<>"
#: Classes of bytes that are counted: capitals, small letters, digits, marks of sentences, symbols, line ends, other white space, non-ASCII.
CLASSES = ("upper", "lower", "digit", "mark", "symbol", "line", "blank", "wide", "other")


def class_table() -> np.ndarray:
    kinds = np.full(256, CLASSES.index("other"), np.int64)
    kinds[0x80:] = CLASSES.index("wide")
    for name, members in (
        ("upper", range(0x41, 0x5B)),
        ("lower", range(0x61, 0x7B)),
        ("digit", range(0x30, 0x3A)),
        ("mark", b".,;:!?'\"()-"),
        ("symbol", SYMBOLS),
        ("line", b"\n"),
        ("blank", b" \t\r\x0b\x0c"),
    ):
        kinds[list(members)] = CLASSES.index(name)
    return kinds


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of an array between consecutive offsets."""
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def word_chars(words: Words) -> np.ndarray:
    """Code points inside words, a row."""
    counted = ~Words.BLANK[words.data] & ((words.data & 0xC0) != 0x80)
    return per_row(counted, words.offsets)


def symbols(words: Words) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(SYMBOLS)] = True
    return per_row(table[words.data], words.offsets)


def class_counts(words: Words, kinds: np.ndarray) -> np.ndarray:
    """(rows, classes) counts of bytes."""
    n = len(words.offsets) - 1
    row = np.repeat(np.arange(n), np.diff(words.offsets))
    return np.bincount(row * len(CLASSES) + kinds[words.data], minlength=n * len(CLASSES)).reshape(n, len(CLASSES))


def line_counts(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and how many of them equal an earlier one, a row."""
    lines, again = [], []
    for row in range(len(words.offsets) - 1):
        full = [x for x in words.bytes_of(row).split(b"\n") if x.strip()]
        lines.append(len(full))
        again.append(len(full) - len(set(full)))
    return np.array(lines, np.int64), np.array(again, np.int64)


def repeated(words: Words, hashes: np.ndarray, powers: Powers, width: int = 3) -> np.ndarray:
    """Words that lie in some ``width``-word window found twice or more in its row, a row."""
    rows = words.rows()
    keys = window_hashes(hashes, width, powers)
    n = len(keys)
    covered = np.zeros(len(hashes) + 1, np.int64)
    if n:
        at = np.flatnonzero(rows[:n] == rows[width - 1 :])
        order = at[np.lexsort((keys[at], rows[at]))]
        same = (keys[order[1:]] == keys[order[:-1]]) & (rows[order[1:]] == rows[order[:-1]])
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        marks = order[twice]
        np.add.at(covered, marks, 1)
        np.subtract.at(covered, np.minimum(marks + width, len(hashes)), 1)
    inside = np.cumsum(covered)[:-1] > 0
    return per_row(inside, words.first)


def distinct(words: Words, hashes: np.ndarray) -> np.ndarray:
    """Distinct words, a row."""
    rows = words.rows()
    order = np.lexsort((hashes, rows))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order[1:]] != hashes[order[:-1]]) | (rows[order[1:]] != rows[order[:-1]])
    return np.bincount(rows[order[new]], minlength=len(words.first) - 1)
