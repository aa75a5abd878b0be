"""Licence scan by a generalised suffix automaton over licence tokens.

One automaton holds all templates and phrases (some hundred tokens, fixed).
A text's tokens are streamed through it; each step yields the length of the
longest suffix of what was read that occurs in a template (a matching
statistic). Phrases are found where a statistic is long enough and its state
lies below the phrase's state in the suffix-link tree. Long matches are chained
in template order into spans, and a span that covers enough of its template is
a licence notice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Openings of public licence notices, by label.
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files the software to deal in the software without restriction including without limitation the rights"
    " to use copy modify merge publish distribute sublicense and or sell copies of the software",
    "apache": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with"
    " the license you may obtain a copy of the license at http www apache org licenses license 2 0",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public"
    " license as published by the free software foundation either version 3 of the license or at your option any later version",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the"
    " following conditions are met redistributions of source code must retain the above copyright notice this list of"
    " conditions and the following disclaimer",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"
    " provided that the above copyright notice and this permission notice appear in all copies",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not"
    " distributed with this file you can obtain one at",
    "unlicense": "this is free and unencumbered software released into the public domain anyone is free to copy modify publish"
    " use compile sell or distribute this software",
}

#: Tokens of a match that may enter a chain, tokens between two of its matches, covered share of a notice.
MIN_MATCH, MAX_GAP, MIN_COVER = 4, 12, 0.6

_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)


def tokens(raw: bytes) -> list[bytes]:
    """Words of digits, letters and bytes over 0x7F, A to Z lower-cased."""
    return raw.translate(_TABLE).split()


class Automaton:
    """Suffix automaton of several token sequences."""

    def __init__(self, sequences: list[list[bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: End positions of a state's strings: state -> {sequence: [ends]}.
        self.ends: list[dict[int, list[int]]] = [{}]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, token in enumerate(sequence):
                last = self._extend(last, self.vocabulary.setdefault(token, len(self.vocabulary)))
                self.ends[last].setdefault(number, []).append(at + 1)
        for state in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            above = self.link[state]
            if above > 0:
                for number, found in self.ends[state].items():
                    self.ends[above].setdefault(number, []).extend(found)
        self.ends = [{n: sorted(set(x)) for n, x in e.items()} for e in self.ends]

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(moves)
        self.ends.append({})
        return len(self.length) - 1

    def _clone(self, p: int, q: int, c: int) -> int:
        twin = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = twin
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        return twin

    def _extend(self, last: int, c: int) -> int:
        """The state of the longest string after reading c; an edge that another sequence made is used again."""
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, c)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, c)
        return new

    def walk(self, sequence: list[bytes]) -> int:
        state = 0
        for token in sequence:
            state = self.next[state][self.vocabulary[token]]
        return state


class Scanner:
    def __init__(
        self,
        phrases: dict[str, str] = PHRASES,
        templates: dict[str, str] = TEMPLATES,
        min_match: int = MIN_MATCH,
        max_gap: int = MAX_GAP,
        min_cover: float = MIN_COVER,
    ):
        self.min_match, self.max_gap, self.min_cover = min_match, max_gap, min_cover
        self.labels = list(templates)
        texts = [tokens(t.encode()) for t in templates.values()]
        self.sizes = [len(t) for t in texts]
        known = [(tokens(p.encode()), label) for p, label in phrases.items()]
        self.automaton = Automaton([*texts, *(p for p, _ in known)])
        self.get = self.automaton.vocabulary.get
        at = {}
        for phrase, label in known:
            at.setdefault(self.automaton.walk(phrase), []).append((len(phrase), label))
        #: Phrases that end wherever a state is reached with at least their length.
        self.phrases: list[list[tuple[int, str]]] = []
        for state in range(len(self.automaton.length)):
            found, up = [], state
            while up > 0:
                found += at.get(up, [])
                up = self.automaton.link[up]
            self.phrases.append(found)
        self.shortest = min((len(p) for p, _ in known), default=1)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int, float]]]:
        """(phrases (label, start, end), spans (label, start, end, covered share)) of a text's tokens."""
        a, get = self.automaton, self.get
        ids = np.fromiter(map(get, words, [-1] * len(words)), np.int32, len(words))
        inside = np.concatenate([[False], ids >= 0, [False]])
        starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
        long = ends - starts >= min(self.shortest, self.min_match)
        hits: list[tuple[str, int, int]] = []
        matches: list[tuple[int, int, int]] = []  # state, file start, file end
        for start, end in zip(starts[long].tolist(), ends[long].tolist()):
            state = length = 0
            for i, c in enumerate(ids[start:end].tolist(), start):
                before, was = state, length
                while state and c not in a.next[state]:
                    state = a.link[state]
                    length = a.length[state]
                if c in a.next[state]:
                    state, length = a.next[state][c], length + 1
                else:
                    state = length = 0
                if was >= self.min_match and length != was + 1:
                    matches.append((before, i - was, i))
                for size, label in self.phrases[state]:
                    if length >= size:
                        hits.append((label, i + 1 - size, i + 1))
            if length >= self.min_match:
                matches.append((state, end - length, end))
        return hits, self._chain(matches)

    def _chain(self, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Greedy chains in file order: a match extends its template's chain if it lies behind it in both, not too far."""
        spans: list[tuple[str, int, int, float]] = []
        open_: list[list[int] | None] = [None] * len(self.labels)

        def close(t):
            chain = open_[t]
            if chain is not None and chain[3] >= self.min_cover * self.sizes[t]:
                spans.append((self.labels[t], chain[0], chain[1], chain[3] / self.sizes[t]))
            open_[t] = None

        for state, start, end in matches:
            for t, ends in self.automaton.ends[state].items():
                if t >= len(self.labels):
                    continue
                chain = open_[t]
                place = None
                if chain is not None and start - chain[1] <= self.max_gap:
                    # The occurrence nearest behind the chain's place in the template; an overlap counts once.
                    place = next((e for e in ends if e > chain[2]), None)
                if place is None:
                    close(t)
                    place = ends[0]
                    open_[t] = [start, end, place, end - start]
                else:
                    chain[3] += min(end - start, place - chain[2], end - chain[1])
                    chain[1], chain[2] = end, place
        for t in range(len(self.labels)):
            close(t)
        return spans


SCHEMA = (
    "doc_id long, n_words long, phrases array<struct<label: string, start: long, stop: long>>, "
    "spans array<struct<label: string, start: long, stop: long, covered: double>>"
)


def scan(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """(doc_id, n_words, phrases, spans) of every row; places are token numbers from 0, ends are behind the last token.

    Null and empty texts have no tokens and empty lists.
    """
    scanner = scanner or Scanner()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrase = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        span = pa.list_(
            pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("covered", pa.float64())])
        )
        for batch in batches:
            sizes, found, spans = [], [], []
            for text in batch.column(1):
                words = tokens((text.as_py() or "").encode())
                hits, chains = scanner.scan(words)
                sizes.append(len(words))
                found.append([{"label": n, "start": s, "stop": e} for n, s, e in hits])
                spans.append([{"label": n, "start": s, "stop": e, "covered": min(c, 1.0)} for n, s, e, c in chains])
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, phrase), pa.array(spans, span)],
                names=["doc_id", "n_words", "phrases", "spans"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def digest(scanned: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score): score is the best covered share, 1 for a phrase."""
    joined = lambda c: F.concat_ws(",", F.sort_array(F.array_distinct(c)))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min("phrases.start").alias("first_word"),
        F.array_max("phrases.start").alias("last_word"),
        joined(F.col("phrases.label")).alias("base_labels"),
        joined(F.concat("phrases.label", "spans.label")).alias("labels"),
        F.when(F.size("phrases") > 0, F.lit(1.0))
        .otherwise(F.coalesce(F.array_max("spans.covered"), F.lit(0.0)))
        .alias("score"),
    )
