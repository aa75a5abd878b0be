"""Toxicity by compression distance.

Zstandard dictionaries are trained on windows of ordinary texts and on windows
of toxic texts: the words around byte n-grams that are in more toxic than
ordinary texts (log-likelihood ratio), since the rest of a toxic text is
ordinary. Every window of a text is compressed with both; a window that the
toxic dictionary shortens by more bytes speaks for toxicity. The two largest
gains of a text and their sum, normalised by length, are calibrated to a
probability on labelled rows that the dictionaries have not seen.

How much more often a marking n-gram stands in toxic texts depends on the data:
words that never stand elsewhere, or words that are merely denser. Dictionaries
for both are trained, and the pair with the smaller loss on labelled rows
apart is used. The strict one also holds passages mined from the labels:
n-grams taken greedily, lengthened while their neighbours are the same, and
masked before the next is sought.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import appended, fit_logistic, held_out, labelled, sigmoid
from basketlens.llm.quality_rules import calibrating
from basketlens.session import materialise

#: Labelled rows of each class that the dictionaries are trained on: those with the smallest hash of their id.
FIT_ROWS = 1500
#: Bytes of a window and between windows, of the ordinary dictionary, of an n-gram.
WINDOW, STEP, DICTIONARY, GRAM = 64, 32, 49_152, 5
#: Training windows of a dictionary: of all windows of its texts those with the smallest hash.
FIT_WINDOWS = 60_000
#: Evidence for a passage at least (log-likelihood ratio).
EVIDENCE = 20.0
#: A marking n-gram is this many times as frequent in toxic texts: for the strict and for the loose dictionary.
STRICT, LOOSE = 10, 4
#: Bytes of the part of the toxic dictionary that is trained on toxic windows.
TOXIC = 1024
THRESHOLD = 0.5
#: Whole tables and long searches, so that chance collisions of table entries don't decide a window; logs grow with the dictionary.
SEARCH = dict(window_log=17, chain_log=17, hash_log=17, search_log=6, min_match=5, target_length=32)
#: Bytes around a toxic n-gram that are looked at when it is lengthened.
CONTEXT = 24


def plain(text: str) -> bytes:
    """Lower case, one blank between words and at the ends."""
    return b" " + " ".join(text.lower().split()).encode() + b" "


def grams(raw: bytes) -> np.ndarray:
    """Distinct n-grams as numbers."""
    data = np.frombuffer(raw, np.uint8).astype(np.int64)
    value = np.zeros(max(0, len(data) - GRAM + 1), np.int64)
    for k in range(GRAM):
        value = (value << 8) | data[k : k + len(value)]
    return np.unique(value)


def evidence(toxic: float, ordinary: float, n_toxic: int, n_ordinary: int, times: int = STRICT) -> float:
    """Log-likelihood ratio of a gram in so many toxic and ordinary texts; 0 unless its toxic rate is so many times the other."""
    if not toxic or toxic * n_ordinary <= times * ordinary * n_toxic:
        return 0.0
    total, n = toxic + ordinary, n_toxic + n_ordinary
    g = toxic * math.log(toxic * n / (total * n_toxic))
    return 2 * (g + (ordinary * math.log(ordinary * n / (total * n_ordinary)) if ordinary else 0.0))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for y, text in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist()):
            found = grams(plain(text))
            if len(found):
                yield pa.record_batch([pa.array(found), pa.array(np.full(len(found), y, np.int32))], names=["gram", "y"])


def _contexts(chosen: np.ndarray):
    """Stretches of toxic texts around chosen n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                raw = plain(text)
                data = np.frombuffer(raw, np.uint8).astype(np.int64)
                value = np.zeros(max(0, len(data) - GRAM + 1), np.int64)
                for k in range(GRAM):
                    value = (value << 8) | data[k : k + len(value)]
                at = np.flatnonzero(np.isin(value, chosen))
                parts, end = [], -1
                for i in at.tolist():
                    low, high = max(0, i - CONTEXT), min(len(raw), i + GRAM + CONTEXT)
                    if low <= end:
                        parts[-1] += raw[end:high]
                    else:
                        parts.append(raw[low:high])
                    end = high
                out.append(b"\x00".join(parts))
            yield pa.record_batch([pa.array(out, pa.binary())], names=["stretch"])

    return run


def _marked(chosen: np.ndarray):
    """Words of toxic texts that hold chosen n-grams, neighbours in one window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").to_pylist():
                raw, spans = plain(text), []
                data = np.frombuffer(raw, np.uint8).astype(np.int64)
                value = np.zeros(max(0, len(data) - GRAM + 1), np.int64)
                for k in range(GRAM):
                    value = (value << 8) | data[k : k + len(value)]
                for i in np.flatnonzero(np.isin(value, chosen)).tolist():
                    low = max(raw.rfind(b" ", 0, i + 1), i - CONTEXT, 0)
                    high = raw.find(b" ", i + GRAM - 1, i + GRAM + CONTEXT) + 1 or min(len(raw), i + GRAM + CONTEXT)
                    if spans and low < spans[-1][1]:
                        spans[-1][1] = max(high, spans[-1][1])
                    else:
                        spans.append([low, high])
                cut = [raw[k : min(k + WINDOW, high)] for low, high in spans for k in range(low, high, WINDOW)]
                yield pa.record_batch([pa.array(cut, pa.binary())], names=["window"])

    return run


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text in batch.column("text").to_pylist():
            raw = plain(text)
            cut = [raw[at : at + WINDOW] for at in range(0, len(raw), WINDOW)]
            yield pa.record_batch([pa.array(cut, pa.binary())], names=["window"])


def _dictionary(windows: DataFrame, size: int) -> bytes:
    """A dictionary trained on a bounded sample of windows; copies of a window count."""
    place = F.xxhash64("window", F.monotonically_increasing_id())
    some = [bytes(r.window) for r in windows.orderBy(place, "window").limit(FIT_WINDOWS).collect()]
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, some)) // 8)), some).as_bytes()
    except zstandard.ZstdError:  # too little text for training
        return b"".join(dict.fromkeys(some))[:size]


def passages(stretches: list[bytes], ordinary: dict[int, int], n_ordinary: int) -> list[bytes]:
    """Toxic passages, strongest first, from each toxic text's stretches."""
    n_toxic = len(stretches)
    texts = [s for s in stretches if s]
    owned = [_keys(t) for t in texts]
    count: Counter = Counter()
    where: dict[int, set[int]] = {}
    for i, own in enumerate(owned):
        count.update(own)
        for key in own:
            where.setdefault(key, set()).add(i)
    strength = lambda key: evidence(count[key], ordinary.get(key, 0), n_toxic, n_ordinary)
    heap = [(-strength(k), k) for k in ordinary if count[k]]
    heapq.heapify(heap)
    found: list[bytes] = []
    while heap:
        old, key = heapq.heappop(heap)
        now = strength(key)
        if now < EVIDENCE:
            continue
        if now < -old - 1e-9:
            heapq.heappush(heap, (-now, key))
            continue
        here = sorted(where[key])
        passage = _lengthened(key.to_bytes(GRAM, "big"), [texts[i] for i in here])
        found.append(passage)
        for i in here:
            before = owned[i]
            texts[i] = texts[i].replace(passage, b"\x00")
            after = _keys(texts[i]) & before
            for gone in before - after:
                count[gone] -= 1
                where[gone].discard(i)
            owned[i] = after
        if count[key]:  # it also stands outside of the passage
            heapq.heappush(heap, (-strength(key), key))
    return list(dict.fromkeys(found))


def _keys(text: bytes) -> set[int]:
    return {int.from_bytes(text[i : i + GRAM], "big") for i in range(len(text) - GRAM + 1)}


def _lengthened(passage: bytes, texts: list[bytes]) -> bytes:
    """The passage with the bytes that precede or follow it in most places."""
    while len(passage) < CONTEXT:
        before, behind, n = Counter(), Counter(), 0
        for t in texts:
            at = t.find(passage)
            while at >= 0:
                n += 1
                before[t[at - 1 : at] if at else b""] += 1
                behind[t[at + len(passage) : at + len(passage) + 1]] += 1
                at = t.find(passage, at + 1)
        if not n:
            break
        (a, x), (b, y) = before.most_common(1)[0], behind.most_common(1)[0]
        if b not in (b"", b"\x00") and y >= 0.6 * n and y >= x:
            passage += b
        elif a not in (b"", b"\x00") and x >= 0.6 * n:
            passage = a + passage
        else:
            break
    return passage


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> list[tuple[bytes, bytes]]:
    """Pairs (ordinary dictionary, toxic dictionary) to choose from; none without rows of both classes or without marking n-grams."""
    sample = _labelled_texts(docs, labelled(docs, labels, "toxic").where(~calibrating()), fit_rows, "toxicity-sample")
    sizes = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return []
    counts = (
        sample.mapInArrow(_counted, "gram long, y int")
        .groupBy("gram")
        .agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("ordinary"))
    )
    least = max(3.0, 0.002 * sizes[1])
    denser = F.col("toxic") * sizes[0] > LOOSE * F.col("ordinary") * sizes[1]
    marks = {r.gram: r for r in counts.where((F.col("toxic") >= least) & denser).collect()}
    toxic_texts = sample.where("y = 1").orderBy(F.xxhash64("text"))
    weigh = lambda r, times: evidence(r.toxic, r.ordinary, sizes[1], sizes[0], times)
    parts = []
    for times in (STRICT, LOOSE):
        chosen = np.array(sorted(g for g, r in marks.items() if weigh(r, times) >= EVIDENCE), np.int64)
        if not len(chosen):
            continue
        part = _dictionary(toxic_texts.mapInArrow(_marked(chosen), "window binary"), TOXIC)
        if times == STRICT:
            near = {g: r.ordinary for g, r in marks.items() if weigh(r, times) >= EVIDENCE / 2}
            cut = toxic_texts.mapInArrow(_contexts(np.array(sorted(near), np.int64)), "stretch binary")
            mined = passages([bytes(r.stretch) for r in cut.collect()], near, sizes[0])
            part = b"\x00".join(mined) + b"\x00" + part
        parts.append(part)
    if not parts:
        return []
    ordinary = _dictionary(sample.where("y = 0").orderBy(F.xxhash64("text")).mapInArrow(_windows, "window binary"), DICTIONARY)
    # The toxic part stands first, as far away as can be, so that what ordinary text shares with it is found
    # nearer by; the ordinary side has as many bytes of no text there.
    return [((bytes(range(1, 8)) * len(p))[: len(p)] + ordinary, p + ordinary) for p in dict.fromkeys(parts)]


def _labelled_texts(docs: DataFrame, teach: DataFrame, fit_rows: int, name: str) -> DataFrame:
    """(text, y): distinct texts of ``fit_rows`` labelled rows of each class, those with the smallest hash of their id."""
    chosen = None
    for label in (0, 1):
        some = teach.where(F.col("y") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
        chosen = some if chosen is None else chosen.unionByName(some)
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # 2 * fit_rows ids at most are broadcast.
    return materialise(texts.join(F.broadcast(chosen), "doc_id").groupBy("text").agg(F.max("y").alias("y")), name)


def best_pair(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[bytes, bytes] | None:
    """The trained pair with the smallest loss on labelled rows that no dictionary has seen."""
    pairs = train(docs, labels, fit_rows)
    if len(pairs) < 2:
        return pairs[0] if pairs else None
    apart = _labelled_texts(docs, labelled(docs, labels, "toxic").where(calibrating()), fit_rows, "toxicity-apart")
    losses = []
    for pair in pairs:
        x, y, w = _cells(measure(apart, pair).groupBy(*(c.alias(n) for n, c in shape().items()), "y").count().collect())
        if not 0 < (w * y).sum() < w.sum():
            return pairs[0]
        beta = fit_logistic(x, y, w, ridge=1e-3)
        margin = beta[0] + x @ beta[1:]
        losses.append(float((w * (np.logaddexp(0, margin) - y * margin)).sum()))
    return pairs[int(np.argmin(losses))]


def shape() -> dict:
    """What is calibrated: 21 * 21 gains, some forty sizes and 33 sums at most."""
    clip = lambda c: F.greatest(F.lit(-4), F.least(F.lit(16), F.col(c)))
    return {
        "first": clip("__llm_first"),
        "second": clip("__llm_second"),
        "size": F.round(F.log2(F.col("__llm_n") + 1)),
        "mass": F.least(F.lit(16.0), F.round(2 * F.col("__llm_mass") / F.sqrt(F.col("__llm_n"))) / 2),
    }


def _cells(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = np.array([[r[n] for n in ("first", "second", "size", "mass")] for r in rows], float).reshape(-1, 4)
    return x, np.array([r.y for r in rows], float), np.array([r["count"] for r in rows], float)


def gains(raw: bytes, ordinary, toxic) -> list[int]:
    """Bytes that the toxic dictionary saves over the ordinary one, by window."""
    one, two = ordinary.compress, toxic.compress
    out = []
    for at in range(0, max(1, len(raw) - STEP), STEP):
        window = raw[at : at + WINDOW]
        out.append(len(one(window)) - len(two(window)))
    return out


def measure(docs: DataFrame, dictionaries: tuple[bytes, bytes] | None) -> DataFrame:
    """``docs`` with the largest gain, the largest of windows that don't overlap it, the sum of positive gains and the number of windows.

    They are in __llm_first, __llm_second, __llm_mass and __llm_n.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def make():
        pair = None
        if shared.value is not None:
            # All passages are within reach, however many there are.
            reach = max(len(d) + WINDOW for d in shared.value).bit_length()
            search = {k: max(v, reach) if k in ("window_log", "chain_log", "hash_log") else v for k, v in SEARCH.items()}
            how = zstandard.ZstdCompressionParameters(
                **search, strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_dict_id=False
            )
            raw = zstandard.DICT_TYPE_RAWCONTENT
            pair = [
                zstandard.ZstdCompressor(compression_params=how, dict_data=zstandard.ZstdCompressionDict(d, dict_type=raw))
                for d in shared.value
            ]

        def run(piece: pa.RecordBatch) -> list[pa.Array]:
            first, second, mass, n = [], [], [], []
            for text in piece.column("text"):
                found = gains(plain(text.as_py() or ""), *pair) if pair else [0]
                best = max(range(len(found)), key=found.__getitem__)
                rest = found[: max(0, best - 1)] + found[best + 2 :]
                first.append(found[best])
                second.append(max(rest, default=0))
                mass.append(sum(g for g in found if g > 0))
                n.append(len(found))
            return [pa.array(first, pa.int32()), pa.array(second, pa.int32()), pa.array(mass, pa.int64()), pa.array(n, pa.int64())]

        return run

    return appended(docs, "__llm_first int, __llm_second int, __llm_mass long, __llm_n long", make)


def scored(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``docs`` (doc_id, text and others) with ``_score``, after one pass over all windows of all texts.

    Without labels of both classes, or without passages that mark toxic texts,
    the score is the share of toxic labels (0 without labels). Null text counts as
    empty, equal texts get equal scores.
    """
    dictionaries = best_pair(docs, labels, fit_rows)
    measured = materialise(measure(docs, dictionaries), "toxicity-gains")
    features = shape()
    teach = labelled(docs, labels, "toxic").where(calibrating())
    cells = (
        measured.select(F.col("doc_id").cast("long").alias("doc_id"), *(c.alias(n) for n, c in features.items()))
        .join(teach, "doc_id")
        .groupBy(*features, "y")
        .count()
        .collect()
    )
    beta = np.array([-700.0, 0, 0, 0, 0])
    if cells:
        x, y, w = _cells(cells)
        share = float((w * y).sum() / w.sum())
        if 0 < share < 1 and dictionaries is not None:
            beta = fit_logistic(x, y, w, ridge=1e-3)
        else:
            beta[0] = np.log(share / (1 - share)) if 0 < share < 1 else 700.0 * (1 if share else -1)
    margin = F.lit(float(beta[0]))
    for c, b in zip(features.values(), beta[1:]):
        margin = margin + F.lit(float(b)) * c
    return measured.withColumn("__llm_score", sigmoid(margin)).drop("__llm_first", "__llm_second", "__llm_mass", "__llm_n")


def score(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``; see ``scored``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return scored(docs, labels, fit_rows).select(
        "doc_id", held_out().alias("held_out"), F.col("__llm_score").alias("score"), (F.col("__llm_score") >= threshold).cast("int").alias("predicted")
    )


def keep_ordinary(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score stays under the threshold, as they are."""
    return scored(docs, labels, fit_rows).where(F.col("__llm_score") < threshold).drop("__llm_score")
