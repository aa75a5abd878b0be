"""Classifiers: exact counts, held-out accuracy, defined results for odd input."""

import collections
import re
import zlib

import numpy as np
import pytest
import zstandard
from llm_helpers import ordered

from basketlens.llm import quality_qda, quality_rules, toxicity

TRAIN = "/root/testdata/sf0.01"


def auc(rows, truth):
    good, bad = ([r.score for r in rows if truth[r.doc_id] == k] for k in (1, 0))
    good, bad = np.array(good)[:, None], np.array(bad)[None]
    return (good > bad).mean() + 0.5 * (good == bad).mean()


def judged(spark, frame, column):
    truth = {r.doc_id: r[column] for r in spark.read.parquet(f"{TRAIN}/labels.parquet").collect()}
    rows = [r for r in frame.collect() if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    return rows, truth


def inputs(spark):
    return spark.read.parquet(f"{TRAIN}/documents.parquet"), spark.read.parquet(f"{TRAIN}/labels.parquet")


def test_qda_held_out(spark):
    rows, truth = judged(spark, quality_qda.score(*inputs(spark)), "quality")
    assert auc(rows, truth) > 0.98 and all(r.held_out for r in rows)
    assert np.mean([r.predicted == truth[r.doc_id] for r in rows]) > 0.95


def test_rules_held_out(spark):
    rows, truth = judged(spark, quality_rules.rules(*inputs(spark)), "quality")
    assert auc(rows, truth) > 0.95


def test_toxicity_held_out(spark):
    rows, truth = judged(spark, toxicity.score(*inputs(spark)), "toxic")
    assert auc(rows, truth) > 0.75
    assert sum(r.predicted for r in rows if not truth[r.doc_id]) <= 2


def test_toxicity_held_out_where_marks_are_only_denser(spark):
    """On the larger table four in ten toxic texts hold none of the words that only toxic texts hold."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [r for r in toxicity.score(docs, labels).collect() if r.held_out and r.doc_id in truth]
    assert auc(rows, truth) > 0.8
    assert np.mean([r.predicted for r in rows if truth[r.doc_id]]) > 0.55
    assert np.mean([r.predicted for r in rows if not truth[r.doc_id]]) < 0.02


def test_gains_equal_plain_compression(spark):
    ordinary, toxic = b"1234567" * 12 + b"some ordinary words", b"a toxic passage" * 5 + b"123456789" + b"some ordinary words"
    texts = ["", "a toxic passage here", "some ordinary words " * 9, "x" * 3000, "a toxic passage " * 7]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    reach = max(len(ordinary), len(toxic)) + toxicity.WINDOW
    search = {k: max(v, reach.bit_length()) if k.endswith("_log") and k != "search_log" else v for k, v in toxicity.SEARCH.items()}
    how = zstandard.ZstdCompressionParameters(**search, strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_dict_id=False)

    def length(window, content):
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(compression_params=how, dict_data=held).compress(window))

    for r in toxicity.measure(frame, (ordinary, toxic)).collect():
        raw = b" " + " ".join(r.text.lower().split()).encode() + b" "
        gain = [length(raw[k : k + 64], ordinary) - length(raw[k : k + 64], toxic) for k in range(0, max(1, len(raw) - 32), 32)]
        best = gain.index(max(gain))
        apart = [g for k, g in enumerate(gain) if abs(k - best) > 1]
        assert (r["__llm_first"], r["__llm_second"], r["__llm_n"]) == (max(gain), max(apart, default=0), len(gain))
        assert r["__llm_mass"] == sum(g for g in gain if g > 0)


def test_toxic_passages_are_mined():
    texts = [f" ab{k} lovely grumpf weather{k} ".encode() for k in range(30)]
    keys = {k: 0 for t in texts for k in toxicity._keys(t)}
    assert toxicity.passages(texts, keys, 300)[0].strip().startswith((b"lovely", b"grumpf"))


def test_rare_passages_are_mined_beside_a_dominant_one():
    draw = np.random.default_rng(6)
    word = lambda: "".join(draw.choice(list("bcdfghjklmnpqrstvwxz"), 12))
    rare = [word() for _ in range(250)]
    texts = [b" dominantmarker "] * 2000 + [f" {w} ".encode() for w in rare for _ in range(16)]
    keys = {k: 0 for t in texts for k in toxicity._keys(t)}
    found = b"|".join(toxicity.passages(texts, keys, len(texts)))
    assert b"dominant" in found and all(any(w[i : i + 5].encode() in found for i in range(8)) for w in rare)


def test_passages_beyond_the_usual_window_are_reached(spark):
    draw = np.random.default_rng(7)
    filler = bytes(draw.integers(97, 123, 400_000).tolist())
    pair = (bytes(range(1, 8)) * 58_000)[: 400_000 + 40] + b"ordinary words", b"a passage of its own that is toxic one.." + filler + b"ordinary words"
    frame = spark.createDataFrame([(1, "a passage of its own that is toxic one")], "doc_id long, text string")
    assert toxicity.measure(frame, pair).first()["__llm_first"] > 15


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = collections.Counter(zip(words, words[1:], words[2:]))
    marked = {j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    failed = n < 50 or 100 * len(marked) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked), failed


@pytest.mark.parametrize("name", ["docs", "odd", "none"])
def test_rule_counts(request, labels, name):
    frame = request.getfixturevalue(name)
    got = quality_rules.rules(frame, labels).collect()
    want = [(r.doc_id, *counts(r.text)) for r in frame.select("doc_id", "text").collect()]
    assert ordered(r[:7] for r in got) == ordered(want)
    assert not any(r.kept and r.base_failed for r in got)


@pytest.mark.parametrize("score", [quality_qda.score, toxicity.score])
def test_scores_of_odd_rows(odd, none, labels, score):
    for frame, known in ((odd, labels), (odd, labels.where("false")), (odd, labels.where("quality = 1 AND toxic = 0")), (none, labels)):
        rows = score(frame, known).collect()
        assert len(rows) == frame.count()
        assert all(0 <= r.score <= 1 and r.predicted in (0, 1) and r.held_out in (True, False) for r in rows)


def test_filters_keep_columns(odd, labels):
    for keep in (quality_qda.keep_good, toxicity.keep_ordinary):
        assert keep(odd, labels).columns == odd.columns


def test_components_of_a_path_and_a_star(spark):
    from basketlens.llm.common import components

    edges = [(i, i + 1) for i in range(1, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
