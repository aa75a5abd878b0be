"""Operators on texts against plain versions, on given and odd documents."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from llm_helpers import SF, ordered

from basketlens.llm import byte_bpe, license_scan, packing, sharding, substring_dedup
from basketlens.llm.queries import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(params=["docs", "odd", "none"])
def some(request):
    return request.getfixturevalue(request.param)


def pairs(frame):
    return [(r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect()]


def test_byte_bpe(some):
    import tiktoken
    from public_tokenizers import PATTERN

    path = vocabulary("byte_bpe_50k.tiktoken")
    tool = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    want = []
    for doc_id, text in pairs(some):
        ids = tool.encode_ordinary(text)
        sha = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append((doc_id, len(ids), sha, hashlib.sha256(text.encode()).hexdigest()))
    got = byte_bpe.encode(some, path, PATTERN, block_chars=50_000, follow=(byte_bpe.digests(path), byte_bpe.DIGEST))
    assert ordered(got.collect()) == ordered(want)
    back = byte_bpe.decode(byte_bpe.encode(some, path, PATTERN), path)
    assert ordered((r.doc_id, bytes(r.bytes).decode()) for r in back.collect()) == ordered(pairs(some))


@pytest.mark.parametrize("part_pieces", [40, 100_000])
def test_packing(some, part_pieces):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = []
    for doc_id, text in pairs(some):
        ids = np.array(tool.encode(text, add_special_tokens=False).ids + [1], "<u4")
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    rows = packing.pack(packing.pieces(some, vocabulary("word_bpe_49k.json")), part_pieces=part_pieces).collect()
    assert ordered(r[:5] for r in rows) == ordered(want)
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == list(np.cumsum([0, *(n for _, n in own)])[:-1]) and sum(n for _, n in own) <= 4096
    if part_pieces > 1000 and rows:
        assert len(sequences) == packing.dual_feasible(np.array([r.length for r in rows]), 4096)


def test_chunks_equal_the_tokenizer():
    draw = random.Random(5)
    letters = [chr(c) for c in range(0x21, 0x250)] + list("'.es") * 30
    texts = ["".join(draw.choice(letters) if draw.random() > 0.15 else " " for _ in range(200)) for _ in range(200)]
    texts += ["\u00c9COLE, \u0130stanbul \u00aa \u00ba \u00b5 \u03a3\u0391\u03a3 A\u030a cafe\u0301.", "\u1e9e \u023a\u023e \u65e5\u672c\u8a9e", "", "  "]
    texts += [f"{c}a b{c}. {c}" for c in map(chr, range(0x80, 0x250))]
    for limit in (150_000, 20):
        chunks = packing.Chunks(vocabulary("word_bpe_49k.json"))
        chunks.LIMIT = limit
        for text in texts:
            assert chunks.ids(text).tolist() == chunks.whole(text), text


def test_assembled_sequences(docs):
    packed = packing.pack(packing.pieces(docs, vocabulary("word_bpe_49k.json"), with_ids=True))
    rows = packing.assemble(packed).collect()
    assert sum(len(r.ids) for r in rows) == packed.agg({"length": "sum"}).first()[0]
    assert max(len(r.ids) for r in rows) <= 4096


def test_bounds_hold_for_optimal_packings():
    draw = random.Random(7)
    for _ in range(200):
        bins, lengths = draw.randint(1, 12), []
        for _ in range(bins):
            left = 60
            while left and draw.random() < 0.9:
                lengths.append(draw.randint(1, left))
                left -= lengths[-1]
        sizes = np.array(lengths, np.int64)
        used = packing.best_fit(sizes, 60)
        assert packing.dual_feasible(sizes, 60) <= bins
        if len(sizes):
            assert np.bincount(used, weights=sizes).max() <= 60


def brute_windows(rows, width):
    texts = [WORD.findall(t) for _, t in rows]
    seen = collections.Counter(tuple(w[i : i + width]) for w in texts for i in range(len(w) - width + 1))
    out = []
    for (doc_id, _), words in zip(rows, texts):
        gone = set()
        for i in range(len(words) - width + 1):
            if seen[tuple(words[i : i + width])] > 1:
                gone.update(range(i, i + width))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_repeats(some):
    got = substring_dedup.digest(substring_dedup.remove_repeats(some)).collect()
    assert ordered(got) == ordered(brute_windows(pairs(some), 35))


@pytest.mark.parametrize("levels", [1, 2])
def test_repeats_in_hard_texts(spark, levels):
    draw, texts = random.Random(5), ["a " * 40, "a " * 35, "a " * 34, "a b " * 30, "a b " * 50]
    for _ in range(150):
        k = draw.choice([2, 3, 6, 50, 5000])
        noise = lambda: [str(draw.randrange(k)) for _ in range(draw.randint(0, 40))]
        base = [str(draw.randrange(k)) for _ in range(draw.randint(30, 60))]
        for _ in range(draw.randint(1, 3)):
            tail = draw.choice([[], base[5:], [base[3]] * draw.randint(1, 60)])
            texts.append(" ".join(noise() + base + tail + noise()))
    frame = spark.createDataFrame([(i if i % 50 else None, t) for i, t in enumerate(texts + texts[:20])], "doc_id long, text string")
    got = substring_dedup.digest(substring_dedup.remove_repeats(frame, levels=levels)).collect()
    assert ordered(got) == ordered(brute_windows(pairs(frame), 35))


def test_clean_keeps_other_columns_and_untouched_texts(odd):
    before, after = odd.collect(), substring_dedup.clean(odd)
    assert after.columns == odd.columns and after.count() == len(before)
    gone = {(d, n) for d, n, g, _ in brute_windows(pairs(odd), 35) if g}
    texts = {(r.doc_id, r.text) for r in after.collect()}
    assert all((r.doc_id, r.text) in texts for r in before if (r.doc_id, len(WORD.findall(r.text or ""))) not in gone)


def test_licences(some):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want = []
    for doc_id, text in pairs(some):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(low))
        at, found = [], set()
        for phrase, label in license_scan.PHRASES.items():
            parts = phrase.split()
            here = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
            at += here
            found |= {label} if here else set()
        want.append((doc_id, len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(found))))
    got = license_scan.digest(license_scan.scan(some)).collect()
    assert ordered(r[:6] for r in got) == ordered(want)
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got if r.base_labels)


def test_licence_notices_are_covered(spark):
    texts = [f"Foo bar {t} baz" for t in license_scan.TEMPLATES.values()] + ["to use copy modify", None]
    rows = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = {r.doc_id: {s.label: s for s in r.spans} for r in rows}
    for i, (label, text) in enumerate(license_scan.TEMPLATES.items()):
        span = found[i][label]
        assert (span.start, span.stop, span.covered) == (2, 2 + len(text.split()), 1.0)
    assert not found[len(texts) - 2] and not found[len(texts) - 1]


@pytest.mark.parametrize("limit", [20_000, 100_000, 64 << 20])
def test_shards_equal_sql(spark, docs, limit):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert ordered(sharding.shards(docs, limit=limit).collect()) == ordered(duck.sql(sharding.SHARDS_SQL.format(limit=limit)).fetchall())


def test_shards_of_odd_rows(odd, none, spark):
    rows = sharding.shards(odd, limit=5000).collect()
    assert len(rows) == odd.count() and sharding.shards(none).count() == 0
    sizes = collections.Counter()
    for r in rows:
        sizes[r.shard] += r.n_bytes
    largest = max(r.n_bytes for r in rows)
    assert all(n <= max(5000, largest) for n in sizes.values())
    same = sharding.shards(spark.createDataFrame([(1, "a" * 10)] * 7, "doc_id long, text string"), limit=25).collect()
    assert sorted(collections.Counter(r.shard for r in same).values()) == [1, 2, 2, 2]


def test_written_shards_hold_every_row_once(spark, odd, tmp_path):
    rows = [(None, "n" * 30)] * 5 + [("", "n" * 30)] * 3 + [("k", "x" * n) for n in (10, 10, 10, 60)] + [(str(i), "y" * i) for i in range(20)]
    rows = [(*r, i, None if i % 3 else "own") for i, r in enumerate(rows + [("z", None), (None, None)])]
    small = spark.createDataFrame(rows, "doc_id string, text string, n int, shard string")
    path = f"file://{tmp_path}/shards"
    for docs, limit in ((small, 45), (small, 1 << 20), (odd, 5000)):
        totals = sharding.write_shards(docs, path, limit=limit).collect()
        back = spark.read.parquet(path)
        folder = "shard_" if "shard" in docs.columns else "shard"
        assert ordered(back.select(docs.columns).collect()) == ordered(docs.collect())
        held = collections.defaultdict(list)
        for r in back.collect():
            held[r[folder][1:]].append(len((r.text or "").encode()))
        assert ordered(totals) == ordered((k, len(n), sum(n)) for k, n in held.items())
        assert all(sum(n) <= limit or len([x for x in n if x]) == 1 for n in held.values())
        assert sorted(held) == sorted({r.shard for r in sharding.shards(docs, limit=limit).collect()})


def test_oversized_keys_are_numbered_across_blocks(spark):
    rows = spark.range(0, 150_000, 1, 2).selectExpr("7L AS doc_id", "'ab' AS text")
    sizes = [r["count"] for r in sharding.shards(rows, limit=14).groupBy("shard").count().collect()]
    assert max(sizes) == 7 and sum(sizes) == 150_000 and len(sizes) == -(-150_000 // 7)


def test_plain_words_are_split_without_the_pattern():
    from public_tokenizers import PATTERN

    from basketlens.llm.byte_bpe import Runs

    runs, asked = Runs(PATTERN), []
    number = runs.number
    runs.number = lambda text: asked.append(text) or number(text)
    text = "The cat, the caté and THE cat\x00 's a1 cat"
    runs.learn(text)
    assert asked == ["The", " cat,", " caté", " cat\x00", " 's", " a1"]
    again = Runs(PATTERN)
    names = {v: k for k, v in runs.entries.items()}
    assert [names[n] for n in runs.numbers(text).tolist()] == again.pieces(text)
    assert again.numbers(text).tolist() == runs.numbers(text).tolist() and again.entries == runs.entries


def test_ascii_words_are_not_examined_twice():
    chunks, asked = packing.Chunks(vocabulary("word_bpe_49k.json")), []
    plain = chunks.plain
    chunks.plain = lambda word: asked.append(word) or plain(word)
    text = "The cat, the Caté. and THE ca1 İx éa (cat) ...!"
    assert chunks.ids(text).tolist() == chunks.whole(text)
    assert not {"the", "cat", "and"} & {w.lower() for w in asked}


def test_tokens_that_end_in_nul_are_decoded(tmp_path):
    import base64

    import pyarrow as pa


    (tmp_path / "r").write_text("".join(f"{base64.b64encode(t).decode()} {i}\n" for i, t in [(0, b"\0"), (1, b"a"), (7, b"a\0"), (10, b"b")]))
    ids = [np.array(x, "<u4").tobytes() for x in ([7, 0, 1, 10], [])]
    row = next(byte_bpe.digests(str(tmp_path / "r"))(iter([pa.record_batch([pa.array([1, 2]), pa.array(ids)], names=["doc_id", "ids"])]))).to_pylist()
    sha = lambda x: hashlib.sha256(x).hexdigest()
    assert [tuple(r.values()) for r in row] == [(1, 4, sha(b"7 0 1 10"), sha(b"a\0\0ab")), (2, 0, sha(b""), sha(b""))]
