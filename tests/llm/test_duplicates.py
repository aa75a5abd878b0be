"""Near duplicates of texts and vectors against all pairs, and the pipeline's stages."""

import collections
import re

import numpy as np
from llm_helpers import ordered

from basketlens.llm import embedding_dedup, minhash

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return collections.Counter([tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else []))


def like(a, b):
    if max(a.values()) == max(b.values()) == 1:
        return len(a.keys() & b.keys()) / len(a.keys() | b.keys())
    return sum(1 / sum(max(a[d] / a[x], b[d] / b[x]) for d in a.keys() | b.keys()) for x in a.keys() & b.keys())


def classes(rows):
    """Smallest id of each row's class, by comparing all pairs that share a shingle."""
    sets, up = [shingles(t) for _, t in rows], list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or (
                len(sets[i].keys() & sets[j].keys()) > 0.3 * min(len(sets[i]), len(sets[j])) and like(sets[i], sets[j]) >= 0.8
            ):
                up[top(i)] = top(j)
    low = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        low[top(i)] += [] if doc_id is None else [doc_id]
    return [(doc_id, min(low[top(i)], default=None)) for i, (doc_id, _) in enumerate(rows)]


def test_near_duplicates(docs):
    got = minhash.near_duplicates(docs)
    assert ordered(r[:2] for r in got.select("doc_id", "class_id").collect()) == ordered(classes([(r.doc_id, r.text) for r in docs.collect()]))


def test_near_duplicates_of_odd_rows(odd, none):
    got = minhash.near_duplicates(odd).select("doc_id", "class_id").collect()
    assert ordered(got) == ordered(classes([(r.doc_id, r.text) for r in odd.collect()]))
    assert minhash.near_duplicates(none).count() == 0
    unique = odd.where("text IS NULL OR text <> 'another text'")  # its id names a second class
    one = minhash.keep_one(unique)
    assert one.columns == odd.columns
    rows = [(r.doc_id, r.text) for r in unique.collect()]
    assert one.count() == len({c if c is not None else t for (_, c), (_, t) in zip(classes(rows), rows)})


def test_probability_jaccard():
    draw = np.random.default_rng(1)
    for _ in range(50):
        a, b = (collections.Counter(draw.integers(0, 12, 15).tolist()) for _ in range(2))
        sides = [(np.array(sorted(c), np.uint64), np.array([c[k] for k in sorted(c)])) for c in (a, b)]
        assert abs(minhash.probability_jaccard(*sides) - like(a, b)) < 1e-12


def test_signatures_estimate_similarity():
    keys = np.arange(300, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a, b = (keys[:200], np.ones(200)), (keys[40:240], np.ones(200))
    signs = minhash.signature(np.repeat([0, 1], 200), np.concatenate([a[0], b[0]]), np.ones(400), 2, 2000)
    assert abs((signs[0] == signs[1]).mean() - 160 / 240) < 0.05


def vectors(rows):
    up, links = list(range(len(rows))), [0] * len(rows)

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    def fine(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    for i, (_, x, p) in enumerate(rows):
        for j, (_, y, q) in enumerate(rows[:i]):
            if p is not None and p == q and fine(x) and fine(y) and len(x) == len(y):
                x1, y1 = np.array(x, float), np.array(y, float)
                if x1 @ y1 / np.sqrt((x1 @ x1) * (y1 @ y1)) >= 0.93:
                    links[i], links[j] = links[i] + 1, links[j] + 1
                    up[max(top(i), top(j))] = min(top(i), top(j))
    low = collections.defaultdict(list)
    for i, r in enumerate(rows):
        low[top(i)].append(r[0])
    return [(r[0], links[i], min(low[top(i)])) for i, r in enumerate(rows)]


def test_near_vectors_with_odd_rows_and_saturated_lists(spark):
    draw = np.random.default_rng(3)
    crowd = draw.standard_normal(16)
    rows = [(i, (crowd + 0.05 * draw.standard_normal(16)).tolist(), 1) for i in range(60)]
    rows += [(100 + i, draw.standard_normal(16).tolist(), i % 3) for i in range(120)]
    rows += [(300, [1.0, 0.0], 1), (301, [1.0, 0.0], 1), (302, [2.0, 0.1], 1), (303, [1.0, 0.0], None), (304, None, 1)]
    rows += [(305, [0.0, 0.0], 1), (306, [float("nan"), 1.0], 1), (307, [], 1), (308, [None, 1.0], 1), (301, [1.0, 0.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = embedding_dedup.near_vectors(frame, keep=8)
    assert ordered(r[:3] for r in got.collect()) == ordered(vectors(rows))
    assert embedding_dedup.near_vectors(frame.where("false")).count() == 0


def test_near_vectors_of_the_table(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in frame.collect()]
    assert ordered(r[:3] for r in embedding_dedup.near_vectors(frame).collect()) == ordered(vectors(rows))


def brute_links(x, threshold=0.93):
    """Links of each row and the smallest row of its component, by all pairs."""
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    hit = unit @ unit.T >= threshold
    low = np.arange(len(x))
    while (low != (low := np.array([low[h].min() for h in hit]))).any():
        pass
    return [(i, int(n) - 1, int(k)) for i, (n, k) in enumerate(zip(hit.sum(1), low))]


def around(draw, centre, cosine, n):
    """n unit vectors with this cosine to a centre, otherwise at random."""
    noise = draw.standard_normal((n, len(centre)))
    noise -= np.outer(noise @ centre, centre)
    return cosine * centre + (1 - cosine**2) ** 0.5 * noise / np.linalg.norm(noise, axis=1)[:, None]


def test_tight_groups_near_each_other_are_one(spark):
    draw = np.random.default_rng(8)
    unit = lambda: around(draw, np.eye(64)[0], 0.0, 1)[0]
    first = unit()
    second = around(draw, first, 0.96, 1)[0]
    third = around(draw, second, 0.96, 1)[0]  # linked with the second group
    x = np.vstack([around(draw, c, 0.996, 120) for c in (first, second, third, unit())] + [draw.standard_normal((200, 64))])
    want = brute_links(x)
    assert len({k for _, _, k in want[:360]}) == 1 and min(n for _, n, _ in want[120:240]) > 300
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    assert ordered(r[:3] for r in embedding_dedup.near_vectors(frame).collect()) == ordered(want)


def test_audit_sees_small_groups_beside_a_large_one(spark):
    draw = np.random.default_rng(9)
    unit = lambda: around(draw, np.eye(64)[0], 0.0, 1)[0]
    x = np.vstack([around(draw, unit(), 0.996, 300)] + [around(draw, unit(), 0.99, 2) for _ in range(40)])
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    nodes = embedding_dedup.nodes_of(frame)
    large = nodes.where("low < 300").selectExpr("c AS id", "0L AS component", "true AS whole")
    links = spark.createDataFrame([], "a long, b long")
    assert embedding_dedup.recall(nodes, links, large, 0.93) == 0
    assert embedding_dedup.recall(nodes.where("low < 300"), links, large, 0.93) == 1


def test_all_pairs_are_compared_where_the_descent_fails(spark, monkeypatch):
    draw = np.random.default_rng(10)
    x = np.vstack([around(draw, np.eye(16)[0], 0.97, 700)] + [np.repeat(draw.standard_normal((60, 16)), 2, 0)])
    x[700::2] *= 1.5
    x[701::3] += 0.01
    monkeypatch.setattr(embedding_dedup, "graph", lambda nodes, *a, **k: spark.createDataFrame([], "a long, b long, cosine float"))
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    assert ordered(r[:3] for r in embedding_dedup.near_vectors(frame).collect()) == ordered(brute_links(x))


def thue_morse(letters, n):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def test_words_that_polynomials_confuse(spark):
    import pyarrow as pa

    from basketlens.llm.common import Words

    words = [thue_morse(x, n) for x in ("ab", "ba") for n in (1024, 2048, 4096)] + ["ab", "ba", "a", "aa", "\0", "\0\0"]
    for lane in (0, 1):
        assert len(set(Words(pa.array([" ".join(words)])).hashes(lane).tolist())) == len(words)
    texts = [(i, w) for i, w in enumerate(words[:6])]
    texts += [(10 + i, " ".join([f"w{k}" for k in range(9)] + [w])) for i, w in enumerate(words[:6])]
    got = minhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"))
    assert ordered(r[:2] for r in got.select("doc_id", "class_id").collect()) == ordered(classes(texts))


def mutants(n, words, changed, seed):
    """Texts that share most words with one text, and are not similar enough to each other."""
    draw = np.random.default_rng(seed)
    base = [f"b{k}" for k in range(words)]
    out = []
    for i in range(n):
        own = list(base)
        for k in draw.choice(words // 5, changed, replace=False) * 5 + 2:
            own[k] = f"m{i}x{k}"
        out.append((i, " ".join(own)))
    return out


def test_mutants_give_fewer_links_than_texts(spark, monkeypatch):
    rows = mutants(150, 400, 6, 2) + [(1000 + i, t + (f" end{i}" if i % 2 else "")) for i, t in mutants(40, 60, 2, 3)]
    rows += [(2000 + i, (t + " ") * (1 + i % 2) + f"tail{i}") for i, t in mutants(30, 50, 1, 4)]
    found = []
    across = minhash._links_across
    monkeypatch.setattr(minhash, "_links_across", lambda *a: found.append(across(*a)) or found[0])
    monkeypatch.setattr(minhash, "PIVOT_ROUNDS", 1)
    monkeypatch.setattr(minhash, "TILE", 64)
    monkeypatch.setattr(minhash, "forget", lambda *a: None)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert ordered(r[:2] for r in got.select("doc_id", "class_id").collect()) == ordered(classes(rows))
    shared = 25 * (2 + len(rows) // 64)  # the tiles that a text can stand in
    assert found and found[0].count() < len(rows) * shared / 10


def windows_kept(rows, width=35):
    """The words that stay of each text, by counting all windows."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    count = collections.Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    for (doc_id, text), w in zip(rows, split):
        gone = {k for i in range(len(w) - width + 1) if count[tuple(w[i : i + width])] > 1 for k in range(i, i + width)}
        yield doc_id, " ".join(x for k, x in enumerate(w) if k not in gone) if gone else text


def test_pipeline_stages(spark, docs, labels):
    import corpus_pipeline

    from basketlens.llm import packing, quality_qda, toxicity
    from basketlens.llm.queries import vocabulary

    given = {}
    frame = docs
    for name, stage in corpus_pipeline.STAGES:
        given[name] = frame
        frame = corpus_pipeline.materialise(stage(spark, frame, SF), "test-stage")
    texts = lambda f: ordered((r.doc_id, r.text) for r in f.collect())
    names = [n for n, _ in corpus_pipeline.STAGES]
    results = dict(zip(names, [*(given[n] for n in names[1:]), frame]))
    for name in names[:-1]:
        assert results[name].columns == docs.columns
    for name, scores, passes in (
        ("toxicity", toxicity.score, lambda r: r.score < 0.5),
        ("quality", quality_qda.score, lambda r: r.score >= 0.3),
    ):
        good = {r.doc_id for r in scores(given[name], labels).collect() if passes(r)}
        assert 0 < len(good) <= given[name].count()
        assert texts(results[name]) == ordered((r.doc_id, r.text) for r in given[name].collect() if r.doc_id in good)
    rows = [(r.doc_id, r.text) for r in given["near duplicates"].collect()]
    firsts = {c for _, c in classes(rows)}
    assert texts(results["near duplicates"]) == ordered(r for r in rows if r[0] in firsts)
    rows = [(r.doc_id, r.text) for r in given["repeated passages"].collect()]
    assert texts(results["repeated passages"]) == ordered(windows_kept(rows))
    plain = packing.Chunks(vocabulary("word_bpe_49k.json"))
    lengths = collections.Counter()
    for r in frame.collect():
        lengths[r.doc_id] += r.length
    assert lengths == {r.doc_id: len(plain.whole(r.text or "")) + 1 for r in given["packing"].collect()}
    places = collections.defaultdict(list)
    for r in frame.collect():
        places[r.sequence_id].append((r.offset, r.length))
    assert all(sum(n for _, n in p) <= 4096 for p in places.values())
    whole = corpus_pipeline.run(spark, SF)
    assert ordered(tuple(r)[:6] for r in whole.collect()) == ordered(tuple(r)[:6] for r in frame.collect())


def test_passages_with_words_that_polynomials_confuse(spark):
    from basketlens.llm import substring_dedup

    rows = []
    for i, n in enumerate((1024, 2048)):
        body = [f"p{i}w{k}" for k in range(40)]
        for j, letters in enumerate(("ab", "ba")):
            own = list(body)
            own[20] = thue_morse(letters, n)
            rows.append((10 * i + j, " ".join(own)))
    rows += [(100, " ".join(f"q{k}" for k in range(50))), (101, "x " + " ".join(f"q{k}" for k in range(50)))]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert ordered((r.doc_id, r.kept) for r in got) == ordered(windows_kept(rows))
    assert {r.doc_id: r.n_removed for r in got if r.n_removed} == {100: 50, 101: 50}


def test_components_are_sought_twice_at_most(spark, monkeypatch):
    rows = mutants(60, 400, 6, 2) + [(1000 + i, t) for i, t in mutants(30, 60, 1, 3)]
    sought, whole = [], minhash.components
    monkeypatch.setattr(minhash, "components", lambda edges: sought.append(1) or whole(edges))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert ordered(r[:2] for r in got.select("doc_id", "class_id").collect()) == ordered(classes(rows))
    assert len(sought) <= 2
