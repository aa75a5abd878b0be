"""Vector codes and hard negatives against all pairs."""

import hashlib
import math

import numpy as np
import pytest
from llm_helpers import ordered

from basketlens.llm import hard_negatives, vector_codes, vectors

ROWS = "vec_id long, embedding array<double>, label int, q string, error int, code string, row long, _salt int"


def odd_vectors(spark, n=900, dims=8, seed=3):
    """Ties, copies, zero, short, empty, null, non-finite and huge vectors, null ids and labels, a hot label, clashing columns."""
    draw = np.random.default_rng(seed)
    v = np.round(draw.normal(size=(n, dims)), 1)
    v[::5] = v[0]
    v[1::7] *= 3
    rows = [(int(i), [float(x) for x in v[i]], int(draw.integers(0, 4)) if i % 3 else 2) for i in range(n)]
    rows += rows[:40]
    rows += [(-100, [0.0] * dims, 1), (-14, [0.5], 2), (-3, [], 0), (2000, None, 1), (2100, [None] * dims, 1), (2200, [math.nan] * dims, 1)]
    rows += [(2300, [math.inf] + [0.0] * (dims - 1), 1), (2400, [1e30] * dims, 1), (2500, [0.25] * dims, None), (None, [0.25] * dims, 2)]
    return spark.createDataFrame([(*r, "x", 1, "y", 5, 7) for r in rows], ROWS)


def usable(row, largest):
    return row.embedding is not None and all(x is not None and abs(x) <= largest for x in row.embedding)


def padded(vector, scale, width):
    return [math.floor(scale * x) for x in vector] + [0] * (width - len(vector))


def brute_codes(rows):
    rows = [r for r in rows if usable(r, (vector_codes.LARGEST - 1) / vector_codes.SCALE)]
    width = max(1, -(-max(len(r.embedding) for r in rows) // 4)) * 4
    q = np.array([padded(r.embedding, 1024, width) for r in rows], object)
    start = sorted(range(len(rows)), key=lambda i: (rows[i].vec_id is None, rows[i].vec_id or 0, np.array(q[i], np.int32).tobytes()))[:256]
    parts = [q[:, p * width // 4 : (p + 1) * width // 4] for p in range(4)]
    books = [part[start] for part in parts]

    def assign():
        d = [((part[:, None] - book[None]) ** 2).sum(2) for part, book in zip(parts, books)]
        return [x.argmin(1) for x in d], [x.min(1) for x in d]

    for _ in range(4):
        found, _ = assign()
        for part, book, e in zip(parts, books, found):
            for k in set(e.tolist()):
                book[k] = part[e == k].sum(0) // int((e == k).sum())
    found, errors = assign()
    error = [int(sum(x[i] for x in errors)) for i in range(len(rows))]
    total = {}
    for r, x in zip(rows, error):
        total[r.label] = total.get(r.label, 0) + x
    sha = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel()).encode()).hexdigest()
    return [(r.vec_id, "".join(f"{int(e[i]):02x}" for e in found), error[i], total[r.label], sha) for i, r in enumerate(rows)]


def brute_negatives(rows):
    rows = [r for r in rows if usable(r, (hard_negatives.LARGEST - 1) / 256) and r.vec_id is not None and r.label is not None]
    width = max(1, max(len(r.embedding) for r in rows))
    q = np.array([padded(r.embedding, 256, width) for r in rows], object)
    label = [(r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label for r in rows]
    out = []
    for a, anchor in enumerate(rows):
        if anchor.vec_id % 100:
            continue
        score = q @ q[a]
        order = sorted((i for i in range(len(rows)) if i != a), key=lambda i: (-score[i], rows[i].vec_id))
        for p in [i for i in order if label[i] == label[a]][:5]:
            found = [i for i in order if label[i] != label[a] and 30 * score[p] <= 100 * score[i] <= 90 * score[p]][:10]
            out += [(anchor.vec_id, rows[p].vec_id, k + 1, rows[i].vec_id, int(score[p]), int(score[i])) for k, i in enumerate(found)]
    return out


def test_codes_of_odd_vectors(spark):
    frame = odd_vectors(spark)
    assert ordered(vector_codes.compress(frame).collect()) == ordered(brute_codes(frame.collect()))


def test_codes_of_few_vectors(spark):
    few = odd_vectors(spark).where("vec_id BETWEEN 3 AND 20 OR vec_id = -3")
    assert ordered(vector_codes.compress(few).collect()) == ordered(brute_codes(few.collect()))
    none = few.where("false")
    assert vector_codes.compress(none).collect() == []
    assert vector_codes.compress(none).columns == vector_codes.compress(few).columns
    assert vector_codes.compress(odd_vectors(spark).where("vec_id >= 2000 AND label IS NOT NULL")).count() == 0


@pytest.mark.parametrize("scale", [3, 1000, 1 << 27])
def test_tree_finds_lowest_nearest_entry(scale):
    draw = np.random.default_rng(scale)
    entries = draw.integers(-scale, scale, (256, 4))
    entries[100:140] = entries[7]
    requests = np.concatenate([draw.integers(-scale, scale, (500, 4)), entries])
    number, best, _ = vector_codes.Gnat(entries).nearest(requests)
    d = ((requests[:, None].astype(object) - entries[None].astype(object)) ** 2).sum(2)
    assert (number == d.argmin(1)).all() and (best == d.min(1)).all()


def test_tree_leaves_subtrees_out():
    draw = np.random.default_rng(1)
    middles = draw.integers(-10000, 10000, (16, 8))
    entries = (middles[:, None] + draw.integers(-50, 50, (16, 16, 8))).reshape(-1, 8)
    requests = entries[draw.integers(0, 256, 400)] + draw.integers(-20, 20, (400, 8))
    number, _, work = vector_codes.Gnat(entries).nearest(requests)
    assert work < 0.25 * 256 * len(requests)
    assert (number == vector_codes.squares(requests, entries).argmin(1)).all()


def test_negatives_of_odd_vectors(spark, monkeypatch):
    frame = odd_vectors(spark)
    wanted = ordered(brute_negatives(frame.collect()))
    assert len(wanted) > 100
    assert ordered(hard_negatives.mine(frame).collect()) == wanted
    for name, value in (("BLOCK", 3), ("STRIP", 200), ("PAIRS", 256)):
        monkeypatch.setattr(hard_negatives, name, value)
    monkeypatch.setattr(hard_negatives.math, "isqrt", lambda n: 0)
    assert ordered(hard_negatives.mine(frame).collect()) == wanted


def test_negatives_of_no_vectors(spark):
    none = odd_vectors(spark).where("false")
    assert hard_negatives.mine(none).collect() == []
    assert hard_negatives.mine(odd_vectors(spark).where("label = 2")).columns == hard_negatives.mine(none).columns


def test_bounds_hold_every_score():
    draw = np.random.default_rng(5)
    q = np.concatenate([draw.integers(-300, 300, (60, 6)), draw.integers(-2, 2, (20, 6)), np.zeros((1, 6), int)])
    q = np.concatenate([q, q[:10], -q[:10], 3 * q[:10]]).astype(float)
    references = q[[1, 2, 61]] / np.linalg.norm(q[[1, 2, 61]], axis=1)[:, None]
    norm = np.linalg.norm(q, axis=1)
    angles = np.where(norm[:, None] > 0, np.arccos(np.clip(q @ references.T / np.where(norm > 0, norm, 1)[:, None], -1, 1)), 0)
    low, high = hard_negatives.bounds(norm, angles, norm, angles)
    score = q @ q.T
    assert (low <= score).all() and (score <= high).all()
    assert (high - low < 2 * norm[:, None] * norm[None]).mean() > 0.5


def test_products_are_exact():
    draw = np.random.default_rng(2)
    for top in (10, 1 << 22, 1 << 28):
        a, b = draw.integers(-top, top, (20, 16)), draw.integers(-top, top, (30, 16))
        assert (vectors.products(a, b) == a.astype(object) @ b.T.astype(object)).all()
