import numpy as np
import pyarrow as pa
import pytest

from basketlens.operators import neighbours
from basketlens.operators.neighbours import ItemIndex, nearest_items


def brute(ids, vectors, asked, k):
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)
    scores = np.round(unit @ unit.T, 12)
    out = {}
    for item in asked:
        i = ids.index(item)
        order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-scores[i, j], ids[j]))[:k]
        out[item] = [ids[j] for j in order]
    return out


def run(spark, ids, vectors, asked, k, **options):
    kind = "string" if isinstance(ids[0], str) else "long"
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in zip(ids, vectors)], f"item {kind}, vector array<double>")
    requests = spark.createDataFrame([(i,) for i in asked], f"item {kind}")
    found = {}
    for row in sorted(nearest_items(table, requests, k, **options).collect(), key=lambda r: (r.item, r.rank)):
        found.setdefault(row.item, []).append(row.neighbour)
    return found


@pytest.mark.parametrize("strip, block", [(1000, 1000), (70, 11), (30, 64)])
def test_clustered_vectors_with_copies(spark, strip, block):
    rng = np.random.default_rng(strip)
    centres = rng.normal(size=(6, 8))
    vectors = np.concatenate([centres[i % 6] + 0.05 * rng.normal(size=8) for i in range(200)]).reshape(200, 8)
    vectors[::3] = vectors[0]  # a third of all items are copies of one
    vectors[5] = 0.0
    ids = list(range(200))
    asked = ids[::4] + [5]
    assert run(spark, ids, vectors, asked, 6, strip=strip, block=block) == brute(ids, vectors, asked, 6)


def test_string_ids_and_fewer_items_than_k(spark):
    ids, vectors = ["a", "b", "c"], np.array([[1.0, 0.0], [0.9, 0.1], [0.0, 1.0]])
    assert run(spark, ids, vectors, ["a", "missing"], 10) == {"a": ["b", "c"]}


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "item long, vector array<double>")
    assert nearest_items(empty, empty.select("item")).count() == 0


def clustered(spark, n, groups, dims=12, spread=0.1, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    vectors = centres[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, dims))
    vectors[: n // 3] = centres[0] + spread * rng.normal(size=(n // 3, dims))  # a third in one cell
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "item long, vector array<double>")


def test_index_reaches_its_recall_without_all_cells(spark):
    table = clustered(spark, 3000, 40)
    index = ItemIndex(table, cells=48)
    assert index.audit(5) >= 0.95 and index.probes < 48
    found = index.nearest(table, 5, block=500, strip=300)
    truth = nearest_items(table, table, 5)
    hits = found.join(truth, ["item", "neighbour"], "left_semi").count()
    assert truth.count() == 15000 and hits >= 0.93 * 15000
    assert found.groupBy("item").count().filter("count > 5").isEmpty()


def test_index_probes_all_cells_where_it_must(spark):
    rng = np.random.default_rng(2)
    table = spark.createDataFrame([(i, rng.normal(size=32).tolist()) for i in range(400)], "item long, vector array<double>")
    index = ItemIndex(table, cells=8)
    assert index.audit(10, least=1.0) == 1.0
    by_rank = lambda f: sorted(tuple(r) for r in f.select("item", "rank", "neighbour").collect())
    index.probes = 8
    assert by_rank(index.nearest(table, 10)) == by_rank(nearest_items(table, table, 10))


def test_index_of_nothing_and_of_one(spark):
    empty = spark.createDataFrame([], "item long, vector array<double>")
    assert ItemIndex(empty).nearest(empty).count() == 0
    one = spark.createDataFrame([("a", [1.0, 2.0])], "item string, vector array<double>")
    assert ItemIndex(one).nearest(one).count() == 0


def test_a_vector_is_shipped_once_a_block(spark, monkeypatch):
    table = clustered(spark, 600, 6)
    units = neighbours.unit_vectors(table, "item", "vector").select("*", neighbours.F.lit(0).alias("cell"))
    sizes = spark.createDataFrame([(0, 3, 4)], "cell int, blocks int, strips int")

    def shipped(batch):
        item = batch.column("item")
        return pa.record_batch([item, item, batch.column("asks").cast("int8").cast("float64")], names=["item", "neighbour", "similarity"])

    monkeypatch.setattr(neighbours, "_streamed", lambda k: lambda batches: map(shipped, batches))
    sent = neighbours._searched(units, units.limit(60), sizes, 5)
    assert sent.filter("similarity = 0").count() == 3 * 600 and sent.filter("similarity = 1").count() == 4 * 60


def test_index_ships_a_request_once_a_strip_whatever_it_probes(spark, monkeypatch):
    rng = np.random.default_rng(8)
    table = spark.createDataFrame([(i, rng.normal(size=16).tolist()) for i in range(600)], "item long, vector array<double>")
    index = ItemIndex(table, cells=24)
    deal, sent = neighbours._dealt, []
    monkeypatch.setattr(neighbours, "_dealt", lambda left, right, tasks, k: sent.append((left.count(), right.count(), tasks)) or deal(left, right, tasks, k))
    index.recall, index.probes = 1.0, 24
    found = index.nearest(table, 5, block=200, strip=200).collect()
    assert sent == [(3 * 600, 3 * 600, 9)]  # by cells it would be 24 * 600 requests
    by_rank = lambda f: sorted((r.item, r.rank, r.neighbour) for r in f)
    assert by_rank(found) == by_rank(nearest_items(table, table, 5).collect())


def test_index_gives_ties_to_the_smaller_id_across_cells(spark):
    rng = np.random.default_rng(9)
    vectors = rng.integers(-1, 2, (300, 3)).astype(float)  # few directions, so most scores tie
    table = spark.createDataFrame([(f"i{i:03}", v.tolist()) for i, v in enumerate(vectors)], "item string, vector array<double>")
    index = ItemIndex(table, cells=9)
    index.recall, index.probes = 1.0, len(index.centres)
    by_rank = lambda f: sorted((r.item, r.rank, r.neighbour) for r in f.collect())
    assert by_rank(index.nearest(table, 30, block=70, strip=90)) == by_rank(nearest_items(table, table, 30))


def test_blocks_and_strips_grow_with_the_root():
    copies = lambda n: neighbours._blocks(n, neighbours.BLOCK) + neighbours._strips(n, neighbours.STRIP)
    assert copies(1_000_000) <= 64 and copies(4_000_000) <= 2 * copies(1_000_000) + 2


@pytest.mark.parametrize("copies", [0, 1500])
def test_few_pairs_are_scored_exactly(monkeypatch, copies):
    """All other items of 2400 requests in one grid cell; rounding stands for the exact scores of pairs."""
    rng, n, k = np.random.default_rng(11), 2400, 7
    vectors = rng.normal(size=(n, 24)) * rng.exponential(size=(n, 1))
    vectors[:copies] = vectors[0]
    vectors[-1], vectors[-2] = 0.0, vectors[3] * (1 + 1e-9)
    rounded, plain = [], np.round
    monkeypatch.setattr(neighbours.np, "round", lambda values, digits: rounded.append(np.size(values)) or plain(values, digits))

    def batch(asks, start, end):
        size = end - start
        columns = {"block": pa.array([0] * size, pa.int32()), "strip": pa.array([0] * size, pa.int32()), "asks": pa.array([asks] * size)}
        columns |= {"cell": pa.array([0] * size, pa.int32()), "item": pa.array(range(start, end))}
        return pa.record_batch(columns | {"unit": pa.array(vectors[start:end].tolist()), "probed": pa.nulls(size, pa.binary())})

    batches = [batch(True, 0, n), batch(False, 0, 1100), batch(False, 1100, n)]
    found = {}
    for table in neighbours._streamed(k)(iter(batches)):
        for item, neighbour, score in zip(*(table.column(c).to_pylist() for c in ("item", "neighbour", "similarity"))):
            found.setdefault(item, []).append((neighbour, score))
    assert copies or sum(rounded) < 0.1 * n * n
    scores = plain(vectors @ vectors.T, 12)
    for item in [*range(0, n, 37), n - 1, n - 2]:
        best = sorted((j for j in range(n) if j != item), key=lambda j: (-scores[item, j], j))[:k]
        assert [j for j, _ in found[item]] == best
        assert [score for _, score in found[item]] == pytest.approx(scores[item, best], abs=1e-11)


def test_lengths_are_taken_once_a_vector(spark):
    """Not once for each component, as when the length is spelt out within the loop over them."""
    table = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, None)], "item long, vector array<float>")
    units = neighbours.unit_vectors(table, "item", "vector")
    assert {r["item"]: r["unit"] for r in units.collect()} == {1: [0.6, 0.8], 2: [0.0, 0.0], 3: None}
    assert units._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1
