import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.models import click, item2vec, recommend, segments, store
from basketlens.operators import clean, interactions, lookup, profiles, sessions
from basketlens.session import recorded
from basketlens.sources import synthetic, testbed
from basketlens.sources.files import write_summary


@pytest.fixture(scope="module")
def events(spark):
    return testbed.shop_events(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def clicks(spark):
    return click.prepare(synthetic.generate_ctr(3000, spark, signal=0.6), categorical=True)


def test_click_models_find_the_signal(spark, clicks, tmp_path):
    train, test = clean.hash_split(clicks, 0.2, "I1", "I2")
    linear = click.train(train, click.logistic(20))
    first = click.evaluate(linear, test, "linear")
    small = click.GbtSize(max_iter=5, max_depth=3, max_bins=16, subsample=1.0, features="auto")
    trees = click.train(train, click.boosted_trees(small))
    second = click.evaluate(trees, test, "trees")
    assert first.auc_roc > 0.7 and second.auc_roc > 0.7
    deltas = {r.metric: r.delta for r in click.compare(test, first, second).collect()}
    assert deltas["auc_roc"] == round(second.auc_roc - first.auc_roc, 4)
    assert click.feature_importances(trees, test).first().feature == "I1"
    store.save(linear, f"{tmp_path}/click")
    loaded = store.load("click", f"{tmp_path}/click")
    scores = lookup.model_score_answer(loaded, test).select("click_probability", "prediction")
    assert scores.filter("click_probability between 0 and 1 and prediction in (0, 1)").count() == test.count()
    summary = store.summary(spark, {"ctr_auc_roc": first.auc_roc})
    write_summary(summary, f"{tmp_path}/summary")
    assert spark.read.json(f"{tmp_path}/summary").first().ctr_auc_roc == first.auc_roc


def test_chance_labels_stay_chance(spark):
    rows = click.prepare(synthetic.generate_ctr(3000, spark))
    train, test = clean.hash_split(rows, 0.3, "I1", "I2")
    assert 0.4 < click.evaluate(click.train(train, click.logistic(10)), test, "linear").auc_roc < 0.6


def test_stored_halves_hash_keys_once_and_models_share_vectors(spark):
    rows = click.prepare(synthetic.generate_ctr(600, spark)).withColumn("I2", F.expr("CASE WHEN I1 > 3 THEN NULL WHEN I1 > 1 THEN -0.0D ELSE I1 * 1e9 END"))
    keys = ["I1", "I2", "I3"]
    spelt = F.md5(F.concat_ws("|", *[F.col(key).cast("string") for key in keys]))
    held_out = F.conv(F.substring(spelt, 1, 8), 16, 10).cast("long") % 100 >= 80
    halves = clean.stored_split(rows, 0.2, *keys, name="click-rows")
    for half, wanted in zip(halves, (rows.filter(~held_out), rows.filter(held_out))):
        assert half.columns == rows.columns and half.count() > 0
        assert half.exceptAll(wanted).count() == wanted.exceptAll(half).count() == 0
        assert "md5" not in half._jdf.queryExecution().toString()
    with recorded() as paths:
        models = click.train_all(clean.fill_zero(halves[0]), click.logistic(2), click.logistic(3))
    assert len(paths) == 1 and len(models) == 2


def test_a_task_of_training_holds_few_rows_however_tightly_stored(spark, monkeypatch):
    """Equal rows take no bytes in a column file, but all their memory as objects."""
    monkeypatch.setattr(click, "FILE_ROWS", 200, raising=False)
    rows = spark.range(0, 6000, 1, 1).select(F.lit(1.0).alias("label"), *[F.lit(0.0).alias(f"I{i}") for i in range(1, 14)])
    sizes, name = [], "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)

    class Counting:
        def fit(self, vectors):
            sizes.extend(r["count"] for r in vectors.groupBy(F.spark_partition_id()).count().collect())

    click.train(rows, Counting())
    assert sum(sizes) == 6000 and max(sizes) <= 4 * 200
    assert spark.conf.get(name) == before


def test_hashed_features(clicks):
    model = click.train(clicks, click.logistic(3), click.hashed_stages(256))
    vector = model.transform(clicks.limit(1)).first().features
    assert vector.size == 13 + 256


def test_als(spark, events, tmp_path):
    ratings = recommend.index_ratings(interactions.interaction_matrix(events))
    train, test = recommend.split(ratings.rows)
    model = recommend.train(train, recommend.AlsSize(rank=4, max_iter=2, nonnegative=True, blocks=2))
    recs = recommend.recommend(model, ratings, 5)
    users = train.select("user_id").distinct().count()
    assert recs.count() == users * 5
    assert recs.groupBy("user_id").agg(F.collect_set("rank").alias("r")).filter(F.array_size("r") != 5).count() == 0
    products = ratings.items.select("product_id")
    assert recs.join(products, "product_id", "left_anti").count() == 0
    asked = events.select("user_id").distinct().limit(2)
    assert recommend.recommend(model, ratings, 3, asked).select("user_id").distinct().count() <= 2
    result = {r.model: r for r in recommend.evaluate(recs, train, test, 5).collect()}
    assert set(result) == {"als", "popularity"} and 0 <= result["als"].ndcg <= 1
    error = recommend.rating_error(model, test).first()
    assert error.rmse >= 0 and 0 < error.precision_proxy <= 1
    store.save(model, f"{tmp_path}/als")
    assert store.load("als", f"{tmp_path}/als").rank == 4


def test_best_items_equal_all_products_without_meeting_all_items(spark, monkeypatch):
    rng = np.random.default_rng(3)
    users, items = rng.normal(size=(90, 6)), rng.normal(size=(640, 6)) * rng.exponential(size=(640, 1)) ** 2
    users[0], items[5] = 0.0, items[9]
    frame = lambda m: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id int, features array<float>")
    search, met = recommend.all_pairs, []
    monkeypatch.setattr(recommend, "all_pairs", lambda u, w, k: met.append(u.count() * w.count()) or search(u, w, k))
    found = {(r.user_idx, r.rank): (r.item_idx, r.score) for r in recommend.best_items(frame(users), frame(items), 7).collect()}
    scores = np.round(users.astype("f4").astype("f8") @ items.astype("f4").astype("f8").T, 12)
    assert len(found) == 90 * 7 and sum(met) < 90 * 640 / 2
    for user in range(90):
        best = sorted(range(640), key=lambda i: (-scores[user, i], i))[:7]
        if user:
            assert [found[user, rank][0] for rank in range(1, 8)] == best
        assert [found[user, rank][1] for rank in range(1, 8)] == pytest.approx(scores[user, best], rel=1e-6)


def test_item2vec(events, tmp_path):
    placed = sessions.assign_sessions(events, 1440)
    sequences = sessions.item_sequences(placed, ["user_id", "session_id"])
    model = item2vec.train(sequences, item2vec.Item2VecSize(vector=8, min_count=2, max_iter=1, partitions=1))
    vectors = item2vec.vectors(model)
    near = item2vec.similar_items(model, k=3)
    assert near.filter("item = neighbour or similarity > 1.000001").count() == 0
    assert near.count() == vectors.count() * 3
    pairs = sessions.held_out_pairs(placed, ["user_id", "session_id"])
    got = item2vec.evaluate(near, vectors, sequences, pairs).first()
    assert got.vocab_size == vectors.count() and 0 < got.coverage <= 1 and 0 <= got.hit_rate <= 1
    assert 0 < got.sessions_evaluated <= pairs.agg(F.sum("sessions")).first()[0]
    store.save(model, f"{tmp_path}/i2v")
    assert item2vec.vectors(store.load("item2vec", f"{tmp_path}/i2v")).count() == vectors.count()


def test_segments(events, tmp_path):
    full = profiles.profile_for_readers(profiles.user_profile_full(events))
    clustered = segments.segment_profiles(full, 3)
    assert segments.segment_counts(clustered).agg(F.sum("users")).first()[0] == full.count()
    features = profiles.user_features(events)
    table, best = segments.search_k(features, (2, 3), 5)
    assert best in (2, 3) and table.filter("best").count() == 1
    assigned = segments.assign_segments(features, best, 5)
    report = segments.segment_distribution(assigned).collect()
    assert sum(r.users for r in report) == features.count() and len(report) == best
    model, silhouette = segments.earlier_model(full, 2)
    assert -1 <= silhouette <= 1
    store.save(model, f"{tmp_path}/km")
    assert len(store.load("kmeans", f"{tmp_path}/km").clusterCenters()) == 2
