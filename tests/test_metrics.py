import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketlens.functions import ranking, rules
from basketlens.operators import clean, clicks, interactions, lookup, metrics, profiles

V, C, P = "view", "cart", "purchase"


@pytest.fixture
def events(make_events):
    return make_events(
        [
            (0, V, 1, "tools.saw", "acme", 10.0, 1),
            (10, V, 1, "tools.saw", None, 10.0, 2),
            (20, C, 1, "tools.saw", "acme", 10.0, 1),
            (30, P, 1, "tools.saw", "acme", 10.05, 1),
            (30, P, 2, None, "zeta", 0.1, 1),
            (86400, P, 2, None, "zeta", 0.2, 3),
            (86410, "error", 2, None, "zeta", 0.2, 3),
            (86420, V, 2, None, "zeta", -1.0, 3),
        ]
    )


def one(frame, **where):
    for key, value in where.items():
        frame = frame.filter(F.col(key) == value)
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0]


def test_cleaning_rejects_bad_rows(events):
    assert events.count() == 6


def test_daily_metrics(events):
    day = one(metrics.daily_metrics(events), event_date=dt.date(2024, 1, 1))
    assert (day.total_events, day.unique_users, day.unique_products) == (5, 2, 2)
    assert day.total_revenue == 10.15
    assert day.avg_order_value == 5.08  # 5.075 rounds half up
    assert (day.view_to_cart_rate, day.cart_to_purchase, day.overall_conversion) == (50.0, 200.0, 100.0)
    empty = one(metrics.daily_metrics(events), event_date=dt.date(2024, 1, 2))
    assert (empty.view_to_cart_rate, empty.cart_to_purchase, empty.overall_conversion) == (0.0, 0.0, 0.0)


def test_sums_do_not_depend_on_order(make_events):
    prices = [0.1, 0.2, 0.3, 1e7, 0.7] * 20
    rows = [(i, P, 1, "a", "b", price, i % 3) for i, price in enumerate(prices)]
    forward = metrics.category_price_revenue(make_events(rows)).first().revenue
    backward = metrics.category_price_revenue(make_events(rows[::-1]).repartition(7)).first().revenue
    assert forward == backward == 200000026.0


def test_ties_follow_the_keys(make_events):
    rows = [(i, V, product, "c", "b", 1.0, 1) for i, product in enumerate([5, 3, 9, 3, 5, 9])]
    top = metrics.top_products(make_events(rows), V, "views", 2, ("product_id",)).collect()
    assert [r.product_id for r in top] == [3, 5]


def test_category_type_stats_skip_missing(events):
    assert {r.category_code for r in metrics.category_type_stats(events).collect()} == {"tools.saw"}
    assert None in {r.category_code for r in metrics.category_type_counts(events).collect()}


def test_funnel_order_and_total(events):
    stages = metrics.funnel(events).collect()
    assert [r.event_type for r in stages] == [V, C, P]
    assert sum(r.total for r in stages) == events.count()
    assert stages[0].pct_of_first == 100.0


def test_profile_rules(events):
    basic = {r.user_id: r for r in profiles.user_profile_basic(events, dt.datetime(2024, 2, 1)).collect()}
    assert basic[1].segment_label == "Casual Browsers"
    assert (basic[1].total_events, basic[1].cart_rate, basic[1].purchase_rate) == (4, 0.25, 0.5)
    full = {r.user_id: r for r in profiles.user_profile_full(events).collect()}
    assert full[1].cart_abandonment_rate == -100.0  # more purchases than carts stays negative
    assert full[3].cart_abandonment_rate == 0.0 and full[3].view_to_purchase_rate == 0.0
    assert (full[1].top_category, full[1].top_brand) == ("tools", "acme")
    assert full[2].avg_order_value is None and full[3].avg_price_viewed is None


@pytest.mark.parametrize(
    "events_, carts, buys, spend, expected",
    [
        (1, 0, 3, 0.0, "Loyal Whales"),
        (1, 5, 0, 500.0, "Loyal Whales"),
        (50, 2, 0, 10.0, "Cart Abandoners"),
        (20, 1, 0, 10.0, "Power Browsers"),
        (19, 1, 1, 10.0, "Casual Browsers"),
    ],
)
def test_first_matching_rule_wins(spark, events_, carts, buys, spend, expected):
    row = spark.createDataFrame([(events_, carts, buys, spend)], "total_events long, total_carts long, total_purchases long, total_spend double")
    assert row.select(rules.rule_segment().alias("s")).first().s == expected


def test_first_seen_takes_the_earliest(make_events):
    rows = [(5, V, 1, "b.x", "late", 1.0, 1), (0, V, 1, None, "early", 1.0, 1), (0, V, 1, "z.y", "tied", 1.0, 1)]
    stats = profiles.product_stats(make_events(rows)).first()
    assert (stats.brand, stats.main_category, stats.category_code) == ("early", "unknown", None)


def test_user_features_fill_gaps(events):
    features = {r.user_id: r for r in profiles.user_features(events).collect()}
    assert features[2].price_std == 0.0 and features[2].avg_order_value == 0.0
    assert features[1].cart_abandonment_rate == -1.0


def test_reader_names(events):
    readers = profiles.profile_for_readers(profiles.user_profile_full(events))
    assert {"views", "cart_adds", "purchases", "unique_products"} <= set(readers.columns)
    assert [r.user_id for r in profiles.high_intent_users(readers).collect()] == [1]
    assert profiles.highest_spenders(readers).first().user_id == 1


def test_histogram_covers_its_range(spark):
    rows = spark.createDataFrame([(v,) for v in (0.0, 9.99, 10.0, 99.9, 100.0, -1.0)], "x double")
    bins = {r.bin: r.n for r in metrics.histogram(rows, "x", 10, 0, 100).collect()}
    assert bins == {0: 2, 1: 1, 9: 1}


def test_feature_histograms_keep_all_values(spark):
    frame = spark.range(100).selectExpr("0 AS label", *[f"cast(id * {i} as double) AS I{i}" for i in range(1, 13)], "cast(1 as double) AS I13")
    counted = clicks.feature_histograms(frame, 10)
    per_feature = {r.feature: r.n for r in counted.groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    assert set(per_feature.values()) == {100} and len(per_feature) == 13
    assert counted.filter("feature = 'I13'").count() == 1


def test_feature_histograms_bin_all_features_by_one_short_expression(spark):
    frame = spark.range(100).selectExpr(*[f"cast(if(id % 9 = 0, null, id * {i} - 7) as double) AS I{i}" for i in range(1, 14)])
    counted = clicks.feature_histograms(frame, 10)
    assert counted._jdf.queryExecution().optimizedPlan().toString().count("FLOOR(") <= 4
    for i in (1, 13):
        values = [v * i - 7.0 for v in range(100) if v % 9]
        low, high = min(values), max(values)
        wanted = {}
        for v in values:
            wanted.setdefault(min(int((v - low) * 10 / (high - low)), 9), []).append(v)
        got = {r.bin: (r.n, r.bin_min, r.bin_max) for r in counted.filter(f"feature = 'I{i}'").collect()}
        assert got == {b: (len(v), min(v), max(v)) for b, v in wanted.items()}


def test_missing_and_correlation(spark):
    frame = spark.range(10).selectExpr(
        "cast(id % 2 as int) AS label", "cast(id % 2 as double) AS I1", "cast(null as double) AS I2",
        *[f"cast(if(id < 5, 0, id) as double) AS I{i}" for i in range(3, 14)],
    )
    missing = {r.feature: (r.null_pct, r.zero_pct) for r in clicks.missing_pct(frame).collect()}
    assert missing["I2"] == (100.0, 0.0) and missing["I3"] == (0.0, 50.0)
    ranked = clicks.label_correlation(frame).collect()
    assert ranked[0].feature == "I1" and ranked[0].correlation == pytest.approx(1.0)
    assert {r.feature: r.correlation for r in ranked}["I2"] == 0.0
    assert clicks.top_null_features(frame, 1).first().feature == "I2"


METRIC_CASES = [
    ([1, 2, 3], [2, 9]),
    ([1, 2], [3]),
    ([4], [4]),
    ([1, 2, 3, 4], [4, 3, 2, 1, 0]),
    ([], [1]),
    ([1], []),
]


def test_array_metrics_match_definition(spark):
    import math

    frame = spark.createDataFrame(METRIC_CASES, "rec array<int>, act array<int>")
    got = frame.select(
        ranking.precision_at_k("rec", "act").alias("p"), ranking.recall_at_k("rec", "act").alias("r"), ranking.ndcg_at_k("rec", "act").alias("n")
    ).collect()
    for (rec, act), row in zip(METRIC_CASES, got):
        if not rec or not act:
            assert tuple(row) == (0.0, 0.0, 0.0)
            continue
        hit = len(set(rec) & set(act))
        gain = sum(1 / math.log2(i + 2) for i, x in enumerate(rec) if x in act)
        best = sum(1 / math.log2(i + 2) for i in range(min(len(act), len(rec))))
        assert tuple(row) == pytest.approx((hit / len(rec), hit / len(act), gain / best))


def test_row_metrics_equal_array_metrics(spark):
    cases = [(u, rec, act) for u, (rec, act) in enumerate(METRIC_CASES[:4])]
    lists = spark.createDataFrame(cases, "user long, rec array<int>, act array<int>")
    expected = lists.agg(
        *[F.round(F.avg(f("rec", "act")), 4) for f in (ranking.precision_at_k, ranking.recall_at_k, ranking.ndcg_at_k)]
    ).first()
    rec = lists.select("user", F.posexplode("rec").alias("rank", "item")).withColumn("rank", F.col("rank") + 1)
    truth = lists.select("user", F.explode("act").alias("item"))
    got = interactions.ranking_metrics(rec, truth, "user", "item").first()
    assert (got.users_evaluated, got.precision, got.recall, got.ndcg) == (4, *expected)


def test_matrix_and_popularity(events):
    matrix = interactions.interaction_matrix(events)
    ratings = {(r.user_id, r.product_id): r.rating for r in matrix.collect()}
    assert ratings == {(1, 1): 9, (2, 1): 1, (1, 2): 5, (3, 2): 5}
    assert [(r.rank, r.product_id) for r in interactions.popular_items(matrix, 5).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert interactions.matrix_stats(matrix).first().sparsity == pytest.approx(1 - 4 / 6)


def test_item_lists_stay_whole_in_blocks(spark):
    matrix = spark.range(1000).selectExpr("1 AS user_id", "id * 3 AS product_id", "1 AS rating")
    lists = interactions.user_item_lists(matrix, 100).collect()
    assert max(len(r["items"]) for r in lists) <= 100
    assert sorted(x for r in lists for x in r["items"]) == [i * 3 for i in range(1000)]


def test_dense_ids(spark):
    ids = interactions.dense_ids(spark.range(5000).selectExpr("id * 1000000007 AS big"), "big", "small", 16).collect()
    small = [r.small for r in ids]
    assert len(set(small)) == 5000 and 0 <= min(small) and max(small) < 10000


def test_splits(spark):
    frame = spark.range(20000).selectExpr("id AS user_id", "id % 7 AS product_id")
    train, test = clean.hash_split(frame, 0.2, "user_id", "product_id")
    assert train.count() + test.count() == 20000
    assert 0.18 < test.count() / 20000 < 0.22
    again = clean.hash_split(frame.repartition(9), 0.2, "user_id", "product_id")[1]
    assert test.exceptAll(again).count() == 0
    assert 150 < clean.hash_sample(frame, 0.01, "user_id").count() < 250


def test_segment_answers(spark):
    requests = spark.createDataFrame([(1,), (2,), (7,)], "user_id long")
    assigned = spark.createDataFrame([(1, 3), (2, 9)], "user_id long, cluster int")
    got = {r.user_id: (r.segment_id, r.segment_label) for r in lookup.segment_answer(requests, assigned).collect()}
    assert got == {1: (3, "Loyal Whales"), 2: (9, "Segment 9"), 7: (2, "Casual Buyers")}


def test_recommendation_fallback(spark):
    requests = spark.createDataFrame([(1,), (2,)], "user_id long")
    recs = spark.createDataFrame([(1, 1, 50, 0.9), (1, 2, 51, 0.8)], "user_id long, rank int, product_id long, score double")
    popular = spark.createDataFrame([(1, 7), (2, 8), (3, 9)], "rank int, product_id long")
    got = sorted((r.user_id, r.rank, r.product_id, r.model) for r in lookup.recommend_answer(requests, recs, popular, 2).collect())
    assert got == [(1, 1, 50, "als"), (1, 2, 51, "als"), (2, 1, 7, "popularity"), (2, 2, 8, "popularity")]
    with pytest.raises(ValueError):
        lookup.recommend_answer(requests, recs, popular, 51)


def test_demo_score_is_clamped(spark):
    rows = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0), (1000.0, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0, 1000.0), (None, None, None, None)], "I1 double, I2 double, I3 double, I5 double")
    scored = lookup.demo_score_answer(rows).collect()
    assert [(r.click_probability, r.prediction) for r in scored] == [(0.48, 0), (0.52, 1), (0.44, 0), (0.48, 0)]


def test_schema_match(spark):
    frame = spark.createDataFrame([("a", None), ("b", "c")], "event_type string, brand string")
    got = metrics.schema_match(frame).first()
    assert (got.schema_match_pct, got.events, got.complete_events) == (25.0, 2, 0)
