"""Every operator as a named query over the driver's tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.constants import CART, CTR_CATEGORICAL, CTR_NUMERIC, EVENT_TYPES, PURCHASE, VIEW
from basketlens.models import click, item2vec, recommend, segments
from basketlens.operators import clean, clicks, interactions, live, lookup, metrics, profiles, quality, sessions, tables, windows
from basketlens.functions.rules import demo_click_probability
from basketlens.operators.areas import ranking_areas
from basketlens.operators.neighbours import ItemIndex, nearest_items
from basketlens.session import materialise, scratch_path
from basketlens.sources import testbed
from basketlens.sources.files import union_sources
from basketlens.sources.streams import prepare_replay, stream_events
from basketlens.sources.synthetic import generate_ctr
from basketlens.streaming import runs

Query = Callable[[SparkSession, str], DataFrame]

# Fixed instant for columns that otherwise carry the time of the run.
ASOF = dt.datetime(2024, 2, 1)

# Slices a stream run replays the history in, and the lateness that covers one
# slice of the 30 days.
REPLAY_SLICES = 10

# Pause that gives the test events item sequences long enough to learn from.
LONG_GAP = 360

_QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        _QUERIES[name] = function
        return function

    return register


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _over_events(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    _QUERIES[name] = lambda spark, sf_dir: operator(testbed.shop_events(spark, sf_dir))


def _over_clicks(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    _QUERIES[name] = lambda spark, sf_dir: operator(testbed.ctr_rows(spark, sf_dir))


def _over_profiles(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    _QUERIES[name] = lambda spark, sf_dir: operator(
        profiles.profile_for_readers(profiles.user_profile_full(testbed.shop_events(spark, sf_dir)))
    )


def _over_live(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    _QUERIES[name] = lambda spark, sf_dir: operator(live.type_live(testbed.live_feed(spark, sf_dir)))


def _joined(items) -> Column:
    """An array as text, which every engine prints alike."""
    return F.concat_ws(",", items if isinstance(items, Column) else F.col(items))


def _flat(frame: DataFrame) -> DataFrame:
    return frame.withColumn("items", _joined(F.col("items").cast("array<string>")))


# ------------------------------------------------------------------- cleaning

_over_events("bronze_clean", lambda e: e)
_over_events("date_parts", lambda e: e.select("event_id", "event_date", "event_year", "event_month", "event_day"))
_over_events("category_split", lambda e: e.select("event_id", "category_code", "main_category", "sub_category", "brand"))


@query("typed_events")
def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = clean.type_events(testbed.raw_text_events(spark, sf_dir))
    return typed.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@query("cleaned_text")
def cleaned_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text export straight to canonical events."""
    text = testbed.raw_text_events(spark, sf_dir)
    typed = text.withColumns({name: F.expr(f"try_cast({name} as {kind})") for name, kind in
                              (("product_id", "bigint"), ("user_id", "bigint"), ("price", "double"))})
    return clean.clean_events(typed).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@query("union_sources")
def unioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shop events and click rows' line items as two event sources of different width."""
    shop = testbed.shop_events(spark, sf_dir).select("event_id", "event_type", "product_id", "price", "user_id")
    orders = testbed.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("event_id"),
        F.lit(PURCHASE).alias("event_type"),
        F.col("o_totalprice").alias("price"),
        F.col("o_custkey").alias("user_id"),
    )
    return union_sources(shop, orders)


@query("unexpected_types")
def unexpected_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unexpected_values(testbed.raw_events(spark, sf_dir), "event_type", EVENT_TYPES)


_over_events(
    "price_sample",
    lambda e: clean.hash_sample(e.filter((F.col("price") > 0) & (F.col("price") < 1000)), 0.01, "event_id").select(
        "event_id", "event_type", "price"
    ),
)
_over_events("price_bump", lambda e: tables.price_bump_batch(e).select("event_id", "price"))

# ----------------------------------------------------------- event aggregates

_over_events("full_scan_count", metrics.event_rows)
_over_events("filter_purchases", lambda e: metrics.event_rows(e, PURCHASE))
_over_events("category_type_stats", metrics.category_type_stats)
_over_events("category_type_counts", metrics.category_type_counts)
_over_events("event_type_distribution", metrics.event_type_distribution)
_over_events("daily_event_volume", metrics.daily_event_volume)
_over_events("trending_products", metrics.trending_products)
_over_events("hourly_volume", metrics.hourly_volume)
_over_events("hourly_traffic", metrics.hourly_traffic)
_over_events("top_viewed", lambda e: metrics.top_products(e, VIEW, "views"))
_over_events("top_purchased", lambda e: metrics.top_products(e, PURCHASE, "purchases"))
_over_events("top_viewed_products", lambda e: metrics.top_products(e, VIEW, "views", 20, ("product_id",)))
_over_events("top_purchased_products", lambda e: metrics.top_products(e, PURCHASE, "purchases", 10, ("product_id",)))
_over_events("daily_metrics", metrics.daily_metrics)
_over_events("daily_trend", metrics.daily_trend)
_over_events("category_revenue", metrics.category_revenue)
_over_events("category_buyers", metrics.category_buyers)
_over_events("category_price_revenue", metrics.category_price_revenue)
_over_events("funnel", metrics.funnel)
_over_events("user_activity", metrics.user_activity)
_over_events("active_users", lambda e: metrics.active_users(e, 50))
_over_events("buyer_share", lambda e: metrics.buyer_share(metrics.user_activity(e)))
_over_events("top_brands", metrics.top_brands)
_over_events("ingest_stats", lambda e: metrics.ingest_stats(e, exact_median=True))
_over_events("price_histogram", metrics.price_histogram)
_over_events("events_profile", lambda e: metrics.frame_profile(e, "events"))

# ----------------------------------------------------------------- click rows

_over_clicks("label_counts", clicks.label_counts)
_over_clicks("ctr_ingest_stats", clicks.ctr_ingest_stats)
_over_clicks("top_null_features", clicks.top_null_features)
_over_clicks("missing_pct", clicks.missing_pct)
_over_clicks(
    "label_correlation",
    lambda c: clicks.label_correlation(c).withColumn("correlation", F.round("correlation", 6)),
)
_over_clicks("feature_histograms", clicks.feature_histograms)


@query("ctr_filled")
def ctr_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = clean.fill_zero(testbed.ctr_rows(spark, sf_dir, clustered=True))
    return filled.select("label", *CTR_NUMERIC, *CTR_CATEGORICAL, "day")


@query("ctr_median_filled")
def ctr_median_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole, plain = testbed.ctr_rows(spark, sf_dir, clustered=True), testbed.ctr_rows(spark, sf_dir)
    return clean.fill_median(whole, exact=True, measured=plain).select("label", *CTR_NUMERIC, *CTR_CATEGORICAL, "day")


_over_clicks("ctr_demo_areas", lambda c: ranking_areas(c.select("label", demo_click_probability().alias("score")), "label", "score"))
_over_clicks("ctr_price_areas", lambda c: ranking_areas(c, "label", "I2"))
_over_clicks("ctr_demo_score", lambda c: lookup.demo_score_answer(c.select("I1", "I2", "I3", "I5")))


@query("ctr_synthetic")
def ctr_synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = testbed.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"))
    return generate_ctr(keys).select("row_id", "label", *CTR_NUMERIC, *CTR_CATEGORICAL[:2])


# ------------------------------------------------------------------- profiles

_over_events("user_profile_basic", lambda e: profiles.user_profile_basic(e, ASOF))
_over_events("user_profile_full", profiles.user_profile_full)
_over_events("product_stats", profiles.product_stats)
_over_events("top_popular_products", lambda e: profiles.top_products_by_popularity(profiles.product_stats(e)))
_over_events("product_performance", profiles.product_performance)
_over_events("brand_metrics", profiles.brand_metrics)
_over_events("top_spenders", lambda e: profiles.top_spenders(profiles.user_profile_basic(e, ASOF)))
_over_events("top_spender_profiles", lambda e: profiles.top_spender_profiles(profiles.user_profile_full(e)))
_over_events(
    "user_features",
    lambda e: profiles.user_features(e).withColumn("price_std", F.round("price_std", 6)),
)
_over_profiles("profile_summary", profiles.profile_summary)
_over_profiles("highest_spenders", profiles.highest_spenders)
_over_profiles("high_intent_users", profiles.high_intent_users)

# --------------------------------------------------------------- interactions

_over_events("interaction_matrix", interactions.interaction_matrix)
_over_events("matrix_stats", lambda e: interactions.matrix_stats(interactions.interaction_matrix(e)))
_over_events("popularity_ranking", lambda e: interactions.popularity(interactions.interaction_matrix(e)))
_over_events("popularity_topk", lambda e: interactions.popular_items(interactions.interaction_matrix(e), 10))
_over_events("user_item_lists", lambda e: _flat(interactions.user_item_lists(interactions.interaction_matrix(e))))


@query("popularity_eval")
def popularity_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = interactions.interaction_matrix(testbed.shop_events(spark, sf_dir))
    train, test = recommend.split(matrix)
    return interactions.popularity_metrics(train, test, 10)


@query("ranking_eval")
def ranking_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranking metrics of the popular items that a user has not met in training."""
    train, test = recommend.split(interactions.interaction_matrix(testbed.shop_events(spark, sf_dir)))
    return interactions.ranking_metrics(interactions.unseen_popular(train), test, "user_id", "product_id")


# ------------------------------------------------------------------- sessions

SESSION_COLUMNS = ["event_id", "user_id", "event_time", "prev_event_time", "gap_minutes", "is_new_session", "session_id", "position"]

_over_events("sessions_gap", lambda e: sessions.assign_sessions(e).select(SESSION_COLUMNS))
_over_events("sessions_long_gap", lambda e: sessions.assign_sessions(e, LONG_GAP).select(SESSION_COLUMNS))
_over_events("session_summary", lambda e: sessions.session_summary(sessions.assign_sessions(e)))
_over_events(
    "session_events",
    lambda e: sessions.session_events(sessions.assign_sessions(e)).select(
        "user_id",
        "session_id",
        "chunk",
        _joined(F.transform("events.event_time", lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSSSSS"))).alias("times"),
        _joined("events.product").alias("products"),
    ),
)
_over_events("session_stats", lambda e: sessions.session_stats(sessions.session_summary(sessions.assign_sessions(e))))
_over_events("session_sequences", lambda e: _flat(sessions.shop_session_sequences(e)))
_over_events("gap_session_sequences", lambda e: _flat(sessions.gap_session_sequences(e, LONG_GAP)))
_over_events(
    "held_out_pairs",
    lambda e: sessions.held_out_pairs(sessions.assign_sessions(e, LONG_GAP), ["user_id", "session_id"]),
)

# -------------------------------------------------------- tables and versions


@query("upsert_profiles")
def upsert_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = profiles.user_profile_basic(testbed.shop_events(spark, sf_dir), ASOF)
    return tables.upsert(base, tables.bump_top_profiles(base), ["user_id"], ["total_events"])


@query("merge_events")
def merge_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = testbed.shop_events(spark, sf_dir)
    bumped = tables.price_bump_batch(events)
    unseen = tables.price_bump_batch(events, 0.01).withColumn("product_id", F.col("product_id") + 1000)
    return tables.merge_into(events, bumped.unionByName(unseen), ["user_id", "product_id"], ["event_time", "event_id"])


def _versioned_profiles(spark: SparkSession, sf_dir: str) -> tables.VersionedTable:
    table = tables.VersionedTable(spark, scratch_path(spark, "profiles"))
    table.commit(profiles.user_profile_basic(testbed.shop_events(spark, sf_dir), ASOF), "insert")
    stored = table.read(0)
    newcomers = stored.withColumn("user_id", -F.col("user_id") - 1)
    table.commit(tables.upsert(stored, tables.bump_top_profiles(stored).unionByName(newcomers), ["user_id"], ["total_events"]), "upsert")
    return table


@query("snapshot_as_of")
def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versioned_profiles(spark, sf_dir).read(0)


@query("snapshot_latest")
def snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versioned_profiles(spark, sf_dir).read().select("user_id", "total_events", "total_views", "total_spend")


@query("table_history")
def table_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versioned_profiles(spark, sf_dir).history().select("version", "operation", "rows")


@query("bronze_roundtrip")
def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze layer by date, one day replaced, read back per day."""
    path = scratch_path(spark, "bronze")
    events = testbed.shop_events(spark, sf_dir)
    tables.write_bronze(events, path)
    first_day = spark.read.parquet(path).agg(F.min("event_date")).scalar()
    bought = events.filter((F.col("event_date") == first_day) & (F.col("event_type") == PURCHASE))
    tables.overwrite_partitions(bought, path, ["event_date"])
    return spark.read.parquet(path).groupBy("event_date").agg(metrics.rows().alias("events"))


@query("storage_stats")
def storage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("events", "lineitem", "part")
    return tables.storage_stats(spark, {name: f"{sf_dir}/{name}.parquet" for name in names})


# ------------------------------------------------- windows, streams, live feed

_over_events("trending_windows", lambda e: windows.flat_window(windows.trending_windows(e)))
_over_events("category_windows", lambda e: windows.flat_window(windows.category_windows(e)))
_over_events("trending_by_category", lambda e: metrics.trending_by_category(windows.trending_windows(e)))
_over_events("trending_top", lambda e: metrics.top_trending(windows.trending_windows(e)))
_over_events("trending_lookup", lambda e: lookup.trending_answer(windows.trending_windows(e), 10, "economy"))
_over_live("live_typed", lambda f: f)
_over_live("live_recent", live.newest_live)
_over_live("live_kpis", live.live_kpis)
_over_live("live_schema_match", metrics.schema_match)


@query("live_normalised")
def live_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.normalise_live(testbed.live_feed(spark, sf_dir), F.lit(ASOF))


@query("live_overlay")
def live_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product views as history, the live feed's events on top."""
    feed = live.type_live(testbed.live_feed(spark, sf_dir))
    raw = testbed.raw_events(spark, sf_dir).withColumn("product_id", F.col("product_id").cast("string"))
    history = raw.filter(F.col("event_type") == VIEW).groupBy(*live.OVERLAY_KEYS).agg(
        metrics.rows().alias("historical_views")
    )
    return live.live_overlay(history, feed.filter(F.col("event_type") == CART))


def _replay(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Events as slices of a stream source; the layer is written once and read per slice."""
    events = materialise(testbed.shop_events(spark, sf_dir), "replay-input", ["event_date"])
    return prepare_replay(events, scratch_path(spark, "replay"), REPLAY_SLICES), events


@query("stream_events")
def stream_event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, events = _replay(spark, sf_dir)
    return runs.run_event_stream(spark, source, events.schema, scratch_path(spark, "speed"))


@query("stream_trending")
def stream_trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, events = _replay(spark, sf_dir)
    return windows.flat_window(runs.run_trending_stream(spark, source, events.schema, scratch_path(spark, "speed")))


@query("stream_categories")
def stream_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, events = _replay(spark, sf_dir)
    return windows.flat_window(runs.run_category_stream(spark, source, events.schema, scratch_path(spark, "speed")))


@query("stream_top")
def stream_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top products of the trending stream's own output."""
    source, events = _replay(spark, sf_dir)
    return metrics.top_trending(runs.run_trending_stream(spark, source, events.schema, scratch_path(spark, "speed")))


@query("stream_by_category")
def stream_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category roll-up of what the speed layer's three streams left."""
    source, events = _replay(spark, sf_dir)
    layer = runs.run_speed_layer(spark, source, events.schema, scratch_path(spark, "speed"))
    return metrics.trending_by_category(layer["trending"])


@query("stream_profiles")
def stream_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, events = _replay(spark, sf_dir)
    stream = runs.ProfileStream(spark, scratch_path(spark, "profiles"))
    stream.run(stream_events(spark, source, events.schema))
    stream.compact()
    return stream.read(ASOF)


@query("stream_live")
def stream_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key figures of the live feed after it went through the JSON stream."""
    source = scratch_path(spark, "live-json")
    testbed.live_feed(spark, sf_dir).write.json(source)
    return live.live_kpis(runs.run_live_stream(spark, source, scratch_path(spark, "live"), one_per_file=False)).drop("latest_event_time")


# -------------------------------------------------------------------- quality

_over_events("dq_events", lambda e: quality.dq_events(e, min_users=100, min_products=100))
_over_clicks("dq_ctr", quality.dq_ctr)


@query("dq_raw_events")
def dq_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uncleaned events: unknown types, missing brands, duplicate keys."""
    raw = testbed.raw_events(spark, sf_dir)
    checks = [
        quality.not_empty(),
        quality.not_all_null(raw, "price"),
        quality.null_at_most("brand", 10),
        quality.allowed_values("event_type", EVENT_TYPES),
        quality.in_range("price", 0.01, 100),
        quality.no_duplicates(["event_id"]),
        quality.no_duplicates(["user_id", "product_id"]),
    ]
    return quality.run_checks(raw, "raw events", checks)


@query("dq_report")
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = testbed.shop_events(spark, sf_dir)
    return quality.quality_report(quality.dq_events(events), quality.dq_ctr(testbed.ctr_rows(spark, sf_dir)))


# ------------------------------------------------------------ look-up answers


@query("segment_lookup")
def segment_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as requests; busy buyers have an assigned cluster, the rest fall back."""
    profile = profiles.user_profile_basic(testbed.shop_events(spark, sf_dir), ASOF)
    assigned = profile.filter(F.col("total_purchases") >= 10).select(
        "user_id", F.pmod("total_purchases", F.lit(7)).cast("int").alias("cluster")
    )
    requests = testbed.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return lookup.segment_answer(requests, assigned)


@query("similar_items_indexed")
def similar_items_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the index gives for all vectors, against all similarities: answers, and whether recall and similarities hold."""
    vectors = testbed.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item"), F.col("embedding").alias("vector"))
    found = ItemIndex(vectors).nearest(vectors, 10)
    truth = nearest_items(vectors, vectors, 10).select("item", "neighbour", F.col("similarity").alias("exact"))
    both = found.join(truth, ["item", "neighbour"], "left")
    return both.agg(
        F.count_distinct("item").alias("requests"),
        F.count("*").alias("answers"),
        (F.count("exact") >= 0.9 * F.count("*")).alias("recall_reached"),
        F.coalesce(F.max(F.abs(F.col("similarity") - F.col("exact"))) < 1e-9, F.lit(True)).alias("similarities_agree"),
    )


@query("similar_items")
def similar_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest items of every item of the embedding table."""
    vectors = testbed.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item"), F.col("embedding").alias("vector"))
    return lookup.similar_answer(vectors, nearest_items(vectors, vectors, 10))


# --------------------------------------------------------------------- models


def _click_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = testbed.ctr_rows(spark, sf_dir)
    return clean.stored_split(click.prepare(lines), 0.2, *CTR_NUMERIC, name="click-rows", spread=True)


@query("ctr_model_metrics")
def ctr_model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _click_halves(spark, sf_dir)
    linear, trees = click.train_all(train, click.logistic(), click.boosted_trees(click.QUICK))
    return click.compare(test, click.evaluate(linear, test, "logistic"), click.evaluate(trees, test, "trees"))


@query("ctr_hashed_model")
def ctr_hashed_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear model over numerics and hashed categoricals."""
    whole = testbed.ctr_rows(spark, sf_dir, clustered=True, spread=True)
    flagged = clean.with_flag(click.prepare(whole, categorical=True), 0.2, *CTR_NUMERIC)
    train, test = clean.flagged_halves(materialise(flagged, "click-rows"))
    model = click.train(train, click.logistic(20), click.hashed_stages())
    return click.metrics_frame(test, click.evaluate(model, test, "logistic"))


@query("ctr_importances")
def ctr_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _click_halves(spark, sf_dir)
    return click.feature_importances(click.train(train, click.boosted_trees(click.QUICK)), train)


@query("ctr_scores")
def ctr_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _click_halves(spark, sf_dir)
    return lookup.model_score_answer(click.train(train, click.logistic(20)), test)


def _fitted_als(spark: SparkSession, sf_dir: str):
    ratings = recommend.index_ratings(interactions.interaction_matrix(testbed.shop_events(spark, sf_dir)))
    train, test = recommend.split(ratings.rows)
    return recommend.train(train, recommend.QUICK), ratings, train, test


@query("als_recs")
def als_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, ratings, _, _ = _fitted_als(spark, sf_dir)
    return recommend.recommend(model, ratings, 5)


@query("als_eval")
def als_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, ratings, train, test = _fitted_als(spark, sf_dir)
    return recommend.evaluate(recommend.recommend(model, ratings, 10), train, test, 10)


@query("als_error")
def als_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _, _, test = _fitted_als(spark, sf_dir)
    return recommend.rating_error(model, test)


@query("recommend_lookup")
def recommend_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as requests; those without events get the popular items."""
    model, ratings, train, _ = _fitted_als(spark, sf_dir)
    requests = testbed.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    recs = recommend.recommend(model, ratings, 10, requests)
    return lookup.recommend_answer(requests, recs, interactions.popular_items(train, 10))


def _fitted_item2vec(spark: SparkSession, sf_dir: str):
    placed = materialise(sessions.assign_sessions(testbed.shop_events(spark, sf_dir), LONG_GAP), "sessions")
    sequences = materialise(sessions.item_sequences(placed, ["user_id", "session_id"]), "sequences")
    return item2vec.train(sequences, item2vec.QUICK), sequences, placed


@query("item_vectors")
def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _, _ = _fitted_item2vec(spark, sf_dir)
    return item2vec.vectors(model)


@query("item_neighbours")
def item_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _, _ = _fitted_item2vec(spark, sf_dir)
    return item2vec.similar_items(model)


@query("item2vec_eval")
def item2vec_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, sequences, placed = _fitted_item2vec(spark, sf_dir)
    vectors = materialise(item2vec.vectors(model), "vectors")
    pairs = materialise(sessions.held_out_pairs(placed, ["user_id", "session_id"]), "pairs")
    asked = pairs.select(F.col("query_item").alias("item"))
    return item2vec.evaluate(nearest_items(vectors, asked, 10), vectors, sequences, pairs)


@query("kmeans_segments")
def kmeans_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = profiles.user_profile_full(testbed.shop_events(spark, sf_dir))
    return segments.segment_counts(segments.segment_profiles(profiles.profile_for_readers(full)))


@query("k_search")
def k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.search_k(profiles.user_features(testbed.shop_events(spark, sf_dir)), max_iter=20)[0]


@query("segment_distribution")
def segment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = profiles.user_features(testbed.shop_events(spark, sf_dir))
    return segments.segment_distribution(segments.assign_segments(features, 5))
