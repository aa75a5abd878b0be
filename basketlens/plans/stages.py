"""The stages of a full run, from raw files to answers.

Each stage reads the previous layer from storage and writes its own, so a
stage can be repeated alone. Every output is computed once, by its write.

    python -m basketlens.plans.stages --root DIR --events RAW_CSV [--ctr RAW_TSV] [stage ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from basketlens.constants import VIEW
from basketlens.models import click, item2vec, recommend, segments, store
from basketlens.operators import clean, clicks, interactions, metrics, profiles, quality, sessions, tables
from basketlens.session import get_spark, materialise
from basketlens.sources import files
from basketlens.sources.streams import prepare_replay
from basketlens.sources.synthetic import generate_ctr
from basketlens.streaming import runs


@dataclass(frozen=True)
class Layout:
    """Where the layers live below one root."""

    root: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze_events(self) -> str:
        return self.path("bronze", "events")

    @property
    def bronze_ctr(self) -> str:
        return self.path("bronze", "ctr")


@dataclass(frozen=True)
class Sizes:
    """Model sizes of the learning stage."""

    trees: click.GbtSize = click.QUICK
    als: recommend.AlsSize = recommend.QUICK
    item2vec: item2vec.Item2VecSize = item2vec.QUICK
    clusters: int = 5
    top_k: int = 10


def bronze(
    spark: SparkSession,
    layout: Layout,
    events: str | list[str],
    ctr: str | None = None,
    synthetic_rows: int = 5_000_000,
    with_session: bool = True,
) -> None:
    """Raw files to clean Parquet; without click files, generated click rows."""
    raw = files.read_events_csv(spark, events, malformed="drop", with_session=with_session)
    tables.write_bronze(clean.clean_events(raw), layout.bronze_events)
    if ctr is None:
        tables.write_ctr(generate_ctr(synthetic_rows, spark), layout.bronze_ctr, ())
    else:
        tables.write_ctr(clean.fill_zero(files.read_ctr_days(spark, ctr)), layout.bronze_ctr)


def _events(spark: SparkSession, layout: Layout) -> DataFrame:
    return files.read_layer(spark, layout.bronze_events)


def quality_gate(spark: SparkSession, layout: Layout, **limits: int) -> DataFrame:
    """Checks of both Bronze tables, stored with their roll-up; returns the roll-up."""
    checks = quality.dq_events(_events(spark, layout), **limits).unionByName(
        quality.dq_ctr(files.read_layer(spark, layout.bronze_ctr))
    )
    stored = layout.path("quality", "checks")
    checks.write.mode("overwrite").parquet(stored)
    report = quality.quality_report(spark.read.parquet(stored))
    files.write_summary(report, layout.path("quality", "report"))
    return report


def gold(spark: SparkSession, layout: Layout) -> None:
    """Batch aggregates."""
    events = _events(spark, layout)
    outputs = {
        "daily_metrics": metrics.daily_metrics(events),
        "product_performance": profiles.product_performance(events),
        "category_type_stats": metrics.category_type_stats(events),
        "category_revenue": metrics.category_revenue(events),
        "hourly_traffic": metrics.hourly_traffic(events),
        "funnel": metrics.funnel(events),
        "ingest_stats": metrics.ingest_stats(events),
        "label_counts": clicks.label_counts(files.read_layer(spark, layout.bronze_ctr)),
    }
    for name, frame in outputs.items():
        frame.write.mode("overwrite").parquet(layout.path("gold", name))


def speed(spark: SparkSession, layout: Layout, slices: int = 100, max_files: int = 5) -> None:
    """Events by type, trending and hourly tables, and the streaming tables of a replay."""
    events = _events(spark, layout)
    tables.write_by_event_type(events, layout.path("speed", "events_by_type"))
    metrics.trending_products(events).write.mode("overwrite").parquet(layout.path("speed", "trending"))
    metrics.hourly_volume(events).write.mode("overwrite").parquet(layout.path("speed", "hourly_volume"))
    run = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    source = prepare_replay(events, layout.path("speed", "replay", run), slices)
    streams = runs.run_speed_layer(spark, source, events.schema, layout.path("speed", "streams", run), max_files)
    for name in ("trending", "categories"):
        streams[name].write.mode("overwrite").parquet(layout.path("speed", "streams", run, name))


def serving(spark: SparkSession, layout: Layout, asof: dt.datetime | None = None) -> dict[str, int]:
    """New versions of the keyed tables; the version number of each."""
    events = _events(spark, layout)
    fresh = {
        "user_profiles": (profiles.user_profile_basic(events, asof), ["user_id"], ["last_event_time"]),
        "user_profiles_full": (profiles.user_profile_full(events), ["user_id"], ["total_events"]),
        "product_stats": (profiles.product_stats(events), ["product_id"], ["total_interactions"]),
        "brand_metrics": (profiles.brand_metrics(events), ["brand"], ["total_interactions"]),
    }
    versions = {}
    for name, (updates, keys, precombine) in fresh.items():
        table = tables.VersionedTable(spark, layout.path("serving", name))
        try:
            base = table.read()
        except LookupError:
            versions[name] = table.commit(updates, "insert")
        else:
            versions[name] = table.commit(tables.upsert(base, updates, keys, precombine), "upsert")
        table.retain(5)
    return versions


def learning(spark: SparkSession, layout: Layout, sizes: Sizes = Sizes()) -> DataFrame:
    """Models, their tables and a one-row summary."""
    events = _events(spark, layout)
    artifacts = layout.path("models")
    found: dict[str, float] = {}

    clicked = click.prepare(files.read_layer(spark, layout.bronze_ctr))
    train, test = clean.stored_split(clicked, 0.2, *clean.numeric_columns(clicked), name="click-rows", spread=True)
    trees = click.train(train, click.boosted_trees(sizes.trees))
    found["ctr_auc_roc"] = click.evaluate(trees, test, "trees").auc_roc
    store.save(trees, f"{artifacts}/click")

    ratings = recommend.index_ratings(interactions.interaction_matrix(events, default=1))
    train, test = recommend.split(ratings.rows)
    als = recommend.train(train, sizes.als)
    recommended = f"{artifacts}/recommendations"
    recommend.recommend(als, ratings, sizes.top_k).write.mode("overwrite").parquet(recommended)
    judged = recommend.evaluate(spark.read.parquet(recommended), train, test, sizes.top_k)
    judged.write.mode("overwrite").parquet(f"{artifacts}/recommendation_metrics")
    store.save(als, f"{artifacts}/als")

    sequences = materialise(sessions.shop_session_sequences(events), "sequences")
    vectors = item2vec.vectors(item2vec.train(sequences, sizes.item2vec))
    vectors.write.mode("overwrite").parquet(f"{artifacts}/item_vectors")
    found["item_vectors"] = spark.read.parquet(f"{artifacts}/item_vectors").count()

    profile = tables.VersionedTable(spark, layout.path("serving", "user_profiles_full")).read()
    assigned = segments.segment_profiles(profiles.profile_for_readers(profile), sizes.clusters)
    assigned.select("user_id", "cluster").write.mode("overwrite").parquet(f"{artifacts}/user_segments")
    counts = segments.segment_counts(spark.read.parquet(f"{artifacts}/user_segments"))
    counts.write.mode("overwrite").parquet(f"{artifacts}/segment_counts")

    summary = store.summary(spark, found)
    files.write_summary(summary, f"{artifacts}/summary")
    return summary


def reports(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The published report queries over the stored layers, as lazy frames and views."""
    events = _events(spark, layout)
    basic = tables.VersionedTable(spark, layout.path("serving", "user_profiles")).read()
    readers = profiles.profile_for_readers(
        tables.VersionedTable(spark, layout.path("serving", "user_profiles_full")).read()
    )
    files.register_views(spark, {"events": events, "profiles": readers})
    return {
        "category_type_counts": metrics.category_type_counts(events),
        "event_type_distribution": metrics.event_type_distribution(events),
        "daily_event_volume": metrics.daily_event_volume(events),
        "top_viewed": metrics.top_products(events, VIEW, "views"),
        "hourly_volume": metrics.hourly_volume(events).limit(50),
        "top_spenders": profiles.top_spenders(basic),
        "highest_spenders": profiles.highest_spenders(readers),
        "profile_summary": profiles.profile_summary(readers),
        "high_intent_users": profiles.high_intent_users(readers),
    }


ORDER = ("bronze", "quality", "gold", "speed", "serving", "learning", "reports")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run the stages of the shop analytics.")
    parser.add_argument("--root", required=True)
    parser.add_argument("--events", help="raw event CSV files")
    parser.add_argument("--ctr", help="folder of raw click files")
    parser.add_argument("stages", nargs="*", default=[])
    args = parser.parse_args(argv)
    spark, layout = get_spark("basketlens"), Layout(args.root)
    for stage in args.stages or ORDER:
        if stage == "bronze":
            bronze(spark, layout, args.events, args.ctr)
        elif stage == "quality":
            quality_gate(spark, layout).show()
        elif stage == "reports":
            for name, frame in reports(spark, layout).items():
                print(name)
                frame.show(truncate=False)
        else:
            {"gold": gold, "speed": speed, "serving": serving, "learning": learning}[stage](spark, layout)


if __name__ == "__main__":
    main()
