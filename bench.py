"""Headline queries on stored layers; prints one JSON line.

Bronze and the profile table are written first (timed as ``*_build``). Each
query then runs three times from storage, wall clock around ``collect`` or
the write, and its mean counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketlens.constants import PURCHASE, VIEW  # noqa: E402
from basketlens.operators import interactions, metrics, profiles, quality, sessions, tables, windows  # noqa: E402
from basketlens.session import get_spark, scratch_path  # noqa: E402
from basketlens.sources import testbed  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def main() -> None:
    spark = get_spark(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": os.environ.get("BENCH_SHUFFLE", CPUS),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1).count()  # the first job also starts the JVM-side scheduler
    bronze, profile = scratch_path(spark, "bronze"), scratch_path(spark, "profiles")
    times: dict[str, float] = {}

    source = os.environ.get("BENCH_BRONZE")
    if source:
        bronze = source
    else:
        times["bronze_build"] = timed(lambda: tables.write_bronze(testbed.shop_events(spark, SF_DIR), bronze))
    events = spark.read.parquet(bronze)
    times["profiles_build"] = timed(lambda: profiles.user_profile_basic(events).write.parquet(profile))
    stored = spark.read.parquet(profile)

    def sink(frame):
        """Run a query whose result is a table rather than a report."""
        return lambda: frame.write.format("noop").mode("overwrite").save()

    def merge():
        merged = tables.merge_into(events, tables.price_bump_batch(events), ["user_id", "product_id"], ["event_time", "event_id"])
        merged.write.parquet(scratch_path(spark, "merged"))

    def upsert():
        merged = tables.upsert(stored, tables.bump_top_profiles(stored), ["user_id"], ["total_events"])
        merged.write.parquet(scratch_path(spark, "upserted"))

    queries = {
        "top_viewed_products": lambda: metrics.top_products(events, VIEW, "views", 20, ("product_id",)).collect(),
        "top_spenders": lambda: profiles.top_spenders(stored).collect(),
        "full_scan_count": lambda: events.count(),
        "filter_purchases": lambda: metrics.event_rows(events, PURCHASE).collect(),
        "group_by_category": lambda: metrics.category_price_revenue(events).collect(),
        "top_purchased_products": lambda: metrics.top_products(events, PURCHASE, "purchases", 10, ("product_id",)).collect(),
        "active_users": lambda: metrics.active_users(events, 100).count(),
        "merge_events": merge,
        "upsert_profiles": upsert,
        "daily_metrics": lambda: metrics.daily_metrics(events).collect(),
        "user_profile_full": sink(profiles.user_profile_full(events)),
        "product_stats": sink(profiles.product_stats(events)),
        "interaction_matrix": sink(interactions.interaction_matrix(events)),
        "sessions_gap": sink(sessions.assign_sessions(events)),
        "session_sequences": sink(sessions.gap_session_sequences(events)),
        "trending_windows": sink(windows.trending_windows(events)),
        "category_windows": sink(windows.category_windows(events)),
        "dq_events": lambda: quality.dq_events(events).collect(),
    }
    picked = os.environ.get("BENCH_QUERIES")
    for name, run in queries.items():
        if picked and name not in picked.split(","):
            continue
        times[name] = sum(timed(run) for _ in range(RUNS)) / RUNS

    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(seconds, 3) for name, seconds in times.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "runs": RUNS,
                "cpus": CPUS,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
