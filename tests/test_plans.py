import os
import re

import pytest

import __spark_entry__ as driver
from basketlens.operators import metrics, sessions, tables
from basketlens.plans import registry
from basketlens.sources import testbed

ACTIONS = ("stream_", "snapshot_", "table_history", "bronze_roundtrip", "similar_items")
FITTED = ("ctr_model", "ctr_hashed", "ctr_importances", "ctr_scores", "als_", "recommend_", "item_", "item2vec", "kmeans", "k_search", "segment_distribution")
PLAIN = [n for n in driver.queries() if not n.startswith(ACTIONS + FITTED)]


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bronze"))
    tables.write_bronze(testbed.shop_events(spark, "/root/testdata/sf0.001"), path)
    return spark.read.parquet(path)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAIN)
def test_no_python_and_no_cross_products(spark, sf, name):
    plan = plan_of(driver.queries()[name](spark, sf))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, node


def test_filters_and_columns_reach_the_scan(bronze):
    plan = plan_of(metrics.top_products(bronze, "view", "views", 20, ("product_id",)))
    assert "EqualTo(event_type,view)" in plan
    assert re.search(r"ReadSchema: struct<event_type:string,product_id:bigint>", plan)


def test_dates_prune_partitions(bronze):
    plan = plan_of(metrics.daily_metrics(bronze.filter("event_date = date'2024-01-05'")))
    assert re.search(r"PartitionFilters: \[isnotnull\(event_date", plan)


def test_reports_use_bounded_heaps(bronze):
    assert "TakeOrderedAndProject" in plan_of(metrics.top_brands(bronze))


def test_no_window_spans_a_whole_user(bronze):
    plan = plan_of(sessions.assign_sessions(bronze).select("session_id", "position"))
    by_user_alone = re.findall(r"Window \[[^\n]*?\], \[user_id#\d+L\], \[([a-z_]+)#", plan)
    assert set(by_user_alone) == {"_slot"}


def test_entry(spark):
    frame = driver.entry(spark)
    assert frame.count() == 30


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_queries_equal_their_oracles(spark, sf, name):
    duckdb = pytest.importorskip("duckdb")
    import check

    duck = duckdb.connect()
    for file in os.listdir(sf):
        duck.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{sf}/{file}'")
    frame = driver.queries()[name](spark, sf)
    got = check.table([tuple(r) for r in frame.collect()], frame.columns)
    wanted = duck.sql(driver.oracle_sql()[name])
    assert got == check.table(wanted.fetchall(), wanted.columns)


@pytest.mark.parametrize("name", ["ctr_filled", "ctr_median_filled"])
def test_whole_click_rows_come_in_runs_of_equal_digests(spark, sf, name):
    frame = driver.queries()[name](spark, sf).select("C1", "C26")
    rows = frame.collect()
    runs = 1 + sum(a != b for a, b in zip(rows, rows[1:]))
    assert len(rows) > 5000 and runs <= len(set(rows)) * frame.rdd.getNumPartitions()
    assert "Exchange" not in plan_of(frame)


def test_hashed_click_model_writes_equal_digests_in_runs(spark, sf, monkeypatch):
    written = []

    def noted(frame, name, **options):
        written.append((frame, options))
        raise InterruptedError

    monkeypatch.setattr(registry, "materialise", noted)
    with pytest.raises(InterruptedError):
        driver.queries()["ctr_hashed_model"](spark, sf)
    (frame, options), = written
    rows = frame.select("C1", "C26").collect()
    runs = 1 + sum(a != b for a, b in zip(rows, rows[1:]))
    assert not options.get("spread") and runs <= len(set(rows)) * frame.rdd.getNumPartitions()
    assert frame.rdd.getNumPartitions() >= 4
