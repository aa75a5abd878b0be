import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from basketlens.operators import metrics, profiles, tables
from basketlens.sources import testbed


def frame(spark, rows, schema="k int, v string, at int"):
    return spark.createDataFrame(rows, schema)


def state(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_keeps_the_newest(spark):
    base = frame(spark, [(1, "a", 5), (2, "b", 5), (3, "c", 5)])
    batch = frame(spark, [(1, "old", 4), (2, "new", 6), (2, "newer", 7), (3, "tie", 5), (4, "x", 1)])
    merged = tables.upsert(base, batch, ["k"], ["at"])
    assert state(merged) == [(1, "a", 5), (2, "newer", 7), (3, "tie", 5), (4, "x", 1)]
    assert state(tables.upsert(merged, batch, ["k"], ["at"])) == state(merged)


def test_upsert_takes_nulls_of_the_update(spark):
    base = frame(spark, [(1, "a", 5)])
    assert state(tables.upsert(base, frame(spark, [(1, None, 6)]), ["k"], ["at"])) == [(1, None, 6)]


def test_latest_per_key_with_one_dominant_key(spark):
    many = spark.range(30_000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS at", "cast(id as string) AS v")
    latest = tables.latest_per_key(many, ["k"], ["at"])
    assert latest.count() == 20_001
    assert latest.filter("k = 0").first().at == 29_997


def test_merge_updates_every_matching_row(spark):
    target = frame(spark, [(1, "a", 1), (1, "b", 2), (2, "c", 3)])
    source = frame(spark, [(1, "s", 8), (1, "t", 9), (5, "n", 1)])
    assert state(tables.merge_into(target, source, ["k"], ["at"])) == [(1, "t", 9), (1, "t", 9), (2, "c", 3), (5, "n", 1)]


def test_versions(spark, tmp_path):
    table = tables.VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(LookupError):
        table.read()
    for size in (1, 2, 3):
        table.commit(spark.range(size).toDF("k"), f"step {size}")
    assert [table.read(v).count() for v in (0, 1, 2)] == [1, 2, 3]
    assert table.read().count() == 3
    assert [(r.version, r.operation, r.rows) for r in table.history().collect()] == [(0, "step 1", 1), (1, "step 2", 2), (2, "step 3", 3)]
    table.retain(2)
    assert [r.version for r in table.history().collect()] == [1, 2]
    with pytest.raises(LookupError):
        table.read(0)
    table.commit(spark.range(9).toDF("k"))
    assert table.read().count() == 9 and table.read(1).count() == 2


def test_partition_overwrite_is_dynamic(spark, tmp_path):
    path = str(tmp_path / "d")
    tables.write_layer(frame(spark, [(1, "a", 1), (2, "b", 2)]), path, ["k"])
    tables.overwrite_partitions(frame(spark, [(2, "z", 9)]), path, ["k"])
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "z")]
    tables.write_layer(frame(spark, [(7, "q", 1)]), path, ["k"])
    assert [r.k for r in spark.read.parquet(path).collect()] == [7]


def test_bronze_layouts(spark, sf, tmp_path):
    events = testbed.shop_events(spark, sf)
    tables.write_bronze(events, f"{tmp_path}/by_date")
    tables.write_bronze(events, f"{tmp_path}/by_month", ("event_year", "event_month"), "zstd")
    tables.write_by_event_type(events, f"{tmp_path}/by_type")
    assert os.path.isdir(f"{tmp_path}/by_month/event_year=2024/event_month=1")
    assert glob.glob(f"{tmp_path}/by_month/*/*/*.zstd.parquet") and glob.glob(f"{tmp_path}/by_date/*/*.snappy.parquet")
    for name in ("by_date", "by_month", "by_type"):
        assert spark.read.parquet(f"{tmp_path}/{name}").count() == events.count()
    stats = {r.table: r.files for r in tables.storage_stats(spark, {"t": f"{tmp_path}/by_type", "d": f"{tmp_path}/by_date"}).collect()}
    assert stats == {"t": 3, "d": 30}


def test_storage_stats_read_the_listing_alone(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(5000).selectExpr("id", "id % 4 AS part").repartition(3).write.partitionBy("part").parquet(path)
    stored = [f for f in glob.glob(f"{path}/**/*.parquet", recursive=True)]
    stats = tables.storage_stats(spark, {"t": path})
    for name in stored:  # unreadable from here on, the listing stays
        os.truncate(name, 1_000_000)
    row = tables.storage_stats(spark, {"t": path}).first()
    assert (row.files, row.storage_mb) == (len(stored), round(len(stored) * 1_000_000 / 1024 / 1024, 2))
    scan = stats._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<length:bigint>" in scan and "content" not in scan


def test_ctr_layouts(spark, tmp_path):
    clicks = spark.createDataFrame([(1, 0, 5), (0, 1, 6)], "label int, day int, row_id long")
    tables.write_ctr(clicks, f"{tmp_path}/days")
    tables.write_ctr(clicks, f"{tmp_path}/flat", ())
    assert os.path.isdir(f"{tmp_path}/days/day=1")
    assert spark.read.parquet(f"{tmp_path}/flat").columns == ["label", "day"]


def test_catalog_tables(spark, sf):
    names = tables.create_tables(spark, "shop")
    assert len(names) == 4 and tables.create_tables(spark, "shop") == names
    events = testbed.shop_events(spark, sf)
    tables.insert_partitions(events, "shop.events")
    tables.insert_partitions(events.filter("event_type = 'view'"), "shop.events")
    assert spark.table("shop.events").count() == events.count()
    daily = metrics.daily_metrics(events).withColumn("month", F.date_format("event_date", "yyyy-MM"))
    tables.insert_partitions(daily, "shop.daily_metrics")
    assert spark.table("shop.daily_metrics").filter("month = '2024-01'").count() == 30
    tables.create_or_replace(profiles.product_performance(events), "shop.products", {"layer": "gold"})
    tables.create_or_replace(profiles.product_performance(events), "shop.products")
    assert spark.table("shop.products").count() == events.select("product_id").distinct().count()


def test_update_batches(spark, sf):
    events = testbed.shop_events(spark, sf)
    bumped = tables.price_bump_batch(events)
    assert 0.05 < bumped.count() / events.count() < 0.15
    basic = profiles.user_profile_basic(events, dt.datetime(2024, 2, 1))
    busiest = tables.bump_top_profiles(basic, 3)
    assert busiest.count() == 3
    merged = tables.upsert(basic, busiest, ["user_id"], ["total_events"])
    assert merged.agg(F.sum("total_events")).first()[0] == events.count() + 30


def test_empty_table(spark, sf, tmp_path):
    schema = testbed.shop_events(spark, sf).schema
    tables.create_empty(spark, schema, f"{tmp_path}/e")
    assert spark.read.schema(schema).parquet(f"{tmp_path}/e").count() == 0


def test_null_keys_match_each_other(spark):
    base = spark.createDataFrame([(None, 1, 10), ("a", 1, 20)], "brand string, at int, n int")
    news = spark.createDataFrame([(None, 2, 11), ("b", 1, 30), (None, 1, 9)], "brand string, at int, n int")
    for combine in (tables.upsert, tables.merge_into):
        once = combine(base, news, ["brand"], ["at"])
        twice = combine(once, news, ["brand"], ["at"])
        for frame in (once, twice):
            assert sorted(map(tuple, frame.collect()), key=str) == [("a", 1, 20), ("b", 1, 30), (None, 2, 11)]
