import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketlens.operators import profiles, windows
from basketlens.sources import testbed
from basketlens.sources.streams import prepare_replay, stream_events
from basketlens.streaming import runs

SLICES = 6


@pytest.fixture(scope="module")
def replay(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("replay"))
    testbed.shop_events(spark, "/root/testdata/sf0.001").write.partitionBy("event_date").parquet(f"{base}/layer")
    events = spark.read.parquet(f"{base}/layer")
    return prepare_replay(events, f"{base}/slices", SLICES), events


def same(left, right):
    assert left.count() == right.count() > 0
    assert left.exceptAll(right.select(left.columns)).count() == 0


def test_replay_is_whole(spark, replay):
    path, events = replay
    assert spark.read.parquet(path).exceptAll(events.select(spark.read.parquet(path).columns)).count() == 0
    assert spark.read.parquet(path).count() == events.count()


def test_trending_stream_equals_batch(spark, replay, tmp_path):
    path, events = replay
    stream = runs.run_trending_stream(spark, path, events.schema, str(tmp_path))
    same(windows.flat_window(stream), windows.flat_window(windows.trending_windows(events)))


def test_approximate_trending_has_the_same_windows(spark, replay, tmp_path):
    path, events = replay
    stream = runs.run_trending_stream(spark, path, events.schema, str(tmp_path), slide=None, distinct="approx")
    batch = windows.flat_window(windows.trending_windows(events, slide=None))
    keys = ["window_start", "product_id", "brand", "event_count", "trend_score"]
    same(windows.flat_window(stream).select(keys), batch.select(keys))


def test_category_stream_equals_batch(spark, replay, tmp_path):
    path, events = replay
    stream = runs.run_category_stream(spark, path, events.schema, str(tmp_path))
    same(windows.flat_window(stream), windows.flat_window(windows.category_windows(events)))


def test_event_stream_resumes(spark, replay, tmp_path):
    path, events = replay
    runs.run_event_stream(spark, path, events.schema, str(tmp_path), 2)
    query = runs.start_append(stream_events(spark, path, events.schema), f"{tmp_path}/events", f"{tmp_path}/_checkpoints/events")
    query.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/events").count() == events.count()


def test_profile_stream(spark, replay, tmp_path):
    path, events = replay
    asof = dt.datetime(2024, 2, 1)
    stream = runs.ProfileStream(spark, str(tmp_path))
    stream.run(stream_events(spark, path, events.schema, 2))
    want = profiles.user_profile_basic(events, asof)
    same(stream.read(asof), want)
    stream.compact()
    same(stream.read(asof), want)
    # A batch delivered twice replaces itself; later batches add to the snapshot.
    late = events.limit(10).withColumn("event_type", F.lit("view"))
    for _ in range(2):
        stream.apply(late, 99)
    assert stream.read(asof).agg(F.sum("total_events")).first()[0] == events.count() + 10
    stream.compact()
    assert stream.read(asof).agg(F.sum("total_events")).first()[0] == events.count() + 10


def test_speed_layer(spark, replay, tmp_path):
    path, events = replay
    out = runs.run_speed_layer(spark, path, events.schema, str(tmp_path))
    assert set(out) == {"events", "trending", "categories"}
    assert out["events"].count() == events.count()
    same(windows.flat_window(out["trending"]), windows.flat_window(windows.trending_windows(events)))
    same(windows.flat_window(out["categories"]), windows.flat_window(windows.category_windows(events)))


def test_late_rows_count_and_repeated_batches_do_not(spark, replay, tmp_path):
    path, events = replay
    stream = runs.trending_stream(stream_events(spark, path, events.schema, 2), str(tmp_path))
    stream.start().awaitTermination()
    first = events.orderBy("event_time", "event_id").limit(10)
    for _ in range(2):
        stream.apply(first, 99)
    late, newest = {}, None
    parts = stream.read().select("batch_id", "pane", "_n").collect()
    for batch in sorted({r.batch_id for r in parts}):
        own = [r for r in parts if r.batch_id == batch]
        late[batch] = sum(r._n for r in own if newest and r.pane < newest - dt.timedelta(hours=1))
        newest = max([r.pane for r in own] + ([newest] if newest else []))
    assert late[99] == 10
    assert {r.batch_id: r.late for r in windows.late_rows(stream.read(), "1 hour").collect()} == late
    got = windows.flat_window(windows.trending_from_parts(stream.read()))
    same(got, windows.flat_window(windows.trending_windows(events.unionByName(first))))


def test_windows_of_broken_panes_are_refused(spark, replay):
    with pytest.raises(ValueError):
        windows.trending_windows(replay[1], "50 minutes", "15 minutes")
