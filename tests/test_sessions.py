import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from basketlens.models.recommend import temporal_split
from basketlens.operators import sessions

V = "view"


def timeline(make_events, seconds, user=1):
    return make_events([(s, V, i, "c", "b", 1.0, user) for i, s in enumerate(seconds)])


def ids(frame):
    return [r.session_id for r in frame.orderBy("user_id", "event_time", "event_id").collect()]


def test_gap_boundary(make_events):
    events = timeline(make_events, [0, 1800, 3601, 3602])
    assert ids(sessions.assign_sessions(events)) == [1, 1, 2, 2]


def test_whole_second_rule(make_events):
    events = timeline(make_events, [0.9, 1800.1, 1800.99])
    assert ids(sessions.assign_sessions(events)) == [1, 1, 1]


def expected(rows, gap):
    out, last, number, position = {}, {}, {}, {}
    for event_id, time, user in sorted(rows, key=lambda r: (r[2], r[1], r[0])):
        sec = int(time.replace(tzinfo=dt.timezone.utc).timestamp() // 1)
        fresh = user not in last or sec - last[user] > gap * 60
        number[user] = number.get(user, 0) + fresh
        position[user] = 1 if fresh else position[user] + 1
        last[user] = sec
        out[event_id] = (number[user], position[user], int(fresh))
    return out


@pytest.mark.parametrize("seed, slot", [(1, 3600), (2, 600), (3, 7), (4, 100_000)])
def test_sessions_equal_a_plain_loop(make_events, seed, slot):
    rng = random.Random(seed)
    # User 0 holds a third of the rows; many instants repeat.
    rows = [(rng.choice([rng.randrange(200_000), rng.randrange(50) * 1000]), V, i % 5, "c", "b", 1.0, 0 if i % 3 == 0 else rng.randrange(1, 9)) for i in range(600)]
    events = make_events(rows)
    want = expected([(r.event_id, r.event_time, r.user_id) for r in events.collect()], 30)
    got = {r.event_id: (r.session_id, r.position, r.is_new_session) for r in sessions.assign_sessions(events, slot_seconds=slot).collect()}
    assert got == want


def test_session_ids_never_fall(make_events):
    events = timeline(make_events, [random.Random(5).randrange(10**6) for _ in range(200)])
    found = ids(sessions.assign_sessions(events))
    assert found == sorted(found) and found[0] == 1


def test_long_sessions_continue_in_pieces(make_events):
    events = timeline(make_events, range(0, 2500, 10))
    pieces = sessions.gap_session_sequences(events, max_items=100).orderBy("chunk").collect()
    assert [len(p["items"]) for p in pieces] == [100, 100, 50]
    assert [x for p in pieces for x in p["items"]] == [str(i) for i in range(250)]
    listed = sessions.session_events(sessions.assign_sessions(events), 100).orderBy("chunk").collect()
    assert [e["product"] for p in listed for e in p["events"]] == [str(i) for i in range(250)]


def test_short_sessions_are_left_out(make_events):
    events = timeline(make_events, [0, 10, 10_000])
    assert [r["items"] for r in sessions.gap_session_sequences(events).collect()] == [["0", "1"]]
    stats = sessions.session_stats(sessions.session_summary(sessions.assign_sessions(events))).first()
    assert (stats.sessions, stats.avg_length) == (1, 2.0)


def test_shop_sessions_follow_time_then_id(make_events):
    events = timeline(make_events, [30, 10, 10, 20]).withColumn("user_session", F.lit("s"))
    assert sessions.shop_session_sequences(events).first()["items"] == ["1", "2", "3", "0"]


def test_held_out_pairs(make_events):
    events = timeline(make_events, [0, 10, 20, 9000, 9010])
    pairs = sessions.held_out_pairs(sessions.assign_sessions(events), ["user_id", "session_id"]).collect()
    assert [(r.query_item, r.target_item, r.sessions) for r in pairs] == [("1", "2", 1)]


def test_temporal_split_keeps_order(make_events):
    events = timeline(make_events, range(10))
    train, test = temporal_split(events)
    assert sorted(r.product_id for r in test.collect()) == [8, 9]
    assert train.count() == 8


def test_dominant_user_is_spread(spark, make_events):
    """A third of all rows from one user must not meet in one task."""
    rows = [(i * 400, V, i % 7, "c", "b", 1.0, 0 if i % 3 == 0 else i) for i in range(6000)]
    events = make_events(rows)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed = sessions.assign_sessions(events).select("user_id", F.spark_partition_id().alias("task"))
        sizes = [r["count"] for r in placed.filter("user_id = 0").groupBy("task").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 2000 and max(sizes) < 1000
