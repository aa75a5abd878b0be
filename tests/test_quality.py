import pytest

from basketlens.operators import quality as q


@pytest.fixture
def frame(spark):
    rows = [(1, "view", 1.0, None), (2, "view", float("nan"), None), (2, "other", None, None), (3, None, 5.0, None)]
    return spark.createDataFrame(rows, "id int, event_type string, price double, gone double")


def verdicts(frame, *checks):
    return {r.check: r for r in q.run_checks(frame, "t", list(checks)).collect()}


def test_each_check(frame):
    got = verdicts(
        frame,
        q.not_empty(),
        q.not_all_null(frame, "price"),
        q.not_all_null(frame, "gone"),
        q.null_at_most("event_type", 25),
        q.null_at_most("event_type", 24),
        q.min_distinct("id", 3),
        q.min_distinct("id", 4),
        q.in_range("id", 1, 3),
        q.in_range("gone", 0, 1),
        q.allowed_values("event_type", ["view"]),
        q.no_duplicates(["id"]),
        q.no_duplicates(["id", "event_type"]),
    )
    passed = {name: row.passed for name, row in got.items()}
    assert passed == {
        "not empty": True,
        "price has values": True,
        "gone has values": False,
        "event_type null <= 25%": True,
        "event_type null <= 24%": False,
        "id distinct >= 3": True,
        "id distinct >= 4": False,
        "id in [1, 3]": True,
        "gone in [0, 1]": False,
        "event_type values known": False,
        "no duplicates on id": False,
        "no duplicates on id, event_type": True,
    }
    assert got["price has values"].value == 50.0 and got["price has values"].severity == "critical"
    assert got["event_type values known"].value == 1.0


def test_empty_frame(frame):
    got = verdicts(frame.limit(0), q.not_empty(), q.not_all_null(frame, "price"), q.in_range("price", 0, 1))
    assert not any(r.passed for r in got.values())


def test_report_status(spark):
    rows = [("a", True, "critical"), ("b", False, "warning"), ("b", True, "info"), ("c", False, "critical"), ("c", True, "info"), ("c", True, "info")]
    checks = spark.createDataFrame(rows, "dataset string, passed boolean, severity string")
    got = {r.dataset: (r.status, r.pass_rate, r.failed) for r in q.quality_report(checks).collect()}
    assert got == {"a": ("PASS", 1.0, 0), "b": ("WARN", 0.5, 1), "c": ("FAIL", 0.6667, 1)}


def test_unexpected_values(frame):
    assert [tuple(r) for r in q.unexpected_values(frame, "event_type", ["view"]).collect()] == [("other", 1)]


def test_one_pass_per_suite(spark, sf):
    from basketlens.sources import testbed

    plan = q.dq_ctr(testbed.ctr_rows(spark, sf))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
