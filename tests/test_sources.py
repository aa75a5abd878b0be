import datetime as dt
import gzip
import json
import os

import pytest

from basketlens.operators import clean, live
from basketlens.schemas import ctr_schema, event_schema
from basketlens.session import shared_dir
from basketlens.sources import files, synthetic

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id\n"
GOOD = "2024-01-01 10:00:00 UTC,view,1,11,shop.tools.saw, acme ,9.99,7\n"


@pytest.fixture
def csv_dir(tmp_path):
    (tmp_path / "a.csv").write_text(
        HEADER
        + GOOD
        + "2024-01-01 10:01:00 UTC,cart,x1,11,tools,,1.50,7\n"
        + "not a date,view,2,11,tools,acme,2.0,7\n"
        + "2024-01-01 10:02:00 UTC,purchase,3,11,,acme,0,8\n"
        + "2024-01-01 10:03:00 UTC,purchase,3,11,,acme,,8\n"
        + "2024-01-01 10:04:00 UTC,purchase,3,,tools,,5.25,8\n"
        + "2024-01-01 10:05:00 UTC,error,3,,tools,,5.25,8\n"
    )
    (tmp_path / "b.csv").write_text(HEADER + GOOD.replace(",7\n", ",9\n"))
    return str(tmp_path)


def test_schemas():
    assert len(ctr_schema()) == 40
    assert len(event_schema()) == 8
    assert event_schema(True).fieldNames()[-1] == "user_session"


def test_csv_modes(spark, csv_dir):
    kept = files.read_events_csv(spark, f"{csv_dir}/a.csv")
    dropped = files.read_events_csv(spark, f"{csv_dir}/a.csv", malformed="drop")
    assert len(kept.collect()) == 7
    assert len(dropped.collect()) == 6
    rejects = files.read_event_rejects(spark, f"{csv_dir}/a.csv").collect()
    assert [r.line.split(",")[2] for r in rejects] == ["x1"]


def test_clean_csv(spark, csv_dir):
    rows = clean.clean_events(files.read_events_csv(spark, f"{csv_dir}/a.csv", malformed="drop")).collect()
    assert [(r.event_type, r.price) for r in sorted(rows, key=lambda r: r.event_time)] == [("view", 9.99), ("purchase", 5.25)]
    first = min(rows, key=lambda r: r.event_time)
    assert (first.main_category, first.sub_category, first.brand) == ("shop", "tools.saw", "acme")
    last = max(rows, key=lambda r: r.event_time)
    assert (last.main_category, last.sub_category, last.brand) == ("tools", "unknown", "unknown")
    assert first.event_date == dt.date(2024, 1, 1) and (first.event_year, first.event_month, first.event_day) == (2024, 1, 1)


def test_monthly_files_skip_missing(spark, csv_dir):
    assert files.read_monthly_csv(spark, csv_dir, ["a.csv", "b.csv", "c.csv"]).count() == 8


def test_type_events_drops_bad_times(spark, csv_dir):
    typed = clean.type_events(files.read_events_csv(spark, f"{csv_dir}/a.csv"))
    assert typed.count() == 6
    assert dict(typed.dtypes)["event_date"] == "date"


def _line(label, first):
    return "\t".join([str(label), first] + ["1"] * 12 + ["aa"] * 25 + [""]) + "\n"


def test_ctr_days(spark, tmp_path):
    os.makedirs(tmp_path / "day_0")
    (tmp_path / "day_0" / "part-0").write_text(_line(1, "") + _line(0, "2.5"))
    (tmp_path / "day_1.tsv").write_text(_line(0, "3"))
    with gzip.open(tmp_path / "day_10.gz", "wt") as out:
        out.write(_line(1, "4"))
    every = files.read_ctr_days(spark, str(tmp_path))
    assert sorted((r.day, r.label) for r in every.collect()) == [(0, 0), (0, 1), (1, 0), (10, 1)]
    assert sorted(r.day for r in files.read_ctr_days(spark, str(tmp_path), [1, 7]).collect()) == [1]
    one = files.read_ctr_tsv(spark, str(tmp_path / "day_0"), 0)
    assert one.select("row_id").distinct().count() == 2
    filled = clean.fill_zero(one).orderBy("I1").first()
    assert (filled.I1, filled.C26) == (0.0, "__MISSING__")
    assert clean.fill_median(every).filter("I1 is null").count() == 0
    assert clean.numeric_columns(every) == [f"I{i}" for i in range(1, 14)]


def _post(folder, name, **event):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text(json.dumps(event, indent=1))


def test_live_json(spark, tmp_path):
    day = tmp_path / "year=2024" / "month=01" / "day=02"
    _post(day, "1", event_id="1", event_time="2024-01-02T03:04:05+02:00", event_type="view", product_id="9", price=2.5, user_id="u")
    _post(day, "2", event_id="2", event_time="soon", event_type="view", product_id="9", price="free", user_id="u", session_id="s")
    typed = {r.event_id: r for r in live.type_live(files.read_live_json(spark, str(tmp_path))).collect()}
    assert typed["1"].event_time == dt.datetime(2024, 1, 2, 1, 4, 5)
    assert typed["1"].price == 2.5
    assert (typed["2"].event_time, typed["2"].price) == (None, 0.0)
    os.utime(day / "1.json", (2_000_000_000, 2_000_000_000))
    assert [r.event_id for r in files.read_live_recent(spark, str(tmp_path), 1).collect()] == ["1"]


def test_recent_live_reads_chosen_files_alone(spark, tmp_path):
    for i in range(1000):
        _post(tmp_path / "year=2024" / "month=01" / f"day={i % 7 + 1:02}", f"e{i:04}", event_id=f"e{i}", event_time="2024-01-02T03:04:05Z", event_type="view", product_id="9", price=1, user_id="u")
        os.utime(tmp_path / "year=2024" / "month=01" / f"day={i % 7 + 1:02}" / f"e{i:04}.json", (1_700_000_000 + i * 37 % 1000,) * 2)
    recent = files.read_live_recent(spark, str(tmp_path), 25)
    newest = sorted(range(1000), key=lambda i: -(i * 37 % 1000))[:25]
    assert {r.event_id for r in recent.collect()} == {f"e{i}" for i in newest}
    assert len(recent.inputFiles()) == 25
    (tmp_path / "none").mkdir()
    assert files.read_live_recent(spark, str(tmp_path / "none"), 25).count() == 0


def test_append_live(spark, tmp_path):
    rows = [(None, "2024-03-04T05:06:07Z", "view", "9", None, None, "1.0", "bob", None, "shop")]
    feed = spark.createDataFrame(rows, files.LIVE)
    out = str(tmp_path / "live")
    live.append_live(feed, out)
    assert os.path.isdir(f"{out}/year=2024/month=03/day=04")
    stored = files.read_live_json(spark, out, one_per_file=False).first()
    assert stored.session_id == "session_bob" and len(stored.event_id) == 36


def test_table_and_views(spark, sf):
    events = files.read_table(spark, f"{sf}/events.parquet", "parquet")
    files.register_views(spark, {"raw_events": events})
    assert spark.sql("SELECT count(*) AS n FROM raw_events").first().n == files.read_layer(spark, f"{sf}/events.parquet").count()


def test_generator_is_a_function_of_the_row(spark):
    once = synthetic.generate_ctr(500, spark)
    again = synthetic.generate_ctr(spark.range(500).selectExpr("id AS row_id").repartition(7))
    assert once.exceptAll(again).count() == 0
    share = once.agg({"label": "avg"}).first()[0]
    assert 0.4 < share < 0.6
    assert len(once.columns) == 41


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


NINE = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"


@pytest.mark.parametrize("malformed", ["keep", "drop", "fail"])
def test_csv_with_and_without_session(spark, tmp_path, malformed):
    line = "2024-01-01 10:00:00 UTC,view,1,2,a.b,x,1.5,7"
    (tmp_path / "nine.csv").write_text("\n".join([NINE, *[f"{line},s{i}" for i in range(5)]]))
    (tmp_path / "eight.csv").write_text("\n".join([NINE.rsplit(",", 1)[0], line, line]))
    for name, rows in (("nine.csv", 5), ("eight.csv", 2), ("", 7)):
        path = str(tmp_path / name)
        plain = files.read_events_csv(spark, path, malformed=malformed)
        assert plain.count() == rows and "user_session" not in plain.columns
        keyed = files.read_events_csv(spark, path, malformed=malformed, with_session=True)
        assert sorted(r.user_session or "" for r in keyed.collect()) == sorted(([f"s{i}" for i in range(5)] if "eight" not in name else []) + ([""] * 2 if "nine" not in name else []))
        assert files.read_event_rejects(spark, path).count() == 0
