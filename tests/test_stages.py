import os

from pyspark.sql import functions as F

from basketlens.models import click, item2vec, recommend
from basketlens.operators import tables
from basketlens.plans import stages
from basketlens.sources import testbed


def test_full_run(spark, sf, tmp_path):
    """Raw CSV to models and reports, each stage from the stored layer before it."""
    raw = testbed.raw_text_events(spark, sf).select(
        "event_time", "event_type", "product_id", F.lit(1).alias("category_id"), "category_code", "brand", "price", "user_id", "user_session"
    )
    raw.write.option("header", True).csv(f"{tmp_path}/raw")
    layout = stages.Layout(f"{tmp_path}/lake")
    stages.bronze(spark, layout, f"{tmp_path}/raw", synthetic_rows=500)
    events = spark.read.parquet(layout.bronze_events)
    assert events.count() == testbed.shop_events(spark, sf).count()
    assert events.select("event_id").distinct().count() == events.count()

    status = {r.dataset: r.status for r in stages.quality_gate(spark, layout, min_users=1, min_products=1).collect()}
    assert status == {"events": "WARN", "clicks": "WARN"}

    stages.gold(spark, layout)
    assert spark.read.parquet(layout.path("gold", "daily_metrics")).count() == 30

    stages.speed(spark, layout, slices=3)
    assert len(os.listdir(layout.path("speed", "streams"))) == 1

    assert set(stages.serving(spark, layout).values()) == {0}
    assert set(stages.serving(spark, layout).values()) == {1}
    history = tables.VersionedTable(spark, layout.path("serving", "brand_metrics")).history().collect()
    assert [(r.version, r.operation) for r in history] == [(0, "insert"), (1, "upsert")]
    assert history[0].rows == history[1].rows

    sizes = stages.Sizes(
        trees=click.GbtSize(2, 2, 16, 0.1, 1.0, "auto"),
        als=recommend.AlsSize(3, 1, blocks=2),
        item2vec=item2vec.Item2VecSize(4, 1, 3, 1, 1),
        clusters=3,
    )
    summary = stages.learning(spark, layout, sizes).first()
    assert summary.item_vectors > 0 and 0 <= summary.ctr_auc_roc <= 1

    for name, frame in stages.reports(spark, layout).items():
        assert frame.count() > 0, name
    assert spark.sql("SELECT count(*) AS n FROM events").first().n == events.count()
