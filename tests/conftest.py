import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketlens.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = get_spark(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": f"file://{base}/warehouse",
            "spark.checkpoint.dir": f"file://{base}/shared",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


EVENT_COLUMNS = "event_id long, event_time timestamp_ntz, event_type string, product_id long, category_code string, brand string, price double, user_id long"


@pytest.fixture
def make_events(spark):
    """Canonical events from short tuples (second, type, product, category, brand, price, user)."""
    import datetime as dt

    from basketlens.operators.clean import clean_events

    start = dt.datetime(2024, 1, 1, 10)

    def build(rows):
        raw = [
            (i, start + dt.timedelta(seconds=second), kind, product, category, brand, price, user)
            for i, (second, kind, product, category, brand, price, user) in enumerate(rows)
        ]
        return clean_events(spark.createDataFrame(raw, EVENT_COLUMNS))

    return build
