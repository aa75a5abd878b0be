import math
import random

import numpy as np
import pytest

from basketlens.operators import clean, metrics, quantiles


def plain(values, q):
    known = sorted(v for v in values if v is not None and math.isfinite(v))
    return float(np.quantile(known, q)) if known else None


def columns(seed, n=3000):
    draw = random.Random(seed)
    hot = [19.99 if draw.random() < 0.4 else round(draw.expovariate(0.01), 2) for _ in range(n)]
    wide = [draw.choice((-1, 1)) * 10.0 ** draw.randint(-300, 300) for _ in range(n)]
    odd = [draw.choice([None, math.nan, math.inf, -math.inf, 0.0, -0.0, 1e308, -1e308, 5e-324]) for _ in range(n)]
    same = [7.25] * n
    none = [None] * n
    return {"hot": hot, "wide": wide, "odd": odd, "same": same, "none": none, "few": [1.0, 2.0] + [None] * (n - 2)}


@pytest.mark.parametrize("q, bins", [(0.5, 4096), (0.37, 16), (1.0, 64)])
def test_equals_sorting(spark, q, bins):
    data = columns(bins)
    frame = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"{c} double" for c in data)).repartition(3)
    got = quantiles.exact_quantile(frame, list(data), q, bins)
    for name, values in data.items():
        want = plain(values, q)
        assert got[name] == want or math.isclose(got[name], want, rel_tol=1e-12), name


def test_no_rows(spark):
    assert quantiles.exact_quantile(spark.createDataFrame([], "a double, b int"), ["a", "b"]) == {"a": None, "b": None}


def test_even_counts_take_the_mean_of_the_middle(spark):
    assert quantiles.exact_quantile(spark.createDataFrame([(1,), (2,), (10,), (20,)], "a int"), ["a"]) == {"a": 6.0}


def test_rounds_give_bins_not_values(spark):
    frame = spark.range(50_000).selectExpr("id * 0.37 AS v")
    found = quantiles._histograms(frame, ["v"], [(0, 0.0, 18499.63)], 100)
    assert 0 < found.count() <= 100 and found.agg({"n": "sum"}).first()[0] == 50_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_reports_and_fills_use_it(spark, make_events):
    events = make_events([(i, "view", i, "a.b", "x", float(p), 1) for i, p in enumerate((3, 1, 2, 100))])
    assert metrics.ingest_stats(events, exact_median=True).first().price_median == 2.5
    clicks = spark.createDataFrame([(1.0, "a"), (None, None), (4.0, "b"), (10.0, "c")], "I1 double, C1 string")
    assert [r.I1 for r in clean.fill_median(clicks, exact=True).collect()] == [1.0, 4.0, 4.0, 10.0]
