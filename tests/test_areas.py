import numpy as np
import pytest

from basketlens.operators.areas import ranking_areas


def plain(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    roc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    points = []
    for s in sorted({s for _, s in rows}, reverse=True):
        tp, fp = sum(p >= s for p in pos), sum(n >= s for n in neg)
        points.append((tp / len(pos), tp / (tp + fp)))
    points = [(0.0, points[0][1]), *points]
    return round(roc, 6), round(sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:])), 6)


@pytest.mark.parametrize("levels", [2, 7, 10_000])
def test_areas_equal_all_pairs(spark, levels):
    draw = np.random.default_rng(levels)
    label = draw.integers(0, 2, 600)
    score = np.round(draw.integers(0, levels, 600) / levels + 0.3 * label, 6)
    score[::3] = 0.5  # a third of the rows share a score
    rows = list(zip(label.tolist(), score.tolist()))
    frame = spark.createDataFrame(rows + [(None, 0.1), (1, None), (0, float("nan"))], "y int, s double").repartition(5)
    got = ranking_areas(frame, "y", "s").first()
    assert tuple(got) == pytest.approx(plain(rows), abs=2e-6)


def test_one_label_and_no_rows(spark):
    frame = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y int, s double")
    assert tuple(ranking_areas(frame, "y", "s").first()) == (None, None)
    assert tuple(ranking_areas(frame.where("false"), "y", "s").first()) == (None, None)


def test_no_window_spans_all_scores(spark):
    frame = spark.range(1000).selectExpr("id % 2 AS y", "id / 10.0 AS s")
    plan = ranking_areas(frame, "y", "s")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition, ENSURE_REQUIREMENTS" in plan  # the last sum alone
    assert "[part#" in plan.split("Window ")[1].split("\n")[0]
