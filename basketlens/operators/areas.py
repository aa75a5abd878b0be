"""Exact areas under the ROC and precision-recall curves of stored scores.

Rows are counted by score first, so ties are one point and a score that a third
of the rows share is one row. The scores are dealt into ranges; each range adds
up its own counts and starts from the sums of the ranges above it. No window
spans all scores, and only one row a range reaches the driver.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.session import materialise

DIGITS = 6


def ranking_areas(scored: DataFrame, label: str, score: str) -> DataFrame:
    """(auc_roc, auc_pr) of labels 1 and 0 by falling score, in one row; null without rows of both labels.

    Ties count half. The precision-recall curve starts at recall 0 with its first
    precision and is linear between scores. Rows without a score or label, and
    NaN scores, are left out.
    """
    spark = scored.sparkSession
    value = F.col(score).cast("double")
    points = scored.select(value.alias("score"), F.col(label).alias("y")).where("score IS NOT NULL AND NOT isnan(score) AND y IN (0, 1)")
    counts = points.groupBy("score").agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    dealt = counts.repartitionByRange(F.desc("score")).withColumn("part", F.spark_partition_id())
    dealt = materialise(dealt, "score-counts")
    sums = dealt.groupBy("part").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).orderBy("part").collect()  # a row a range
    above = [(0, 0), *accumulate(((r["pos"], r["neg"]) for r in sums), lambda a, b: (a[0] + b[0], a[1] + b[1]))]
    all_pos, all_neg = above[-1]
    starts = spark.createDataFrame([(r["part"], *a) for r, a in zip(sums, above)], "part int, pos_above long, neg_above long")
    order = Window.partitionBy("part").orderBy(F.desc("score"))
    # One row a range by construction.
    run = dealt.join(F.broadcast(starts), "part").select(
        "pos",
        "neg",
        (F.col("pos_above") + F.sum("pos").over(order)).alias("tp"),
        (F.col("neg_above") + F.sum("neg").over(order)).alias("fp"),
    )
    before = (F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg"))
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    earlier = F.when(before[0] + before[1] > 0, F.try_divide(before[0], before[0] + before[1])).otherwise(precision)
    twice = F.sum((F.col("neg") * (2 * before[0] + F.col("pos"))).cast("decimal(38,0)")).cast("double")
    areas = run.agg(twice.alias("_roc"), F.sum(F.col("pos") * (precision + earlier) / 2).alias("_pr"))
    known = F.lit(bool(all_pos and all_neg))
    return areas.select(
        F.when(known, F.round(F.col("_roc") / max(1.0, 2.0 * all_pos * all_neg), DIGITS)).alias("auc_roc"),
        F.when(known, F.round(F.col("_pr") / max(1.0, float(all_pos)), DIGITS)).alias("auc_pr"),
    )
