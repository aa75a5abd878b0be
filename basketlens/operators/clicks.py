"""Aggregates over click rows: one pass each, however many features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.constants import CTR_LABEL, CTR_NUMERIC
from basketlens.operators.metrics import rows


def _per_feature(totals: DataFrame, values: dict[str, list[Column]], outputs: list[str]) -> DataFrame:
    """Turn one wide row into a row per feature."""
    records = [
        F.struct(F.lit(name).alias("feature"), *[value.alias(out) for value, out in zip(columns, outputs)])
        for name, columns in values.items()
    ]
    return totals.select(F.inline(F.array(*records)))


def label_counts(clicks: DataFrame) -> DataFrame:
    """Rows and share of each label."""
    counts = clicks.groupBy(CTR_LABEL).agg(rows().alias("cnt"))
    total = counts.agg(F.sum("cnt")).scalar()
    return counts.select(CTR_LABEL, "cnt", (F.col("cnt") * F.lit(100.0) / total).alias("percentage"))


def ctr_ingest_stats(clicks: DataFrame) -> DataFrame:
    """Rows, labels, click rate and nulls of every numeric feature."""
    totals = clicks.agg(
        rows().alias("total_rows"),
        F.count_if(F.col(CTR_LABEL) == 0).alias("label_0"),
        F.count_if(F.col(CTR_LABEL) == 1).alias("label_1"),
        *[F.count_if(F.col(name).isNull()).alias(f"{name}_nulls") for name in CTR_NUMERIC],
    )
    rate = F.when(F.col("total_rows") > 0, F.col("label_1") / F.col("total_rows")).otherwise(F.lit(0.0))
    return totals.withColumn("ctr", rate)


def top_null_features(clicks: DataFrame, n: int = 5) -> DataFrame:
    """Numeric features with the most nulls."""
    totals = clicks.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in CTR_NUMERIC])
    listed = _per_feature(totals, {name: [F.col(name)] for name in CTR_NUMERIC}, ["nulls"])
    return listed.orderBy(F.desc("nulls"), "feature").limit(n)


def missing_pct(clicks: DataFrame) -> DataFrame:
    """Share of null and of zero values per numeric feature."""
    totals = clicks.agg(
        rows().alias("_n"),
        *[F.count_if(F.col(name).isNull()).alias(f"{name}_null") for name in CTR_NUMERIC],
        *[F.count_if(F.col(name) == 0).alias(f"{name}_zero") for name in CTR_NUMERIC],
    )

    def pct(name: str) -> Column:
        return F.when(F.col("_n") > 0, F.col(name) * F.lit(100.0) / F.col("_n"))

    values = {name: [pct(f"{name}_null"), pct(f"{name}_zero")] for name in CTR_NUMERIC}
    return _per_feature(totals, values, ["null_pct", "zero_pct"])


def label_correlation(clicks: DataFrame) -> DataFrame:
    """Pearson correlation of each numeric feature with the label."""
    totals = clicks.agg(*[F.corr(name, F.col(CTR_LABEL).cast("double")).alias(name) for name in CTR_NUMERIC])
    values = {name: [F.coalesce(F.nanvl(F.col(name), F.lit(0.0)), F.lit(0.0))] for name in CTR_NUMERIC}
    return _per_feature(totals, values, ["correlation"]).orderBy(F.desc(F.abs("correlation")), "feature")


def feature_histograms(clicks: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width histogram of every numeric feature between its extremes.

    The extremes of all features arrive as one scalar value, so nothing is
    joined; each row becomes 13 (place, value) pairs, which combine to at most
    ``13 * bins`` groups before the shuffle. One short expression bins the pairs
    of all features: spelt out by feature, the generated method is too long for
    the JVM to compile.
    """
    values = [F.col(name).cast("double") for name in CTR_NUMERIC]
    lows, highs = F.array(*map(F.min, values)).alias("lows"), F.array(*map(F.max, values)).alias("highs")
    bounds = clicks.agg(F.struct(lows, highs)).scalar()
    pairs = clicks.select(F.posexplode(F.array(*values)).alias("place", "value")).filter(F.col("value").isNotNull())
    low, high = F.get(bounds["lows"], F.col("place")), F.get(bounds["highs"], F.col("place"))
    cell = F.col("place") * bins + _slot(F.col("value"), low, high, bins)
    counted = pairs.groupBy(cell.alias("cell"))
    found = counted.agg(rows().alias("n"), F.min("value").alias("bin_min"), F.max("value").alias("bin_max"))
    feature = F.get(F.array(*map(F.lit, CTR_NUMERIC)), F.floor(F.col("cell") / bins).cast("int"))
    return found.select(feature.alias("feature"), F.pmod("cell", F.lit(bins)).alias("bin"), "n", "bin_min", "bin_max")


def _slot(value: Column, low: Column, high: Column, bins: int) -> Column:
    position = F.floor((value - low) * F.lit(float(bins)) / (high - low))
    return F.when(high > low, F.least(position, F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
