"""Exact weighted metrics of scored rows, by distributed prefix sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortweave.session import written

#: Probabilities are kept this far from 0 and 1 in a logarithm.
EPSILON = 1e-15


def usable(scored: DataFrame, label: str, weight: str, score: str) -> DataFrame:
    """Rows with a label, a weight and a score that is a number, all three as doubles."""
    typed = scored.withColumns({c: F.col(c).cast("double") for c in (label, weight, score)})
    return typed.where(F.col(label).isNotNull() & F.col(weight).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score))


def prefix_sums(df: DataFrame, by: Sequence[str], order: str, value: str, out: str) -> DataFrame:
    """Adds the sum of `value` over the rows of the same group that come before in `order`.

    One row per group and value of `order`. Rows are dealt out by ranges of (by, order), the
    ranges' totals are summed up, and a row's sum is the total of the ranges before its own
    plus the sum inside: no group is ordered by one task. The ranged rows are written, as both
    passes must see the same ranges.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(df.repartitionByRange(parts, *by, order).withColumn("__part", F.spark_partition_id()), "score-ranges")
    totals = ranged.groupBy(*by, "__part").agg(F.sum(value).alias("__total"))
    earlier = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*by, "__part", F.coalesce(F.sum("__total").over(earlier), F.lit(0.0)).alias("__start"))
    inside = Window.partitionBy(*by, "__part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    within = ranged.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0.0)))
    same = F.lit(True)
    for c in by:
        same = same & within[c].eqNullSafe(starts[c])
    joined = within.join(starts, same & (within["__part"] == starts["__part"]))
    return joined.select(*[within[c] for c in df.columns], (F.col("__start") + F.col("__inside")).alias(out))


def weighted_auc(
    scored: DataFrame, label: str = "obese", weight: str = "weight", score: str = "p1", by: Sequence[str] = ()
) -> DataFrame:
    """(by.., auc): the weighted chance that a positive scores above a negative, ties half.

    Exact: every distinct score is a step of the curve. NULL for a group without positives or
    without negatives; rows without label, weight or score take no part.
    """
    positive = F.when(F.col(label) == 1, F.col(weight)).otherwise(F.lit(0.0))
    steps = usable(scored, label, weight, score).groupBy(*by, score).agg(
        F.sum(positive).alias("__pos"), F.sum(F.col(weight) - positive).alias("__neg")
    )
    ranked = prefix_sums(steps, by, score, "__neg", "__below")
    wins = F.sum(F.col("__pos") * (F.col("__below") + F.col("__neg") / 2))
    return ranked.groupBy(*by).agg(F.try_divide(wins, F.sum("__pos") * F.sum("__neg")).alias("auc"))


def weighted_losses(
    scored: DataFrame, label: str = "obese", weight: str = "weight", score: str = "p1", by: Sequence[str] = ()
) -> DataFrame:
    """(by.., logloss, accuracy, n): weighted means over rows with label, weight and score; accuracy at 0.5."""
    p = F.greatest(F.least(F.col(score), F.lit(1 - EPSILON)), F.lit(EPSILON))
    loss = -F.when(F.col(label) == 1, F.log(p)).otherwise(F.log(F.lit(1.0) - p))
    right = ((F.col(score) > 0.5) == (F.col(label) == 1)).cast("double")
    total = F.sum(weight)
    return usable(scored, label, weight, score).groupBy(*by).agg(
        F.try_divide(F.sum(loss * F.col(weight)), total).alias("logloss"),
        F.try_divide(F.sum(right * F.col(weight)), total).alias("accuracy"),
        F.count(F.lit(1)).alias("n"),
    )


def calibration(
    scored: DataFrame, bins: int = 10, label: str = "obese", weight: str = "weight", score: str = "p1", by: Sequence[str] = ()
) -> DataFrame:
    """(by.., bin, n, mean_score, rate): weighted mean score and share of positives in equal ranges of the score."""
    at = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int").alias("bin")
    kept = usable(scored, label, weight, score)
    return kept.groupBy(*by, at).agg(
        F.count(F.lit(1)).alias("n"),
        F.try_divide(F.sum(F.col(score) * F.col(weight)), F.sum(weight)).alias("mean_score"),
        F.try_divide(F.sum(F.when(F.col(label) == 1, F.col(weight)).otherwise(0.0)), F.sum(weight)).alias("rate"),
    )
