"""Joins that stay balanced when one key holds a large share of the rows.

AQE splits a skewed partition only where both join inputs are plain shuffles. A
side that was just grouped by the join key keeps that partitioning, so AQE sees no
shuffle there and leaves the hot partition whole. The helpers below slice hot keys
explicitly instead: the many-row side gets a slice number, the few-row side is
repeated once per slice, and the join runs on (key, slice).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_TASK = 4_000_000


def rows_per_task(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.cohortweave.rowsPerTask", str(ROWS_PER_TASK)))


def names(value: str | list[str] | tuple[str, ...]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def hot_keys(df: DataFrame, keys: str | list[str]) -> DataFrame:
    """Keys with more rows than one task should take, with the number of slices to cut them into.

    The count combines map-side. There can be at most rows(df) / rows_per_task such keys.
    """
    keys = names(keys)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return _slices_from_counts(counted, keys)


def _slices_from_counts(counted: DataFrame, keys: list[str]) -> DataFrame:
    limit = rows_per_task(counted.sparkSession)
    return counted.where(F.col("__n") > limit).select(*keys, F.ceil(F.col("__n") / limit).cast("int").alias("__slices"))


def _join_condition(keys: list[str], prefix: str, null_safe: bool) -> Column:
    def same(k: str) -> Column:
        return F.col(k).eqNullSafe(F.col(prefix + k)) if null_safe else F.col(k) == F.col(prefix + k)

    return reduce(lambda a, b: a & b, [same(k) for k in keys])


def _mark(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    # broadcast is bounded: see hot_keys
    small = F.broadcast(hot.select(*[F.col(k).alias("__h_" + k) for k in keys], "__slices"))
    return df.join(small, _join_condition(keys, "__h_", True), "left").drop(*["__h_" + k for k in keys])


def spread_join(
    many: DataFrame,
    few: DataFrame,
    on: str | list[str],
    how: str = "inner",
    *,
    where: Column | None = None,
    hot: DataFrame | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Equi-join of a side whose keys may be hot (``many``) with a side of few rows per key.

    ``how`` is any join type that preserves only ``many`` (inner, left, left_semi,
    left_anti). ``where`` adds a non-equi condition; column names other than the keys
    must differ between the sides. ``hot`` may be passed when the key counts of the
    source are known already (a count per key that is too high does no harm). Select
    the needed columns of ``many`` first: the slice number is a hash of its row.
    """
    keys = names(on)
    hot = hot_keys(many, keys) if hot is None else hot
    # The row hash and the input partition fix the slice, so a recomputed task sends
    # every row to the slice it had before, and copies of one row still spread out.
    slice_no = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in many.columns]), F.col("__slices"))
    left = (
        _mark(many, hot, keys)
        .withColumn("__slice", F.when(F.col("__slices").isNull(), F.lit(0)).otherwise(slice_no.cast("int")))
        .drop("__slices")
    )
    right = _mark(few, hot, keys)
    right = right.select(
        *[F.col(k).alias("__r_" + k) for k in keys],
        *[c for c in few.columns if c not in keys],
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__slices"), F.lit(1)) - 1)).alias("__r_slice"),
    )
    condition = _join_condition(keys, "__r_", null_safe) & (F.col("__slice") == F.col("__r_slice"))
    if where is not None:
        condition = condition & where
    joined = left.join(right, condition, how)
    return joined.drop("__slice", "__r_slice", *["__r_" + k for k in keys])


def with_group_values(df: DataFrame, keys: str | list[str], **aggregates: Column) -> DataFrame:
    """Attach aggregates of each row's group, as a window without order would, NULL keys included.

    Groups are combined map-side and joined back slice by slice, so a group is never
    collected into one task.
    """
    keys = names(keys)
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), *[value.alias(name) for name, value in aggregates.items()]
    )
    hot = _slices_from_counts(grouped, keys)
    return spread_join(df, grouped.drop("__n"), keys, "left", hot=hot, null_safe=True)


def day_bucket(day: Column, width_days: int) -> Column:
    return F.floor(F.unix_date(day) / width_days).cast("int")


def window_join(
    points: DataFrame,
    windows: DataFrame,
    on: str | list[str],
    point: str,
    start: str,
    end: str,
    *,
    width_days: int,
) -> DataFrame:
    """Pairs with equal keys and ``start <= point <= end`` (dates), both sides many rows per key.

    A window is listed under every date bucket it touches and a point lies in exactly
    one, so each pair arises once and a crowded key is compared bucket by bucket
    instead of all against all.
    """
    keys = names(on)
    pts = points.where(F.col(point).isNotNull()).withColumn("__bucket", day_bucket(F.col(point), width_days))
    win = windows.where(F.col(start) <= F.col(end)).withColumn(
        "__bucket",
        F.explode(F.sequence(day_bucket(F.col(start), width_days), day_bucket(F.col(end), width_days))),
    )
    joined = spread_join(pts, win, [*keys, "__bucket"], where=F.col(point).between(F.col(start), F.col(end)))
    return joined.drop("__bucket")
