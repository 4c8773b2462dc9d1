"""Membership at a date, household links and key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortweave.operators.spread import names, spread_join, window_join, with_group_values


def active_span_lookup(
    cohort: DataFrame,
    spans: DataFrame,
    at: str,
    intervals: list[tuple[str, str]],
    *,
    key: str = "person_id",
    latest: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Distinct ``keep`` columns of the spans active at the cohort date under every interval.

    Of several active spans those with the greatest ``latest`` date (by default the first
    interval's start) win; equal dates all stay.
    """
    latest = latest or intervals[0][0]
    keep = keep or ["household_id", key]
    columns = list(dict.fromkeys([key, latest, *keep, *[c for pair in intervals for c in pair]]))
    active = F.lit(True)
    for start, end in intervals:
        active = active & F.col(at).between(F.col(start), F.col(end))
    dates = cohort.select(key, at).distinct()
    joined = spread_join(spans.where(F.col(key).isNotNull()).select(*columns), dates, key, where=active)
    group = list(dict.fromkeys([key, *keep]))
    reduced = joined.groupBy(*group).agg(F.max(latest).alias("__latest"))
    best = with_group_values(reduced, key, __best=F.max("__latest"))
    return best.where(F.col("__latest") == F.col("__best")).select(*keep).distinct()


def link_by_household(
    cohort: DataFrame,
    households: DataFrame,
    members: DataFrame,
    pad_days: int = 7,
    *,
    mother: str = "person_id",
    start: str = "deliv_start_dt",
    end: str = "deliv_end_dt",
    birth: str = "birth_dt",
) -> DataFrame:
    """Distinct (household_id, mother_id, infant_id, infant_birth_dt) of births in the padded delivery window.

    Household members are compared by birth-date bucket, so a catch-all household is not
    compared all against all.
    """
    windows = (
        cohort.select(F.col(mother).alias("mother_id"), start, end)
        .join(households.select("household_id", F.col("person_id").alias("mother_id")).distinct(), "mother_id")
        .where(F.col("household_id").isNotNull())
        .select(
            "household_id",
            "mother_id",
            F.date_sub(start, pad_days).alias("__lo"),
            F.date_add(end, pad_days).alias("__hi"),
        )
        .distinct()
    )
    births = members.select(
        "household_id", F.col("person_id").alias("infant_id"), F.col(birth).alias("infant_birth_dt")
    ).where(F.col("household_id").isNotNull())
    linked = window_join(births, windows, "household_id", "infant_birth_dt", "__lo", "__hi", width_days=2 * pad_days + 16)
    return linked.select("household_id", "mother_id", "infant_id", "infant_birth_dt").distinct()


def group_proportions(df: DataFrame, groups: str | list[str], flag: str) -> DataFrame:
    """Count per (group, flag) and its share of the group."""
    by = names(groups)
    counts = df.groupBy(*by, flag).agg(F.count(F.lit(1)).alias("n"))
    # the window holds one row per flag value, not per input row
    return counts.withColumn("prop", F.col("n") / F.sum("n").over(Window.partitionBy(*by)))


def key_checks(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct keys, rows beyond the first of each key, rows without a key."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    known = F.when(F.col(key).isNotNull(), F.col("__n"))
    return per_key.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"),
        F.count(key).alias("n_keys"),
        (F.coalesce(F.sum(known), F.lit(0)) - F.count(key)).alias("n_repeats"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("__n"))), F.lit(0)).alias("n_null_keys"),
    )


def unmatched_keys(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks."""
    return left.select(key).subtract(right.select(F.col(right_key or key).alias(key)))
