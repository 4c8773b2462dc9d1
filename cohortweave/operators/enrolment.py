"""Enrolment counted at month marks, and membership in a period."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.operators.spread import spread_join

BITS = 60


def marks_covered(first: dt.date, count: int, start: str, end: str, half_open: bool) -> Column:
    """Aggregate: number of month marks, ``count`` of them from ``first`` on, that a group's spans cover.

    A span covers a run of marks whose ends follow from its dates by arithmetic. It sets
    those bits and the group ORs them, so the shuffle carries a long per person and 60
    marks, and no row is multiplied by the marks.
    """
    if first.day > 28:
        raise ValueError("marks must fall on a day that every month has")
    base = first.year * 12 + first.month

    def month_no(day: Column) -> Column:
        return F.year(day) * 12 + F.month(day) - base

    until = F.date_sub(F.col(end), 1) if half_open else F.col(end)
    lowest = month_no(F.col(start)) + F.when(F.day(start) > first.day, 1).otherwise(0)
    highest = month_no(until) - F.when(F.day(until) < first.day, 1).otherwise(0)
    one = F.lit(1).cast("long")
    counts = []
    for at in range(0, count, BITS):
        low = F.greatest(lowest, F.lit(at))
        high = F.least(highest, F.lit(min(at + BITS, count) - 1))
        run = F.call_function("shiftleft", one, high - low + 1) - one
        known = F.col(start).isNotNull() & F.col(end).isNotNull()
        mask = F.when(known & (low <= high), F.call_function("shiftleft", run, low - at)).otherwise(F.lit(0).cast("long"))
        counts.append(F.bit_count(F.bit_or(mask)))
    return reduce(lambda a, b: a + b, counts).cast("int")


def _months_back(day: dt.date, months: int) -> dt.date:
    year, month = divmod(day.year * 12 + day.month - 1 - months, 12)
    return day.replace(year=year, month=month + 1)


def enrolled_k_of_n(
    spans: DataFrame,
    end_dt: dt.date,
    n: int = 6,
    k: int = 4,
    *,
    key: str = "person_id",
    start: str = "start_dt",
    end: str = "end_dt",
) -> DataFrame:
    """(key, n_months) of people covered at k or more of the last n month marks, start <= mark < end."""
    covered = marks_covered(_months_back(end_dt, n - 1), n, start, end, True)
    return spans.groupBy(key).agg(covered.alias("n_months")).where(F.col("n_months") >= k)


def months_enrolled(
    spans: DataFrame,
    first: dt.date,
    months: int = 24,
    *,
    key: str = "person_id",
    start: str = "start_dt",
    end: str = "end_dt",
) -> DataFrame:
    """(key, months_enrolled) over consecutive month marks, both span ends included; people with 0 stay."""
    return spans.groupBy(key).agg(marks_covered(first, months, start, end, False).alias("months_enrolled"))


def enrolment_thresholds(df: DataFrame, thresholds: dict[str, Column] | None = None) -> DataFrame:
    """0/1 columns for full, 12+ and 6+ months; NULL months give NULL."""
    months = F.col("months_enrolled")
    thresholds = thresholds or {
        "enroll_24mo": months == 24,
        "enroll_12mo": months >= 12,
        "enroll_6mo": months >= 6,
    }
    return df.withColumns({name: condition.cast("int") for name, condition in thresholds.items()})


def members_in_period(
    membership: DataFrame,
    persons: DataFrame | None,
    first: str,
    last: str,
    born_by: str | None = None,
    *,
    key: str = "person_id",
    intervals: list[tuple[str, str]] = (("eff_dt", "end_dt"), ("benefit_eff_dt", "benefit_end_dt")),
    birth: str = "birth_dt",
) -> DataFrame:
    """Membership rows whose every date range overlaps the period, of people born by a date."""
    lo, hi = F.lit(first).cast("date"), F.lit(last).cast("date")
    overlap = reduce(lambda a, b: a & b, [(F.col(end) >= lo) & (F.col(start) <= hi) for start, end in intervals])
    rows = membership.where(overlap)
    if persons is None:
        return rows
    people = persons if born_by is None else persons.where(F.col(birth) <= F.lit(born_by).cast("date"))
    return spread_join(rows.where(F.col(key).isNotNull()), people, key)
