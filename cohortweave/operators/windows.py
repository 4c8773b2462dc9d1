"""Delivery anchors, look-back flags and exclusion windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortweave.operators.codes import flag_columns


def anchor_and_window(
    cohort: DataFrame,
    links: DataFrame,
    before_weeks: int = 44,
    after_weeks: int = 26,
    max_span: int = 60,
    *,
    mother: str = "person_id",
    start: str = "deliv_start_dt",
    span: str = "deliv_claims_days",
) -> DataFrame:
    """One delivery date and claim window per mother.

    The infant's birth date is the delivery date; without one, the claim start if the
    claims span at most ``max_span`` days. Twins collapse to the earliest date and the
    widest window.
    """
    births = links.select("mother_id", "infant_birth_dt").distinct()
    dated = (
        cohort.select(F.col(mother).alias("mother_id"), start, span)
        .join(births, "mother_id", "left")
        .withColumn(
            "delivery_dt",
            F.when(F.col("infant_birth_dt").isNotNull(), F.col("infant_birth_dt")).when(
                F.col(span) <= max_span, F.col(start)
            ),
        )
    )
    return dated.groupBy("mother_id").agg(
        F.min("delivery_dt").alias("delivery_dt"),
        F.min(F.date_sub("delivery_dt", 7 * before_weeks)).alias("claim_window_start_dt"),
        F.max(F.date_add("delivery_dt", 7 * after_weeks)).alias("claim_window_end_dt"),
    )


def weekly_histogram(df: DataFrame, dt: str) -> DataFrame:
    """Rows per calendar week (Monday start)."""
    week = F.date_trunc("week", F.col(dt)).cast("date")
    return df.where(F.col(dt).isNotNull()).groupBy(week.alias("week_dt")).agg(F.count(F.lit(1)).alias("n"))


def current_and_prior_flags(
    daily: DataFrame,
    flags: list[str],
    first: str,
    last: str,
    days: int = 365,
    *,
    key: str = "cust_id",
    dt: str = "event_dt",
    prefix: str = "prior_",
) -> DataFrame:
    """(key, index_dt, flags, prior flags) from a table of one row per key and day.

    The index date is the key's latest day in [first, last]; current flags are of that day,
    prior flags of the days in [index - days, index - 1]. One shuffle on the key gives all:
    the window holds a key's days, and the final grouping reuses its partitioning.
    """
    in_period = F.col(dt).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    latest = F.max(F.when(in_period, F.col(dt))).over(Window.partitionBy(key))
    indexed = daily.where(F.col(dt) <= F.lit(last).cast("date")).withColumn("index_dt", latest)
    today = F.col(dt) == F.col("index_dt")
    earlier = F.datediff(F.col("index_dt"), F.col(dt)).between(1, days)
    return (
        indexed.where(today | earlier)
        .groupBy(key, "index_dt")
        .agg(
            *[F.max(F.when(today, F.col(f))).alias(f) for f in flags],
            *[F.coalesce(F.max(F.when(earlier, F.col(f))), F.lit(0)).alias(prefix + f) for f in flags],
        )
    )


def lookback_flags(
    index: DataFrame,
    events: DataFrame,
    families: dict[str, tuple[list[str], int | None]],
    days: int = 365,
    *,
    key: str = "cust_id",
    index_dt: str = "index_dt",
    event_dt: str = "event_dt",
    code_col: str = "diag_cd",
    prefix: str = "prior_",
) -> DataFrame:
    """Code-family flags per key from events in [index - days, index - 1]; keys without such events are absent.

    Events shrink to one row per (key, day) before the join.
    """
    flags = flag_columns(code_col, families)
    daily = (
        events.where(F.col(key).isNotNull())
        .groupBy(key, event_dt)
        .agg(*[F.max(c).alias(prefix + n) for n, c in flags.items()])
    )
    index_days = index.select(key, index_dt).distinct()
    near = F.datediff(F.col(index_dt), F.col(event_dt)).between(1, days)
    return (
        daily.join(index_days, key).where(near).groupBy(key).agg(*[F.max(prefix + n).alias(prefix + n) for n in flags])
    )


def pregnancy_days(
    events: DataFrame,
    inclusion: list[str],
    exclusion: list[str],
    delivery: list[str],
    *,
    key: str = "cust_id",
    dt: str = "event_dt",
    code_col: str = "diag_cd",
) -> DataFrame:
    """(key, date, assignment): 'd' with any delivery code, else 'p' if included and not excluded."""
    families = {"p_incl": (inclusion, None), "p_excl": (exclusion, None), "d_incl": (delivery, None)}
    daily = events.groupBy(key, dt).agg(*[F.max(c).alias(n) for n, c in flag_columns(code_col, families).items()])
    assignment = F.when(F.col("d_incl") == 1, "d").when((F.col("p_incl") == 1) & (F.col("p_excl") == 0), "p")
    return daily.select(key, dt, assignment.alias("assignment")).where(F.col("assignment").isNotNull())


def exclusion_windows(
    days: DataFrame,
    drg_days: DataFrame,
    *,
    key: str = "cust_id",
    dt: str = "event_dt",
    before_months: int = 9,
    pregnancy_after: int = 12,
    delivery_after: int = 6,
) -> DataFrame:
    """(key, exclude_start, exclude_end) around pregnancy and delivery claim dates.

    Deliveries come from diagnosis days and from DRG days. A pregnancy claim inside one of
    the person's delivery windows gives no window of its own. Months roll back to the
    month's end.

    Window ends move with the delivery date, so a claim lies in some delivery's window just
    when it lies in that of the last delivery up to it or of the next one after it. Both
    come from one window over the person's distinct days; nothing is joined.
    """
    merged = (
        days.select(key, dt, (F.col("assignment") == "d").alias("__d"))
        .union(drg_days.select(key, dt, F.lit(True).alias("__d")))
        .groupBy(key, dt)
        .agg(F.max("__d").alias("__d"))
    )
    by_day = Window.partitionBy(key).orderBy(dt)
    delivery_day = F.when(F.col("__d"), F.col(dt))
    last = F.max(delivery_day).over(by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    following = F.min(delivery_day).over(by_day.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    covered = F.coalesce(F.col(dt) <= F.add_months("__last", delivery_after), F.lit(False)) | F.coalesce(
        F.col(dt) >= F.add_months("__next", -before_months), F.lit(False)
    )
    return (
        merged.withColumns({"__last": last, "__next": following})
        .where(F.col("__d") | ~covered)
        .select(
            key,
            F.add_months(dt, -before_months).alias("exclude_start"),
            F.add_months(dt, F.when(F.col("__d"), delivery_after).otherwise(pregnancy_after)).alias("exclude_end"),
        )
    )


def exclude_in_windows(rows: DataFrame, windows: DataFrame, key: str = "cust_id", dt: str = "index_dt") -> DataFrame:
    """Rows whose date lies in none of their key's windows.

    Rows are labels, one or a few per key; a key's distinct windows are bounded by the calendar.
    """
    spans = windows.select(F.col(key).alias("__key"), "exclude_start", "exclude_end").distinct()
    inside = F.col(dt).between(F.col("exclude_start"), F.col("exclude_end"))
    return rows.join(spans, (F.col(key) == F.col("__key")) & inside, "left_anti")
