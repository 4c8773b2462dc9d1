"""Gap episodes and latest-date rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortweave.functions.fixed_values import DELIVERY_FAMILIES, EPISODE_GAP_DAYS
from cohortweave.functions.rules import label_rules
from cohortweave.operators.codes import flag_columns
from cohortweave.operators.spread import names, spread_join, with_group_values


def _number_days(days: DataFrame, keys: list[str], from_dt: str, max_gap: int) -> DataFrame:
    """Episode number per (key, day). A window holds distinct days of one key, so the calendar bounds it."""
    by_day = Window.partitionBy(*keys).orderBy(F.col(from_dt).asc_nulls_last())
    gap = F.datediff(F.col(from_dt), F.lag(from_dt).over(by_day))
    starts = F.when(gap > max_gap, F.lit(1)).otherwise(F.lit(0))
    running = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        days.withColumn("__new", starts).withColumn("episode", F.sum("__new").over(running).cast("int")).drop("__new")
    )


def gap_episodes(
    df: DataFrame, key: str | list[str] = "person_id", from_dt: str = "from_dt", max_gap: int = EPISODE_GAP_DAYS
) -> DataFrame:
    """Rows with their episode number: a new one starts when the previous from-date is over ``max_gap`` days back.

    Rows of one day share an episode, so numbering runs on each key's distinct days and is
    joined back on (key, day).
    """
    keys = names(key)
    days = df.select(*keys, from_dt).distinct()
    numbered = _number_days(days, keys, from_dt, max_gap)
    return spread_join(df, numbered, [*keys, from_dt], "left", null_safe=True)


def episode_spans(
    df: DataFrame,
    key: str | list[str] = "person_id",
    from_dt: str = "from_dt",
    to_dt: str = "to_dt",
    max_gap: int = EPISODE_GAP_DAYS,
) -> DataFrame:
    """(key, episode, start_dt, end_dt, n_events) straight from events, one shuffle of per-day rows."""
    keys = names(key)
    days = df.groupBy(*keys, from_dt).agg(F.max(to_dt).alias("__to"), F.count(F.lit(1)).alias("__n"))
    return (
        _number_days(days, keys, from_dt, max_gap)
        .groupBy(*keys, "episode")
        .agg(F.min(from_dt).alias("start_dt"), F.max("__to").alias("end_dt"), F.sum("__n").alias("n_events"))
    )


def singleton_rules():
    """Z codes decide before O codes, singleton before multiple."""
    return [
        (F.col("singleton_z") == 1, 1),
        (F.col("singleton_o") == 1, 1),
        (F.col("multiple_z") == 1, 0),
        (F.col("multiple_o") == 1, 0),
    ]


def episode_summary(
    df: DataFrame,
    key: str = "person_id",
    from_dt: str = "from_dt",
    to_dt: str = "to_dt",
    code_col: str = "id_code",
    families: dict[str, tuple[list[str], int | None]] | None = None,
    max_gap: int = EPISODE_GAP_DAYS,
) -> DataFrame:
    """One row per delivery episode: dates, span in days, code-family flags and the singleton label.

    Events shrink to (key, day) with map-side combination before any window sees them.
    """
    families = families or DELIVERY_FAMILIES
    flags = flag_columns(code_col, families)
    days = df.groupBy(key, from_dt).agg(F.max(to_dt).alias("__to"), *[F.max(c).alias(n) for n, c in flags.items()])
    episodes = (
        _number_days(days, [key], from_dt, max_gap)
        .groupBy(key, F.col("episode").alias("deliv_id"))
        .agg(
            F.min(from_dt).alias("deliv_start_dt"),
            F.max("__to").alias("deliv_end_dt"),
            *[F.max(n).alias(n) for n in flags],
        )
        .withColumn("deliv_claims_days", F.datediff("deliv_end_dt", "deliv_start_dt"))
    )
    return label_rules(episodes, "singleton", singleton_rules())


def latest_rows(
    df: DataFrame,
    key: str | list[str],
    dt: str,
    first: str | None = None,
    last: str | None = None,
    *,
    per_day: bool = False,
) -> DataFrame:
    """All rows of each key's most recent date in [first, last]; ties stay.

    ``per_day`` says that a key has at most a few rows per date (a table grouped by key and
    day, say). A window over a key's rows is then bounded by the calendar and cheaper than
    joining the latest date back.
    """
    if first is not None:
        df = df.where(F.col(dt) >= F.lit(first).cast("date"))
    if last is not None:
        df = df.where(F.col(dt) <= F.lit(last).cast("date"))
    if per_day:
        newest = Window.partitionBy(*names(key)).orderBy(F.col(dt).desc())
        return df.where(F.col(dt).isNotNull()).withColumn("__rank", F.rank().over(newest)).where(F.col("__rank") == 1).drop("__rank")
    return with_group_values(df, key, __latest=F.max(dt)).where(F.col(dt) == F.col("__latest")).drop("__latest")
