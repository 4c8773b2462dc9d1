"""Risk scores, referrals and the study cohort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortweave.functions.rules import label_rules
from cohortweave.operators.spread import day_bucket, spread_join


def high_scores(
    scores: DataFrame, first: str, last: str, cut: float = 0.10, dt: str = "score_dt", score: str = "score"
) -> DataFrame:
    """Scores run in the period (inclusive) that lie strictly above the cut."""
    return scores.where(
        F.col(score).isNotNull()
        & F.col(dt).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        & (F.col(score) > cut)
    )


def score_referral(
    scores: DataFrame,
    tracking: DataFrame,
    max_days: int = 60,
    *,
    key: str = "person_id",
    score_dt: str = "score_dt",
    file_dt: str = "file_date",
) -> DataFrame:
    """Scores of people never sent, and (score, referral) pairs with the file date 0..max_days later.

    A person with referrals of which none is in time drops out; a referral without a file
    date pairs with every score. Referrals are compared by date bucket, so a person with
    very many scores and referrals is not compared all against all.
    """
    width = max_days + 1
    scored = scores.where(F.col(key).isNotNull()).distinct()
    sent_rows = tracking.where(F.col(key).isNotNull()).distinct()
    sent_people = sent_rows.select(key).distinct()
    unsent = spread_join(scored, sent_people, key, "left_anti")

    undated = F.lit(-(2**30))
    first_bucket = day_bucket(F.col(score_dt), width)
    last_bucket = day_bucket(F.date_add(score_dt, max_days), width)
    wide = scored.withColumn("__bucket", F.explode(F.array_distinct(F.array(undated, first_bucket, last_bucket))))
    dated = sent_rows.withColumn("__bucket", F.coalesce(day_bucket(F.col(file_dt), width), undated))
    in_time = F.col(file_dt).isNull() | F.col(file_dt).between(F.col(score_dt), F.date_add(score_dt, max_days))
    sent = spread_join(dated, wide, [key, "__bucket"], where=in_time).drop("__bucket")
    return sent.unionByName(unsent, allowMissingColumns=True).distinct()


def single_record(df: DataFrame, key: str = "person_id") -> DataFrame:
    """Rows of keys that have exactly one row."""
    row = F.struct(*[F.col(c) for c in df.columns])
    kept = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.max(row).alias("__row")).where(F.col("__n") == 1)
    return kept.select("__row.*")


def latest_before(
    df: DataFrame, key: str = "person_id", dt: str = "score_dt", ref_dt: str = "file_date", ties: list[str] | None = None
) -> DataFrame:
    """Per key the row with the latest date not after the row's reference date.

    Equal dates are decided by the tie columns, highest first; by default all others.
    """
    ties = ties if ties is not None else [c for c in df.columns if c not in (key, dt)]
    order = Window.partitionBy(key).orderBy(F.col(dt).desc(), *[F.col(c).desc_nulls_last() for c in ties])
    ranked = df.where(F.col(dt) <= F.col(ref_dt)).withColumn("__rn", F.row_number().over(order))
    return ranked.where(F.col("__rn") == 1).drop("__rn")


def _ordered_row(df: DataFrame, dt: str, ties: list[str] | None = None) -> Column:
    lead = [dt, *(ties or [])]
    return F.struct(*[F.col(c) for c in [*lead, *[c for c in df.columns if c not in lead]]])


def _pair_rows(dt: str, max_days: int) -> tuple[Column, Column]:
    """Whether a key's two rows (lowest, highest) are close enough, and the row(s) on the later date."""
    low, high = F.col(f"__low.{dt}"), F.col(f"__high.{dt}")
    close = (F.col("__n") == 2) & (F.datediff(high, low) <= max_days)
    later = F.when(low == high, F.array("__low", "__high")).otherwise(F.array("__high"))
    return close, later


def paired_score_rule(df: DataFrame, key: str = "person_id", dt: str = "score_dt", max_days: int = 30) -> DataFrame:
    """Keys with exactly two rows at most ``max_days`` apart: the row(s) on the later date.

    Lowest and highest row are aggregates, so two rows are all that is ever kept of a key.
    """
    row = _ordered_row(df, dt)
    grouped = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.min(row).alias("__low"), F.max(row).alias("__high"))
    close, later = _pair_rows(dt, max_days)
    return grouped.where(close).select(F.explode(later).alias("__row")).select("__row.*").select(*df.columns)


def dedupe_by_policy(
    df: DataFrame,
    key: str = "person_id",
    dt: str = "score_dt",
    ref_dt: str = "file_date",
    max_days: int = 30,
    ties: list[str] | None = None,
) -> DataFrame:
    """The first policy that applies to a person: only row, latest score before referral, close pair of scores.

    All three come from one aggregation per person; nothing is joined back.
    """
    row = _ordered_row(df, dt, ties)
    before = F.col(ref_dt).isNotNull() & (F.col(dt) <= F.col(ref_dt))
    grouped = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("__n"),
        F.min(row).alias("__low"),
        F.max(row).alias("__high"),
        F.max(F.when(before, row)).alias("__before"),
    )
    close, later = _pair_rows(dt, max_days)
    chosen = F.when(F.col("__n") == 1, F.array("__high")).when(F.col("__before").isNotNull(), F.array("__before"))
    chosen = chosen.when(close, later)
    return grouped.select(F.explode(chosen).alias("__row")).select("__row.*").select(*df.columns)


def attach_event_in_window(
    cohort: DataFrame,
    episodes: DataFrame,
    weeks: int = 40,
    *,
    key: str = "person_id",
    dt: str = "score_dt",
    event_dt: str = "deliv_start_dt",
) -> DataFrame:
    """Events strictly after the score date and within the weeks; people left with one row only."""
    days = F.datediff(F.col(event_dt), F.col(dt))
    joined = cohort.join(episodes, key).where((days > 0) & (days <= 7 * weeks))
    return single_record(joined, key)


def study_group_rules(program: str = "Maternity High Risk", min_days: int = 60) -> list[tuple[Column, str]]:
    engaged = F.col("engaged") == 1
    in_program = F.col("program_name") == program
    return [
        (F.col("file_date").isNull(), "Not Sent"),
        (engaged & in_program & (F.col("days_between_assess_deliv") > min_days), "Engaged MHR"),
        (engaged & in_program, "Engaged MHR, too late?"),
        (engaged, "Engaged Other Program"),
        (F.col("file_date").isNotNull(), "Sent, Not Engaged"),
    ]


def study_groups(
    df: DataFrame,
    program: str = "Maternity High Risk",
    min_days: int = 60,
    event_dt: str = "deliv_start_dt",
    assessment: str = "assessment_complete_date",
) -> DataFrame:
    """Days from assessment to event and the study group by ordered rules."""
    with_days = df.withColumn("days_between_assess_deliv", F.datediff(F.col(event_dt), F.col(assessment).cast("date")))
    return label_rules(with_days, "groups", study_group_rules(program, min_days))
