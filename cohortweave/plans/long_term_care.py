"""Long-term-care groups from claims and membership."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.operators import care_groups as cg
from cohortweave.operators import enrolment as en
from cohortweave.operators import timeline as tl
from cohortweave.session import written


@dataclass(frozen=True)
class CareRules:
    conditions: dict[str, Column]
    snf: Column
    nh: Column
    now: tuple[str, str] = ("2019-01-01", "2019-12-31")
    before: tuple[str, str] = ("2017-01-01", "2018-12-31")
    suffix_now: str = "19"
    suffix_before: str = "1718"
    name_now: str = "2019"
    name_before: str = "17-18"
    last_month: str = "2020-03-01"
    born_by: str | None = "1964-01-01"
    min_stay_months: int = 4
    min_enrolled: int = 20
    enrolled_from: dt.date = dt.date(2017, 1, 1)
    per_stay: bool = False
    seed: int = 789
    death_patterns: list[str] = field(default_factory=lambda: list(cg.fixed.DEATH_PATTERNS))

    @property
    def year(self) -> int:
        return int(self.now[0][:4])

    @property
    def years(self) -> list[int]:
        return list(range(int(self.before[0][:4]), int(self.last_month[:4]) + 1))


def long_term_care_groups(
    membership: DataFrame,
    persons: DataFrame | None,
    claims: DataFrame,
    disenrolment: DataFrame,
    rules: CareRules,
    *,
    cust: str = "cust_id",
    person: str = "person_id",
    start: str = "claim_service_from_dt",
    end: str = "claim_service_to_dt",
) -> DataFrame:
    """One row per person enrolled in the year: flags, months, candidate dates, index date, category.

    The claims are read once, into one row of month bitmaps per person; flags, first months and
    long stays are functions of these. Membership is written once, as several steps read it.
    """
    now, before = rules.suffix_now, rules.suffix_before
    periods = {now: rules.now, before: rules.before}
    members = written(en.members_in_period(membership, persons, rules.before[0], rules.now[1], rules.born_by, key=person), "members")
    current = en.members_in_period(members, None, *rules.now)
    first, last = dt.date(rules.years[0], 1, 1), dt.date.fromisoformat(rules.last_month)
    months = (last.year - first.year) * 12 + last.month
    in_scope = claims.where(F.col(start).between(F.lit(rules.before[0]).cast("date"), F.lit(rules.now[1]).cast("date")))
    stays = {"__snf": rules.snf, "__nh": rules.nh}
    timelines = tl.care_timeline(in_scope, rules.conditions, stays, first, months, key=person, start=start, end=end)
    timelines = tl.merged(timelines, members, cust, person)
    starts = tl.long_stay_starts(F.col("__snf"), F.col("__nh"), rules.min_stay_months)
    timelines = timelines.withColumn("__long", starts if rules.per_stay else tl.earliest(starts))
    masks = {suffix: tl.mask(period, first, months) for suffix, period in periods.items()}
    kinds = {**{name: name for name in rules.conditions}, "iltc_4m": "__long"}
    people = current.select(cust).distinct().join(timelines, cust, "left")
    flags = people.select(
        cust,
        *[tl.any_in(F.col(bits), wanted).alias(f"{name}_{suffix}") for name, bits in kinds.items() for suffix, wanted in masks.items()],
        tl.first_month(F.col("hltc"), first).alias("min_hltc_month"),
        tl.first_month(F.col("__nh"), first).alias("min_iltc_month"),
        tl.first_month(F.col("__long"), first).alias("min_iltc4_month"),
    )
    spans = members.select(cust, "eff_dt", "end_dt").distinct()
    enrolled = en.months_enrolled(spans, rules.enrolled_from, 24, key=cust, start="eff_dt", end="end_dt")
    flags = flags.join(en.enrolment_thresholds(enrolled), cust, "left")
    flags = flags.join(cg.events_by_text(disenrolment, rules.year, rules.death_patterns, key=cust), cust, "left")
    indexed = cg.index_date(flags, rules.year, key=cust, seed=rules.seed, suffix=now)
    return cg.ltc_category(indexed, now, before, rules.min_enrolled, rules.name_now, rules.name_before)
