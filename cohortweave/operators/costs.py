"""Interval costs around a delivery, all from one pass over the claims."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.rules import PROPAGATE, sum_where
from cohortweave.operators.spread import spread_join

MOTHER, INFANT = "mother", "infant"


@dataclass(frozen=True)
class ClaimColumns:
    person: str = "person_id"
    admission: str = "admission_dt"
    discharge: str = "discharge_dt"
    service_from: str = "from_dt"
    service_to: str = "to_dt"
    paid: str = "paid"
    patient_paid: str = "patient_paid"


@dataclass(frozen=True)
class CostOutcome:
    """One outcome: whose claims, which claims, and the names of its two sums."""

    who: str
    condition: Callable[[ClaimColumns], Column]
    paid_name: str
    patient_name: str


def _spans(start: Callable[[ClaimColumns], str], end: Callable[[ClaimColumns], str], early_days: int = 0):
    def condition(c: ClaimColumns) -> Column:
        return F.col("delivery_dt").between(F.date_sub(F.col(start(c)), early_days), F.col(end(c)))

    return condition


def _starts_by(start: Callable[[ClaimColumns], str], late_days: int, lower_days: int | None = None):
    def condition(c: ClaimColumns) -> Column:
        until = F.col(start(c)) <= F.date_add("delivery_dt", late_days)
        if lower_days is None:
            return until
        return until & (F.col(start(c)) >= F.date_sub("delivery_dt", lower_days))

    return condition


def delivery_outcomes(lower_days: int | None = None) -> list[CostOutcome]:
    """The eight outcomes; the two plus-7 ones have no lower date bound unless ``lower_days`` is given."""

    def outcome(who, condition, name):
        return CostOutcome(who, condition, f"{name}_cost", f"{name}_patient_cost")

    stay = (lambda c: c.admission, lambda c: c.discharge)
    service = (lambda c: c.service_from, lambda c: c.service_to)
    return [
        outcome(MOTHER, _spans(*stay), "m_admit_disch"),
        outcome(MOTHER, _spans(*stay, early_days=1), "m_admit_minus1"),
        outcome(MOTHER, _spans(*service), "m_span_deliv"),
        outcome(MOTHER, _spans(*service, early_days=1), "m_deliv_minus1"),
        outcome(INFANT, _spans(*stay), "b_admit_disch"),
        outcome(INFANT, _starts_by(stay[0], 7, lower_days), "b_admit_plus7"),
        outcome(INFANT, _spans(*service), "b_span_birth"),
        outcome(INFANT, _starts_by(service[0], 7, lower_days), "b_birth_plus7"),
    ]


def _outcome_sums(
    anchors: DataFrame,
    links: DataFrame | None,
    claims: DataFrame,
    outcomes: list[CostOutcome],
    columns: ClaimColumns,
    null_policy: str,
) -> DataFrame:
    dated = anchors.select("mother_id", "delivery_dt").where(F.col("delivery_dt").isNotNull())
    subjects = []
    if any(o.who == MOTHER for o in outcomes):
        subjects.append(dated.select(F.col("mother_id").alias("__person"), "mother_id", "delivery_dt", F.lit(MOTHER).alias("__who")))
    if any(o.who == INFANT for o in outcomes):
        if links is None:
            raise ValueError("infant outcomes need the mother-infant links")
        infants = links.where(F.col("infant_id").isNotNull()).select("mother_id", "infant_id")
        subjects.append(
            infants.join(dated, "mother_id").select(
                F.col("infant_id").alias("__person"), "mother_id", "delivery_dt", F.lit(INFANT).alias("__who")
            )
        )
    people = reduce(DataFrame.union, subjects)

    conditions = [(F.col("__who") == o.who) & o.condition(columns) for o in outcomes]
    c = columns
    needed = [c.admission, c.discharge, c.service_from, c.service_to, c.paid, c.patient_paid]
    facts = claims.where(F.col(c.person).isNotNull()).select(F.col(c.person).alias("__person"), *dict.fromkeys(needed))
    matched = spread_join(facts, people, "__person", where=reduce(lambda a, b: a | b, conditions))
    sums = []
    for o, condition in zip(outcomes, conditions):
        sums.append(sum_where(c.paid, condition, null_policy).alias(o.paid_name))
        sums.append(sum_where(c.patient_paid, condition, null_policy).alias(o.patient_name))
    return matched.groupBy("mother_id").agg(*sums)


def interval_cost(
    anchors: DataFrame,
    claims: DataFrame,
    outcome: CostOutcome,
    links: DataFrame | None = None,
    *,
    columns: ClaimColumns = ClaimColumns(),
    null_policy: str = PROPAGATE,
) -> DataFrame:
    """(mother_id, paid sum, patient-paid sum) of one outcome; mothers without a matching claim are absent."""
    return _outcome_sums(anchors, links, claims, [outcome], columns, null_policy)


def assemble_outcomes(
    anchors: DataFrame,
    claims: DataFrame,
    links: DataFrame,
    outcomes: list[CostOutcome] | None = None,
    *,
    columns: ClaimColumns = ClaimColumns(),
    null_policy: str = PROPAGATE,
) -> DataFrame:
    """Every mother with all outcomes, NULL where nothing matched.

    Mothers and infants form one list of people with an anchor date, so the claims are
    scanned and shuffled once for all outcomes together.
    """
    outcomes = outcomes or delivery_outcomes()
    sums = _outcome_sums(anchors, links, claims, outcomes, columns, null_policy)
    return anchors.select("mother_id").join(sums, "mother_id", "left")
