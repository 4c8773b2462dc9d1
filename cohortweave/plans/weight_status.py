"""Weight-status labels from diagnoses and BMI records, without the time around pregnancies."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.fixed_values import WEIGHT_FAMILIES
from cohortweave.operators import windows as wi
from cohortweave.operators.codes import code_flags
from cohortweave.operators.enrolment import enrolled_k_of_n
from cohortweave.operators.labels import bmi_label, unambiguous_latest, weight_label
from cohortweave.session import written


@dataclass(frozen=True)
class WeightRules:
    first: str
    last: str
    families: dict[str, tuple[list[str], int | None]] = field(
        default_factory=lambda: {name: (codes, None) for name, codes in WEIGHT_FAMILIES.items()}
    )
    months: int = 6
    enrolled_months: int = 4
    lookback_days: int = 365
    inclusion: tuple[str, ...] = ()
    exclusion: tuple[str, ...] = ()
    delivery: tuple[str, ...] = ()


def eligible_people(membership: DataFrame, rules: WeightRules, *, key: str = "cust_id") -> DataFrame:
    last = dt.date.fromisoformat(rules.last)
    return enrolled_k_of_n(membership, last, rules.months, rules.enrolled_months, key=key).select(key)


def weight_status_labels(
    eligible: DataFrame,
    diagnoses: DataFrame,
    pregnancy_diagnoses: DataFrame,
    delivery_drg_days: DataFrame,
    persons: DataFrame,
    bmi_records: DataFrame,
    rules: WeightRules,
    *,
    key: str = "cust_id",
    dt_col: str = "event_dt",
    code_col: str = "diag_cd",
) -> DataFrame:
    """(key, index_dt, obese) of eligible people, none of them inside a pregnancy window.

    ``diagnoses`` and ``pregnancy_diagnoses`` are one row per (key, date, code), already
    limited by claim status or by sex and age. Rows shrink to one per person and day before
    they meet the eligible people, so the calendar bounds what a join or window sees of one
    person, and the window reuses the join's partitioning. Eligible people, diagnosis labels
    and exclusion windows are written: no task holds the sorts and groups of all steps at once,
    and what two steps read is computed once.
    """
    eligible = written(eligible.select(key), "eligible")
    wanted = sorted({c for codes, _ in rules.families.values() for c in codes})
    coded = diagnoses.where(F.col(code_col).isin(wanted))
    daily = code_flags(coded, code_col, rules.families, [key, dt_col]).join(eligible, key, "left_semi")
    flags = wi.current_and_prior_flags(daily, list(rules.families), rules.first, rules.last, rules.lookback_days, key=key, dt=dt_col)
    labels = written(weight_label(flags, None, persons, key=key), "weight-labels")
    labels = unambiguous_latest(bmi_label(bmi_records), labels, rules.first, rules.last, key=key)

    pregnancy_codes = [*rules.inclusion, *rules.exclusion, *rules.delivery]
    days = wi.pregnancy_days(
        pregnancy_diagnoses.where(F.col(code_col).isin(pregnancy_codes)),
        list(rules.inclusion),
        list(rules.exclusion),
        list(rules.delivery),
        key=key,
        dt=dt_col,
        code_col=code_col,
    ).join(eligible, key, "left_semi")
    drg_days = delivery_drg_days.select(key, dt_col).distinct().join(eligible, key, "left_semi")
    windows = written(wi.exclusion_windows(days, drg_days, key=key, dt=dt_col), "exclusion-windows")
    return wi.exclude_in_windows(labels, windows, key)
