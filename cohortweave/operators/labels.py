"""Weight-status labels from diagnoses and from BMI records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.fixed_values import WEIGHT_FAMILIES
from cohortweave.functions.rules import first_match
from cohortweave.operators.episodes import latest_rows

WEIGHT_FLAGS = list(WEIGHT_FAMILIES)


def _on(*flags: str) -> Column:
    condition = F.lit(True)
    for f in flags:
        condition = condition & (F.col(f) == 1)
    return condition


def weight_rules() -> list[tuple[Column, int]]:
    """A diagnosis needs its BMI code, on the day or in the year before; a low BMI needs no sign of a high one."""
    high = ["obese_e66", "ovrwgt_e66", "obese_bmi", "ovrwgt_bmi"]
    no_high = F.lit(True)
    for f in [*high, *[f"prior_{h}" for h in high]]:
        no_high = no_high & (F.col(f) == 0)
    rules = []
    for family in ("obese", "ovrwgt"):
        rules += [
            (_on(f"{family}_e66", f"{family}_bmi"), 1),
            (_on(f"{family}_e66", f"prior_{family}_bmi"), 1),
            (_on(f"{family}_bmi", f"prior_{family}_e66"), 1),
        ]
    rules += [(_on(low) & no_high, 0) for low in ("normwgt_bmi", "undrwgt_bmi")]
    rules += [(_on("obese_e66", "ovrwgt_bmi"), 1), (_on("ovrwgt_e66", "obese_bmi"), 1)]
    return rules


def weight_label(
    current: DataFrame,
    prior: DataFrame | None,
    persons: DataFrame,
    *,
    key: str = "cust_id",
    index_dt: str = "index_dt",
    birth: str = "birth_dt",
    ages: tuple[int, int] = (2, 110),
) -> DataFrame:
    """(key, index_dt, obese) of people in the age range whose weight status the rules confirm.

    All inputs have one row per person; ``prior`` is None where ``current`` has the prior flags too.
    """
    priors = [f"prior_{f}" for f in WEIGHT_FLAGS]
    flags = current if prior is None else current.join(prior, key, "left")
    age = F.floor(F.datediff(F.col(index_dt), F.col(birth)) / F.lit(365.25))
    joined = (
        flags.join(persons.select(key, birth), key, "left")
        .withColumns({p: F.coalesce(F.col(p), F.lit(0)) for p in priors})
        .withColumn("age", age.cast("int"))
        .withColumn("obese", first_match(weight_rules()))
    )
    return joined.where(F.col("age").between(*ages) & F.col("obese").isNotNull()).select(key, index_dt, "obese")


def bmi_label(df: DataFrame, out: str = "obese", *, value_cut: float = 25, pct_cut: float = 85, pct_low: float = 5) -> DataFrame:
    """1/0/NULL from a BMI value and a percentile (or their ranges); the diagnosis flag decides the rest."""
    value, pct = F.col("bmi_val"), F.col("bmi_pct")
    by_value = first_match(
        [
            (value >= value_cut, 1),
            (value < value_cut, 0),
            (F.col("bmi_range_lower") >= value_cut, 1),
            (F.col("bmi_range_upper") < value_cut, 0),
        ]
    )
    by_pct = first_match(
        [
            (pct >= pct_cut, 1),
            (pct < pct_cut, 0),
            (F.col("bmi_pct_range_lower") >= pct_cut, 1),
            (F.col("bmi_pct_range_lower") == pct_low, 0),
        ]
    )
    has_value = F.coalesce("bmi_val", "bmi_range_lower", "bmi_range_upper").isNotNull()
    has_pct = F.coalesce("bmi_pct", "bmi_pct_range_lower", "bmi_pct_range_upper").isNotNull()
    label = first_match(
        [
            (has_value & has_pct & (by_value == by_pct), by_value),
            (has_value & ~has_pct, by_value),
            (~has_value & has_pct, by_pct),
            (F.col("e66"), 1),
        ]
    )
    return df.withColumn(out, label)


def unambiguous_latest(
    records: DataFrame,
    labelled: DataFrame,
    first: str,
    last: str,
    *,
    key: str = "cust_id",
    dt: str = "index_dt",
    label: str = "obese",
) -> DataFrame:
    """The main labels plus, for people not in them, the label of their latest record if all of that day agree.

    Records shrink to distinct (key, day, label) first, so the calendar bounds a key's rows.
    """
    dates = F.col(dt).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    distinct = records.where(dates & F.col(label).isNotNull()).select(key, dt, label).distinct()
    fresh = distinct.join(labelled.select(key).distinct(), key, "left_anti")
    agreed = (
        latest_rows(fresh, key, dt, per_day=True)
        .groupBy(key, dt)
        .agg(F.min(label).alias(label), F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") == 1)
        .drop("__n")
    )
    return labelled.select(key, dt, label).unionByName(agreed)
