"""Shaping claims: header with lines and references, and the person crosswalk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.fixed_values import PROCEDURE_CODING_SYSTEM
from cohortweave.operators.spread import spread_join


def claim_lines(
    header: DataFrame,
    detail: DataFrame,
    procedure_ref: DataFrame,
    revenue_ref: DataFrame,
    *,
    first: str,
    last: str,
    date: str = "claim_service_from_dt",
    coding_system: str = PROCEDURE_CODING_SYSTEM,
) -> DataFrame:
    """Headers in a service period with their lines and the two code references; nothing matched gives NULL.

    Lines are the many-row side, so they are joined slice by slice to their header and
    headers without lines are added: an outer join from the header could not split the
    lines of one crowded claim. The references carry no hint: Spark broadcasts them when
    their measured size allows.
    """
    heads = header.where(F.col(date).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    lines = detail
    if "place_of_service_cd" in detail.columns:
        lines = detail.withColumnRenamed("place_of_service_cd", "claim_ln_place_of_service_cd")
    procedures = procedure_ref.where(F.col("procedural_coding_system_cd") == coding_system).select(
        "medical_procedure_cd_pk", "procedure_cd"
    )
    revenues = revenue_ref.select("medical_revenue_cd_pk", F.col("revenue_cd").alias("revenue_cd2"))
    lines = lines.withColumnRenamed("claim_header_fk", "claim_header_pk").where(F.col("claim_header_pk").isNotNull())
    with_lines = spread_join(lines, heads, "claim_header_pk")
    without = heads.join(lines.select("claim_header_pk").distinct(), "claim_header_pk", "left_anti")
    return (
        with_lines.unionByName(without, allowMissingColumns=True)
        .join(procedures, F.col("medical_procedure_cd_fk") == F.col("medical_procedure_cd_pk"), "left")
        .join(revenues, F.col("medical_revenue_cd_fk") == F.col("medical_revenue_cd_pk"), "left")
        .drop("medical_procedure_cd_pk", "medical_revenue_cd_pk")
    )


def person_crosswalk_claims(
    membership: DataFrame,
    claims: DataFrame,
    eligible: DataFrame | None = None,
    *,
    member: str = "member_id",
    person: str = "cust_id",
    status: list[str] | None = None,
    status_col: str = "clmstat",
    sex: str | None = None,
    sex_col: str = "sexcod",
    ages: tuple[int, int] | None = None,
    age_col: str = "ageyears",
) -> DataFrame:
    """Claims of eligible people, the person id attached through membership's id pairs."""
    pairs = membership.select(member, person).distinct()
    if eligible is not None:
        pairs = pairs.join(eligible.select(person).distinct(), person, "left_semi")
    kept = claims
    if status is not None:
        kept = kept.where(F.col(status_col).isin(status))
    if sex is not None:
        kept = kept.where(F.col(sex_col) == sex)
    if ages is not None:
        kept = kept.where(F.col(age_col).between(*ages))
    return spread_join(kept.where(F.col(member).isNotNull()), pairs, member)
