"""Risk scores to delivery costs: cohort, mother-infant links, delivery dates, outcomes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.functions import fixed_values as fixed
from cohortweave.operators import codes as co
from cohortweave.operators import cohort as ch
from cohortweave.operators import costs
from cohortweave.operators.episodes import episode_summary
from cohortweave.operators.linking import active_span_lookup, link_by_household
from cohortweave.operators.windows import anchor_and_window
from cohortweave.session import written
from cohortweave.sources import codelists


@dataclass(frozen=True)
class MaternityRules:
    first_score: str
    last_score: str
    cut: float = 0.10
    population: str = "maternity"
    program: str = "Maternity High Risk"
    referral_days: int = 60
    pair_days: int = 30
    episode_gap: int = 140
    delivery_weeks: int = 40
    engaged_days: int = 60
    birth_pad_days: int = 7
    max_claim_span: int = 60
    null_policy: str = "propagate"


#: The code systems that tell a delivery, the surest first.
DELIVERY_TIERS = ["icd10_1st", "drg", "icd10_2nd", "revenue", "cpt"]


def delivery_lists(spark: SparkSession, pregnancy_codes: DataFrame, delivery_room_codes: DataFrame) -> dict[str, DataFrame]:
    """The code list of each system, from the fixed lists and two reference tables (type, code, definition).

    Diagnoses and DRGs count by the head that a list names, revenue and procedure codes as wholes.
    """
    whole = F.lit(None).cast("int")
    prefix, low, high = fixed.DELIVERY_ICD_COMPLICATION_RANGE
    texts = codelists.code_list(
        pregnancy_codes, "icd10_2nd", code_type="ICD-10-CM", definition_contains=fixed.CHILDBIRTH_TEXTS, dotted=True
    )
    procedures = codelists.code_list(pregnancy_codes, "cpt", code_type="CPT", definition_contains=fixed.DELIVERY_TEXTS, lower=True)
    return {
        "icd10_1st": codelists.code_literals(spark, {"icd10_1st": fixed.DELIVERY_ICD_FIRST}),
        "drg": codelists.code_literals(spark, {"drg": fixed.DELIVERY_DRG}),
        "icd10_2nd": codelists.code_ranges(spark, [("icd10_2nd", prefix, low, high)]).unionByName(texts),
        "revenue": codelists.code_list(delivery_room_codes, "revenue", code_type="UBREV").withColumn("match_len", whole),
        "cpt": procedures.withColumn("match_len", whole),
    }


def delivery_finds(
    headers: DataFrame,
    lines: DataFrame,
    services: DataFrame,
    lists: dict[str, DataFrame],
    *,
    diagnoses: list[str],
    drgs: tuple[str, str] = ("diagnosis_related_group_cd", "claim_header_sub_drg_cd"),
    revenue: str = "revenue_cd",
    procedure: str = "service_cd",
) -> DataFrame:
    """Deliveries of every person by the surest system that finds one; each of the three claims tables is read once."""
    by_diagnosis = [co.TierRule(m, tuple(diagnoses), lists[m]) for m in ("icd10_1st", "icd10_2nd")]
    drg = co.TierRule("drg", drgs, lists["drg"], "first")
    tables = [
        co.TierTable(headers, (*by_diagnosis, drg), "claim_service_from_dt", "claim_service_to_dt"),
        co.TierTable(lines, (co.TierRule("revenue", (revenue,), lists["revenue"]),), "claim_line_service_start_dt", "claim_line_service_end_dt"),
        co.TierTable(services, (co.TierRule("cpt", (procedure,), lists["cpt"]),), "claim_ln_service_from_dt", "claim_ln_service_to_dt"),
    ]
    return co.identify_by_tiers(tables, DELIVERY_TIERS)


SPANS = [("eff_dt", "end_dt"), ("benefit_eff_dt", "benefit_end_dt")]


def study_cohort(
    scores: DataFrame, tracking: DataFrame, deliveries: DataFrame, rules: MaternityRules, ties: list[str] | None = None
) -> DataFrame:
    """One row per person with a high score followed by exactly one delivery, with its study group.

    ``deliveries`` are finds as ``operators.codes.identify_by_tiers`` gives them.
    """
    high = ch.high_scores(scores, rules.first_score, rules.last_score, rules.cut)
    sent = tracking.where(F.col("population") == rules.population).drop("population")
    pool = ch.dedupe_by_policy(ch.score_referral(high, sent, rules.referral_days), max_days=rules.pair_days, ties=ties)
    episodes = episode_summary(deliveries, max_gap=rules.episode_gap)
    matched = ch.attach_event_in_window(pool, episodes, rules.delivery_weeks)
    return ch.study_groups(matched, rules.program, rules.engaged_days)


def infant_links(cohort: DataFrame, membership: DataFrame, persons: DataFrame, rules: MaternityRules) -> DataFrame:
    """Infants born into the household the mother belonged to at delivery."""
    households = active_span_lookup(cohort, membership, "deliv_start_dt", SPANS)
    births = membership.select("household_id", "person_id").distinct().join(persons.select("person_id", "birth_dt"), "person_id")
    return link_by_household(cohort, households, births, rules.birth_pad_days)


def outcome_costs(
    cohort: DataFrame,
    membership: DataFrame,
    persons: DataFrame,
    claims: DataFrame,
    rules: MaternityRules,
    columns: costs.ClaimColumns = costs.ClaimColumns(),
) -> DataFrame:
    """All eight delivery costs of every mother of the cohort.

    Cohort, links and anchors are stage tables: several later steps read them, so each is
    written once instead of being worked out again by every reader.
    """
    cohort = written(cohort, "cohort")
    links = written(infant_links(cohort, membership, persons, rules), "links")
    anchors = written(anchor_and_window(cohort, links, max_span=rules.max_claim_span), "anchors")
    return costs.assemble_outcomes(anchors, claims, links, columns=columns, null_policy=rules.null_policy)
