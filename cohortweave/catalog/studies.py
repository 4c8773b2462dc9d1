"""The three studies from end to end on the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cohortweave.catalog import care, cohort, features, sources, weight
from cohortweave.catalog.registry import ORACLES, query
from cohortweave.catalog.views import base_day, bmi_v, care_lines_v, claims_v, deliveries_v, diagnoses_v, enroll_v, members_v
from cohortweave.catalog.views import plus, referrals_v, scores_v, table
from cohortweave.operators import features as fe
from cohortweave.plans import long_term_care, maternity, weight_models, weight_status
from cohortweave.session import written

def _swapped(text: str, old: str, new: str) -> str:
    """The text with `old` replaced; an error if it is not there."""
    if old not in text:
        raise ValueError(f"not in the SQL: {old}")
    return text.replace(old, new)


# ---- maternity: claims are moved forward by whole years so that they meet the deliveries

SHIFT = 8400
_MATERNITY = (
    "WITH "
    + cohort._STUDY
    + f""",
    mem AS (SELECT hh_id AS household_id, person_id, DATE '2023-01-01' + CAST(person_id % 300 AS INT) AS eff_dt, DATE '2024-12-31' AS end_dt,
                   DATE '2023-02-01' AS benefit_eff_dt, DATE '2024-01-10' + CAST(person_id % 30 AS INT) AS benefit_end_dt,
                   DATE '2024-01-01' + CAST((person_id * 7) % 40 AS INT) AS birth_dt FROM members_v),
    hhs AS (SELECT DISTINCT household_id, person_id FROM study JOIN mem USING (person_id)
            WHERE deliv_start_dt BETWEEN eff_dt AND end_dt AND deliv_start_dt BETWEEN benefit_eff_dt AND benefit_end_dt
            QUALIFY eff_dt = max(eff_dt) OVER (PARTITION BY person_id)),
    links AS (SELECT DISTINCT household_id, s.person_id AS mother_id, m.person_id AS infant_id, m.birth_dt AS infant_birth_dt
              FROM study s JOIN hhs h ON h.person_id = s.person_id JOIN mem m USING (household_id)
              WHERE m.birth_dt BETWEEN deliv_start_dt - 7 AND deliv_end_dt + 7),
    anchors AS (SELECT mother_id, min(delivery_dt) AS delivery_dt
        FROM (SELECT s.person_id AS mother_id, CASE WHEN infant_birth_dt IS NOT NULL THEN infant_birth_dt
                     WHEN deliv_claims_days <= 60 THEN deliv_start_dt END AS delivery_dt
              FROM study s LEFT JOIN (SELECT DISTINCT mother_id, infant_birth_dt FROM links) l ON l.mother_id = s.person_id)
        GROUP BY mother_id),
    cv AS (SELECT person_id, from_dt + {SHIFT} AS from_dt, to_dt + {SHIFT} AS to_dt, admission_dt + {SHIFT} AS admission_dt,
                  discharge_dt + {SHIFT} AS discharge_dt, paid, patient_paid FROM claims_v),
    mc AS (SELECT a.mother_id, a.delivery_dt, c.* FROM anchors a JOIN cv c ON a.mother_id = c.person_id),
    bc AS (SELECT a.mother_id, a.delivery_dt, c.* FROM anchors a JOIN links l USING (mother_id) JOIN cv c ON l.infant_id = c.person_id)
    """
)


def _maternity_sql() -> str:
    joins = " ".join(f"LEFT JOIN ({cohort._cost_sql(n)}) {n} USING (mother_id)" for n in cohort._COST_CONDITIONS)
    columns = ", ".join(f"{n}_cost, {n}_patient_cost" for n in cohort._COST_CONDITIONS)
    return f"{_MATERNITY} SELECT mother_id, {columns} FROM anchors {joins}"


def _from_claims_sql() -> str:
    """The same with deliveries from the five code systems, and 40 weeks to find one in."""
    finds = f"""
    delivs AS (SELECT person_id, from_dt + {SHIFT} AS from_dt, to_dt + {SHIFT} AS to_dt, id_code FROM finds),"""
    sql = _swapped(_maternity_sql(), "FROM deliveries_v", "FROM delivs")
    sql = _swapped(sql, "BETWEEN score_dt AND score_dt + 14", "BETWEEN score_dt AND score_dt + 280")
    return sources._TIERS + "," + finds + sql.strip().removeprefix("WITH ")


@query("maternity_outcome_costs", _maternity_sql())
def maternity_outcome_costs(spark, sf_dir):
    return _maternity_costs(spark, sf_dir, deliveries_v(spark, sf_dir), 2)


@query("maternity_costs_from_claims", _from_claims_sql())
def maternity_costs_from_claims(spark, sf_dir):
    """The study from its first step: deliveries identified in the claims by five code systems."""
    finds = sources.identified(spark, sf_dir).withColumns({c: F.date_add(c, SHIFT) for c in ("from_dt", "to_dt")})
    return _maternity_costs(spark, sf_dir, finds, 40)


def _maternity_costs(spark, sf_dir, deliveries, weeks):
    rules = maternity.MaternityRules(
        "2024-01-01", "2024-01-28", cut=0.2, pair_days=10, episode_gap=3, delivery_weeks=weeks, engaged_days=3
    )
    study = maternity.study_cohort(scores_v(spark, sf_dir), referrals_v(spark, sf_dir), deliveries, rules, ties=cohort.TIES)
    k = F.col("person_id")
    people = members_v(spark, sf_dir)
    membership = people.select(
        F.col("hh_id").alias("household_id"),
        "person_id",
        base_day("2023-01-01", k % 300).alias("eff_dt"),
        F.lit("2024-12-31").cast("date").alias("end_dt"),
        F.lit("2023-02-01").cast("date").alias("benefit_eff_dt"),
        base_day("2024-01-10", k % 30).alias("benefit_end_dt"),
    )
    persons = people.select("person_id", base_day("2024-01-01", (k * 7) % 40).alias("birth_dt"))
    claims = claims_v(spark, sf_dir)
    claims = claims.withColumns({c: F.date_add(c, SHIFT) for c in claims.columns if c.endswith("_dt")})
    return cohort._doubles(maternity.outcome_costs(study, membership, persons, claims, rules))


# ---- weight status

_ELIGIBLE = """
    marks AS (SELECT CAST(DATE '2000-11-01' - to_months(i) AS DATE) AS mark FROM range(0, 6) t(i)),
    elig AS (SELECT person_id AS cust_id FROM enroll_v JOIN marks ON eff_dt <= mark AND end_dt > mark
             GROUP BY person_id HAVING count(DISTINCT mark) >= 2),
    dx AS (SELECT * FROM diagnoses_v WHERE cust_id IN (SELECT cust_id FROM elig))
"""


def _limited(text: str) -> str:
    return _swapped(text, "FROM diagnoses_v", "FROM dx")


@query(
    "weight_status_labels",
    "WITH "
    + ",".join(
        [
            _ELIGIBLE,
            _limited(weight._CURRENT),
            weight._PRIOR,
            weight._LABELS,
            _swapped(weight._BMI, "FROM bmi_v", "FROM (SELECT * REPLACE (index_dt - 8600 AS index_dt) FROM bmi_v)"),
            _swapped(weight._COMBINED, "DATE '2024-01-01' AND DATE '2024-01-30'", "DATE '1996-11-01' AND DATE '2000-11-01'"),
            _limited(weight._WINDOWS),
        ]
    )
    + """
    SELECT * FROM combined WHERE NOT EXISTS (
        SELECT 1 FROM wins WHERE wins.cust_id = combined.cust_id AND index_dt BETWEEN exclude_start AND exclude_end)
    """,
)
def weight_status_labels(spark, sf_dir):
    rules = weight_status.WeightRules(
        "1996-11-01",
        "2000-11-01",
        weight.FAMILIES,
        enrolled_months=2,
        inclusion=tuple(weight.INCLUSION),
        exclusion=tuple(weight.EXCLUSION),
        delivery=tuple(weight.DELIVERY),
    )
    spans = enroll_v(spark, sf_dir).select(
        F.col("person_id").alias("cust_id"), F.col("eff_dt").alias("start_dt"), "end_dt"
    )
    diagnoses = diagnoses_v(spark, sf_dir)
    drg_days = diagnoses.where((F.col("drg") == "1-URGENT") & (F.col("diag_cd") == "Brand#23"))
    persons = members_v(spark, sf_dir).select(F.col("person_id").alias("cust_id"), "birth_dt")
    records = bmi_v(spark, sf_dir).withColumn("index_dt", F.date_sub("index_dt", 8600))
    return weight_status.weight_status_labels(
        weight_status.eligible_people(spans, rules), diagnoses, diagnoses, drg_days, persons, records, rules
    )


# ---- long-term care

_CARE_SELECT = """
    SELECT * EXCLUDE (person_id), CAST(months_enrolled = 24 AS INT) AS enroll_24mo, CAST(months_enrolled >= 12 AS INT) AS enroll_12mo,
           CAST(months_enrolled >= 6 AS INT) AS enroll_6mo
    FROM labelled
"""


def _care_sql() -> str:
    in_scope = "EXISTS (SELECT 1 FROM xwalk WHERE xwalk.person_id = {0}.person_id)"
    sql = care._GROUPED
    sql = _swapped(
        sql,
        "FROM claims_v WHERE year(from_dt) IN (1997, 1998, 1999, 2000)",
        "FROM claims_v WHERE from_dt BETWEEN DATE '1997-01-01' AND DATE '1999-12-31' AND " + in_scope.format("claims_v"),
    )
    sql = _swapped(sql, "FROM enroll_v LEFT JOIN (SELECT", f"FROM (SELECT * FROM enroll_v WHERE {care._OVERLAP.format('1997-01-01', '1999-12-31')}) LEFT JOIN (SELECT")
    return sql + _CARE_SELECT


@query("long_term_care_groups", _care_sql())
def long_term_care_groups(spark, sf_dir):
    claims = care_lines_v(spark, sf_dir)
    # skilled nursing and nursing home go by the claim's status, as in the member-month queries
    status = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("person_id"),
        F.to_date("o_orderdate").alias("claim_service_from_dt"),
        plus(F.to_date("o_orderdate"), F.col("o_orderkey") % 40).alias("claim_service_to_dt"),
        F.col("o_orderstatus").alias("claim_status"),
    )
    lines = claims.withColumn("has_line", F.lit(True)).unionByName(status, allowMissingColumns=True)
    conditions = {n: F.col("has_line") & c for n, c in care._rules().items()}
    rules = long_term_care.CareRules(
        conditions,
        F.col("claim_status") == "P",
        F.col("claim_status").isin("F", "O"),
        now=("1999-01-01", "1999-12-31"),
        before=("1997-01-01", "1998-12-31"),
        suffix_now="99",
        suffix_before="9798",
        name_now="1999",
        name_before="97-98",
        last_month="2000-03-01",
        born_by=None,
        min_stay_months=care.MIN_MONTHS,
        min_enrolled=6,
        enrolled_from=dt.date(1997, 1, 1),
        death_patterns=["%low%"],
    )
    deaths = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("cust_id"),
        F.col("o_orderpriority").alias("reason"),
        F.to_date("o_orderdate").alias("event_dt"),
    )
    membership = care._with_cust(enroll_v(spark, sf_dir))
    return long_term_care.long_term_care_groups(membership, None, lines, deaths, rules)


# ---- weight-status models: labels of the weight study where there are any, else a rule on the balance

_MODEL_ROWS = (
    "WITH "
    + features._ASSEMBLED
    + f""",
    known AS (SELECT cust_id, obese FROM ({ORACLES["weight_status_labels"]})),
    study AS (
        SELECT m.person_id AS cust_id, m.person_id % greatest(1, (SELECT count(*) FROM members_v) // 4) AS study_hh, age,
               coalesce(known.obese, CASE WHEN balance > 4500 THEN 1 ELSE 0 END) AS obese
        FROM members_v m LEFT JOIN known ON known.cust_id = m.person_id LEFT JOIN allfeats f ON f.cust_id = m.person_id),
    weighted AS (
        SELECT *, CASE WHEN age BETWEEN 20 AND 110 THEN 'adults' ELSE 'children' END AS stratum,
               {features._part_sql("789", "'household ' || study_hh", 10)} AS fold
        FROM study WHERE age BETWEEN 2 AND 110),
    ratios AS (SELECT stratum, sum(1 - obese) / sum(obese) AS ratio FROM weighted GROUP BY stratum)
    """
)


def model_rows(spark, sf_dir):
    """Everybody's label, household and features, as the stacked models read them."""
    people = members_v(spark, sf_dir)
    n = people.agg(F.count(F.lit(1))).scalar()
    households = F.greatest(F.lit(1), F.floor(n / 4))
    known = weight_status_labels(spark, sf_dir).select(F.col("cust_id").alias("person_id"), "obese")
    labels = people.join(known, "person_id", "left").select(
        F.col("person_id").alias("cust_id"),
        (F.col("person_id") % households).alias("hh_id"),
        F.coalesce("obese", F.when(F.col("balance") > 4500, 1).otherwise(0)).alias("obese"),
    )
    return fe.labelled_set(labels, features.assembled(spark, sf_dir))


@query(
    "model_strata",
    _MODEL_ROWS
    + """
    SELECT cust_id, stratum, study_hh AS hh_id, obese, round(CASE WHEN obese = 1 THEN ratio ELSE 1e0 END, 9) AS weight, fold
    FROM weighted JOIN ratios USING (stratum)
    """,
)
def model_strata(spark, sf_dir):
    rows = weight_models.strata(written(model_rows(spark, sf_dir), "model-rows"))
    return rows.select("cust_id", "stratum", "hh_id", "obese", F.round("weight", 9).alias("weight"), "fold")


@query(
    "child_training_rows",
    _MODEL_ROWS
    + """,
    means AS (SELECT study_hh, avg(1e0 / (1e0 + exp(1e0 - age / 40e0))) AS m FROM study WHERE age BETWEEN 20 AND 110 GROUP BY study_hh)
    SELECT cust_id, study_hh AS hh_id, obese, round(CASE WHEN obese = 1 THEN ratio ELSE 1e0 END, 9) AS weight, round(m, 9) AS hh_adult_mean_score
    FROM weighted JOIN ratios USING (stratum) LEFT JOIN means USING (study_hh) WHERE stratum = 'children'
    """,
)
def child_training_rows(spark, sf_dir):
    """The child model's rows with household means of a fixed logistic score of the adults' age."""
    rows = written(model_rows(spark, sf_dir), "model-rows")
    adults = rows.where(F.col("age").between(20, 110))
    scores = adults.select("cust_id", (F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(1.0) - F.col("age") / 40))).alias("p1"))
    found = weight_models.child_rows(rows, scores)
    rounded = [F.round(c, 9).alias(c) for c in ("weight", "hh_adult_mean_score")]
    return found.select("cust_id", "hh_id", "obese", *rounded)


@query("stacked_leaderboards")
def stacked_leaderboards(spark, sf_dir):
    rows = written(model_rows(spark, sf_dir), "model-rows")
    chosen = features.feature_list(rows.columns)
    adults, children = weight_models.stacked_models(rows, chosen, chosen)
    return weight_models.leaderboards(adults, children)
