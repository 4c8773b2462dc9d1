"""Weight-status labels and exclusion windows on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortweave.catalog.registry import query
from cohortweave.catalog.views import bmi_v, diagnoses_v, members_v
from cohortweave.operators import episodes as ep
from cohortweave.operators import labels as la
from cohortweave.operators import windows as wi
from cohortweave.operators.codes import code_flags

FAMILIES = {
    "obese_e66": (["Brand#1", "Brand#2", "Brand#3"], None),
    "ovrwgt_e66": (["Brand#4", "Brand#5"], None),
    "obese_bmi": (["Brand#6", "Brand#7", "Brand#8"], None),
    "ovrwgt_bmi": (["Brand#9", "Brand#10"], None),
    "normwgt_bmi": (["Brand#11", "Brand#12", "Brand#13", "Brand#14", "Brand#15"], None),
    "undrwgt_bmi": (["Brand#16", "Brand#17"], None),
}
WEIGHT_CODES = [code for codes, _ in FAMILIES.values() for code in codes]


def _in(codes: list[str]) -> str:
    return "diag_cd IN (" + ", ".join(f"'{c}'" for c in codes) + ")"


def _family_flags(prefix: str = "") -> str:
    return ", ".join(
        f"max(CASE WHEN {_in(codes)} THEN 1 ELSE 0 END) AS {prefix}{name}" for name, (codes, _) in FAMILIES.items()
    )


_CURRENT = f"""
    wc AS (SELECT * FROM diagnoses_v WHERE {_in(WEIGHT_CODES)}),
    latest AS (SELECT * FROM wc WHERE event_dt BETWEEN DATE '1996-11-01' AND DATE '2000-11-01'
               QUALIFY rank() OVER (PARTITION BY cust_id ORDER BY event_dt DESC) = 1),
    cur AS (SELECT cust_id, event_dt AS index_dt, {_family_flags()} FROM latest GROUP BY cust_id, event_dt)
"""
_PRIOR = f"""
    prior AS (SELECT cur.cust_id, {_family_flags('prior_')} FROM cur JOIN wc ON cur.cust_id = wc.cust_id
              WHERE event_dt BETWEEN index_dt - 365 AND index_dt - 1 GROUP BY cur.cust_id)
"""
_NO_HIGH = " AND ".join(
    f"{p}{f} = 0" for p in ("", "prior_") for f in ("obese_e66", "ovrwgt_e66", "obese_bmi", "ovrwgt_bmi")
)
_LABELS = f"""
    filled AS (
        SELECT cur.*, {", ".join(f"coalesce(prior_{f}, 0) AS prior_{f}" for f in FAMILIES)},
               floor(CAST(index_dt - birth_dt AS INT) / 365.25) AS age
        FROM cur LEFT JOIN prior USING (cust_id) LEFT JOIN members_v ON members_v.person_id = cur.cust_id),
    weight AS (
        SELECT cust_id, index_dt, obese FROM (SELECT *, CASE
            WHEN obese_e66 = 1 AND obese_bmi = 1 THEN 1 WHEN obese_e66 = 1 AND prior_obese_bmi = 1 THEN 1
            WHEN obese_bmi = 1 AND prior_obese_e66 = 1 THEN 1 WHEN ovrwgt_e66 = 1 AND ovrwgt_bmi = 1 THEN 1
            WHEN ovrwgt_e66 = 1 AND prior_ovrwgt_bmi = 1 THEN 1 WHEN ovrwgt_bmi = 1 AND prior_ovrwgt_e66 = 1 THEN 1
            WHEN normwgt_bmi = 1 AND {_NO_HIGH} THEN 0 WHEN undrwgt_bmi = 1 AND {_NO_HIGH} THEN 0
            WHEN obese_e66 = 1 AND ovrwgt_bmi = 1 THEN 1 WHEN ovrwgt_e66 = 1 AND obese_bmi = 1 THEN 1 END AS obese FROM filled)
        WHERE age BETWEEN 2 AND 110 AND obese IS NOT NULL)
"""


def weight_claims(spark, sf_dir):
    return diagnoses_v(spark, sf_dir).where(F.col("diag_cd").isin(WEIGHT_CODES))


def current_flags(spark, sf_dir):
    """One row per person and day first; the latest day is then picked among days."""
    daily = code_flags(weight_claims(spark, sf_dir), "diag_cd", FAMILIES, ["cust_id", "event_dt"])
    latest = ep.latest_rows(daily, "cust_id", "event_dt", "1996-11-01", "2000-11-01", per_day=True)
    return latest.withColumnRenamed("event_dt", "index_dt")


def prior_flags(spark, sf_dir):
    return wi.lookback_flags(current_flags(spark, sf_dir), weight_claims(spark, sf_dir), FAMILIES)


def weight_labels(spark, sf_dir):
    persons = members_v(spark, sf_dir).select(F.col("person_id").alias("cust_id"), "birth_dt")
    daily = code_flags(weight_claims(spark, sf_dir), "diag_cd", FAMILIES, ["cust_id", "event_dt"])
    flags = wi.current_and_prior_flags(daily, list(FAMILIES), "1996-11-01", "2000-11-01")
    return la.weight_label(flags, None, persons)


@query("current_weight_flags", "WITH " + _CURRENT + "SELECT * FROM cur")
def current_weight_flags(spark, sf_dir):
    return current_flags(spark, sf_dir)


@query("lookback_flags", "WITH " + _CURRENT + "," + _PRIOR + "SELECT * FROM prior")
def lookback_flags(spark, sf_dir):
    return prior_flags(spark, sf_dir)


@query("weight_label", "WITH " + _CURRENT + "," + _PRIOR + "," + _LABELS + "SELECT * FROM weight")
def weight_label(spark, sf_dir):
    return weight_labels(spark, sf_dir)


_BMI = """
    bmi AS (
        SELECT *, CASE WHEN has_val AND has_pct AND obese_val = obese_pct THEN obese_val WHEN has_val AND NOT has_pct THEN obese_val
                       WHEN NOT has_val AND has_pct THEN obese_pct WHEN e66 THEN 1 END AS obese
        FROM (SELECT *, bmi_val IS NOT NULL OR bmi_range_lower IS NOT NULL OR bmi_range_upper IS NOT NULL AS has_val,
                     bmi_pct IS NOT NULL OR bmi_pct_range_lower IS NOT NULL OR bmi_pct_range_upper IS NOT NULL AS has_pct,
                     CASE WHEN bmi_val >= 25 THEN 1 WHEN bmi_val < 25 THEN 0 WHEN bmi_range_lower >= 25 THEN 1
                          WHEN bmi_range_upper < 25 THEN 0 END AS obese_val,
                     CASE WHEN bmi_pct >= 85 THEN 1 WHEN bmi_pct < 85 THEN 0 WHEN bmi_pct_range_lower >= 85 THEN 1
                          WHEN bmi_pct_range_lower = 5 THEN 0 END AS obese_pct
              FROM bmi_v))
"""


@query("bmi_label", "WITH " + _BMI + "SELECT * EXCLUDE (has_val, has_pct, obese_val, obese_pct) FROM bmi")
def bmi_label(spark, sf_dir):
    return la.bmi_label(bmi_v(spark, sf_dir))


_COMBINED = """
    fresh AS (SELECT DISTINCT cust_id, index_dt, obese FROM bmi WHERE obese IS NOT NULL
              AND index_dt BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' AND cust_id NOT IN (SELECT cust_id FROM weight)
              QUALIFY index_dt = max(index_dt) OVER (PARTITION BY cust_id)),
    combined AS (SELECT * FROM weight UNION ALL SELECT * FROM fresh QUALIFY count(*) OVER (PARTITION BY cust_id) = 1)
"""


@query(
    "unambiguous_latest",
    "WITH " + _CURRENT + "," + _PRIOR + "," + _LABELS + "," + _BMI + "," + _COMBINED + "SELECT * FROM combined",
)
def unambiguous_latest(spark, sf_dir):
    return combined_labels(spark, sf_dir)


def combined_labels(spark, sf_dir):
    records = la.bmi_label(bmi_v(spark, sf_dir))
    return la.unambiguous_latest(records, weight_labels(spark, sf_dir), "2024-01-01", "2024-01-30")


INCLUSION, EXCLUSION, DELIVERY = ["Brand#18", "Brand#19", "Brand#20"], ["Brand#21"], ["Brand#22"]
_WINDOWS = f"""
    pdays AS (
        SELECT cust_id, event_dt, CASE WHEN d = 1 THEN 'd' WHEN p = 1 AND x = 0 THEN 'p' END AS assignment
        FROM (SELECT cust_id, event_dt, max(CASE WHEN {_in(INCLUSION)} THEN 1 ELSE 0 END) AS p,
                     max(CASE WHEN {_in(EXCLUSION)} THEN 1 ELSE 0 END) AS x, max(CASE WHEN {_in(DELIVERY)} THEN 1 ELSE 0 END) AS d
              FROM diagnoses_v WHERE {_in(INCLUSION + EXCLUSION + DELIVERY)} GROUP BY ALL)),
    dd AS (SELECT cust_id, event_dt FROM pdays WHERE assignment = 'd'
           UNION SELECT cust_id, event_dt FROM diagnoses_v WHERE drg = '1-URGENT' AND diag_cd = 'Brand#23'),
    dw AS (SELECT cust_id, CAST(event_dt - INTERVAL 9 MONTH AS DATE) AS exclude_start,
                  CAST(event_dt + INTERVAL 6 MONTH AS DATE) AS exclude_end FROM dd),
    pw AS (SELECT cust_id, CAST(event_dt - INTERVAL 9 MONTH AS DATE) AS exclude_start,
                  CAST(event_dt + INTERVAL 12 MONTH AS DATE) AS exclude_end FROM pdays
           WHERE assignment = 'p' AND NOT EXISTS (SELECT 1 FROM dw WHERE dw.cust_id = pdays.cust_id
                 AND pdays.event_dt BETWEEN dw.exclude_start AND dw.exclude_end)),
    wins AS (SELECT * FROM pw UNION ALL SELECT * FROM dw)
"""


def windows(spark, sf_dir):
    diagnoses = diagnoses_v(spark, sf_dir)
    events = diagnoses.where(F.col("diag_cd").isin(INCLUSION + EXCLUSION + DELIVERY))
    days = wi.pregnancy_days(events, INCLUSION, EXCLUSION, DELIVERY)
    drg_days = diagnoses.where((F.col("drg") == "1-URGENT") & (F.col("diag_cd") == "Brand#23"))
    return wi.exclusion_windows(days, drg_days.select("cust_id", "event_dt").distinct())


@query("exclusion_windows", "WITH " + _WINDOWS + "SELECT * FROM wins")
def exclusion_windows(spark, sf_dir):
    return windows(spark, sf_dir)


@query(
    "exclude_in_windows",
    "WITH "
    + _CURRENT
    + ","
    + _PRIOR
    + ","
    + _LABELS
    + ","
    + _WINDOWS
    + """
    SELECT * FROM weight WHERE NOT EXISTS (
        SELECT 1 FROM wins WHERE wins.cust_id = weight.cust_id AND index_dt BETWEEN exclude_start AND exclude_end)
    """,
)
def exclude_in_windows(spark, sf_dir):
    return wi.exclude_in_windows(weight_labels(spark, sf_dir), windows(spark, sf_dir))
