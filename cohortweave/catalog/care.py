"""Enrolment, long-term-care flags, stays, index dates and categories on the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cohortweave.catalog.registry import query
from cohortweave.catalog.views import care_lines_v, claims_v, enroll_v, members_v, table
from cohortweave.operators import care_groups as cg
from cohortweave.operators import enrolment as en

# ---- enrolment

_MARKS_6 = "(SELECT CAST(DATE '1999-01-01' - to_months(i) AS DATE) AS mark FROM range(0, 6) t(i)) marks"
_MARKS_24 = "(SELECT CAST(DATE '1997-01-01' + to_months(i) AS DATE) AS mark FROM range(0, 24) t(i)) marks"


@query(
    "enrolled_k_of_n",
    f"""
    SELECT person_id, CAST(count(DISTINCT mark) AS INT) AS n_months FROM enroll_v JOIN {_MARKS_6}
    ON eff_dt <= mark AND end_dt > mark GROUP BY person_id HAVING count(DISTINCT mark) >= 4
    """,
)
def enrolled_k_of_n(spark, sf_dir):
    return en.enrolled_k_of_n(enroll_v(spark, sf_dir), dt.date(1999, 1, 1), 6, 4, start="eff_dt", end="end_dt")


_MONTHS = f"""
    months AS (
        SELECT person_id, CAST(count(DISTINCT mark) AS INT) AS months_enrolled
        FROM enroll_v LEFT JOIN {_MARKS_24} ON mark BETWEEN eff_dt AND end_dt GROUP BY person_id)
"""


def _months(spark, sf_dir):
    return en.months_enrolled(enroll_v(spark, sf_dir), dt.date(1997, 1, 1), 24, start="eff_dt", end="end_dt")


@query(
    "months_enrolled",
    "WITH "
    + _MONTHS
    + "SELECT *, CAST(months_enrolled = 24 AS INT) AS enroll_24mo, CAST(months_enrolled >= 12 AS INT) AS enroll_12mo, "
    "CAST(months_enrolled >= 6 AS INT) AS enroll_6mo FROM months",
)
def months_enrolled(spark, sf_dir):
    return en.enrolment_thresholds(_months(spark, sf_dir))


_OVERLAP = (
    "end_dt >= DATE '{0}' AND eff_dt <= DATE '{1}' AND benefit_end_dt >= DATE '{0}' AND benefit_eff_dt <= DATE '{1}'"
)


@query(
    "members_in_period",
    f"""
    SELECT e.*, birth_dt, region_cd FROM enroll_v e JOIN members_v USING (person_id)
    WHERE {_OVERLAP.format('1997-01-01', '1999-12-31')} AND birth_dt <= DATE '1964-01-01'
    """,
)
def members_in_period(spark, sf_dir):
    persons = members_v(spark, sf_dir).select("person_id", "birth_dt", "region_cd")
    return en.members_in_period(enroll_v(spark, sf_dir), persons, "1997-01-01", "1999-12-31", "1964-01-01")


# ---- flags

PERIODS = {"99": ("1999-01-01", "1999-12-31"), "9798": ("1997-01-01", "1998-12-31")}
NURSING, SNF, DAY_CARE = ["1-URGENT", "NO"], ["RF"], ["Brand#1", "Brand#2", "Brand#3"]
HOME_PROCEDURES, HOME_REVENUES = ["Brand#7"], ["23"]


def _rules(null_policy="drop"):
    return cg.care_rules(
        nursing_home=NURSING,
        snf=SNF,
        day_care=DAY_CARE,
        home_procedures=HOME_PROCEDURES,
        home_revenues=HOME_REVENUES,
        null_policy=null_policy,
    )


def _flags_sql(null_policy: str = "drop") -> str:
    def no_day_care(column: str) -> str:
        hit = f"{column} IN ('Brand#1','Brand#2','Brand#3')"
        return f"NOT ({hit})" if null_policy == "drop" else f"NOT coalesce({hit}, FALSE)"

    excluded = " AND ".join(no_day_care(c) for c in ("cpt_cd", "service_cd", "procedure_cd"))
    place = "(place_of_service_cd IN ({0}) OR claim_ln_place_of_service_cd IN ({0}))"
    home = "(cpt_cd IN ('Brand#7') OR service_cd IN ('Brand#7') OR procedure_cd IN ('Brand#7') OR revenue_cd IN ('23') OR revenue_cd2 IN ('23'))"
    day_care = " OR ".join(f"{c} IN ('Brand#1','Brand#2','Brand#3')" for c in ("cpt_cd", "service_cd", "procedure_cd"))
    rules = {
        "utiliz": "TRUE",
        "iltc": place.format("'1-URGENT','NO'") + f" AND {excluded}",
        "snf": place.format("'RF'") + f" AND {excluded}",
        "hltc": home,
        "cltc": f"({day_care})",
    }
    flags = []
    for name, rule in rules.items():
        for suffix, (first, last) in PERIODS.items():
            inner = (
                f"SELECT cust_id FROM xwalk JOIN care_lines_v USING (person_id) WHERE {rule} "
                f"AND claim_service_from_dt BETWEEN DATE '{first}' AND DATE '{last}'"
            )
            flags.append(f"CASE WHEN cust_id IN ({inner}) THEN 1 ELSE 0 END AS {name}_{suffix}")
    return f"""
    xwalk AS (SELECT DISTINCT 'C' || person_id AS cust_id, person_id FROM enroll_v
              WHERE {_OVERLAP.format('1997-01-01', '1999-12-31')}),
    people AS (SELECT DISTINCT 'C' || person_id AS cust_id FROM enroll_v
               WHERE {_OVERLAP.format('1999-01-01', '1999-12-31')}),
    flags AS (SELECT cust_id, {", ".join(flags)} FROM people)
    """


def _with_cust(df):
    return df.withColumn("cust_id", F.concat(F.lit("C"), F.col("person_id").cast("string")))


def _people(spark, sf_dir):
    spans = enroll_v(spark, sf_dir)
    members = _with_cust(en.members_in_period(spans, None, "1997-01-01", "1999-12-31"))
    now = _with_cust(en.members_in_period(spans, None, "1999-01-01", "1999-12-31"))
    return members, now


def _flags(spark, sf_dir, null_policy="drop"):
    members, now = _people(spark, sf_dir)
    return cg.period_flags(now, members, care_lines_v(spark, sf_dir), _rules(null_policy), PERIODS)


@query("period_flags", "WITH " + _flags_sql() + "SELECT * FROM flags")
def period_flags(spark, sf_dir):
    return _flags(spark, sf_dir)


@query("period_flags_keep_null", "WITH " + _flags_sql("keep") + "SELECT * FROM flags")
def period_flags_keep_null(spark, sf_dir):
    return _flags(spark, sf_dir, "keep")


# ---- member-months and stays

YEARS = [1997, 1998, 1999, 2000]
_SNF_NH = "CASE WHEN status = 'P' THEN 1 ELSE 0 END AS snf, CASE WHEN status IN ('F','O') THEN 1 ELSE 0 END AS nh"
_MM = f"""
    rows AS (SELECT person_id, from_dt, to_dt, {_SNF_NH} FROM claims_v WHERE year(from_dt) IN (1997, 1998, 1999, 2000)),
    ends AS (SELECT person_id, year(from_dt) AS yr, month(from_dt) AS mo, snf, nh FROM rows
             UNION ALL SELECT person_id, year(to_dt), month(to_dt), snf, nh FROM rows),
    mm AS (SELECT person_id, CAST(yr AS INT) AS yr, CAST(mo AS INT) AS mo, max(snf) AS snf, max(nh) AS nh FROM ends
           WHERE yr IN (1997, 1998, 1999) OR (yr = 2000 AND mo IN (1, 2, 3))
           GROUP BY ALL HAVING max(snf) = 1 OR max(nh) = 1)
"""


def _member_months(spark, sf_dir, endpoints_only=True):
    return cg.member_months(
        claims_v(spark, sf_dir),
        start="from_dt",
        end="to_dt",
        snf=F.col("status") == "P",
        nh=F.col("status").isin("F", "O"),
        from_years=YEARS,
        last_month="2000-03-01",
        endpoints_only=endpoints_only,
    )


@query("member_months", "WITH " + _MM + "SELECT * FROM mm")
def member_months(spark, sf_dir):
    return _member_months(spark, sf_dir)


@query(
    "member_months_all",
    f"""
    WITH rows AS (
        SELECT person_id, unnest(generate_series(date_trunc('month', from_dt), date_trunc('month', to_dt), INTERVAL 1 MONTH)) AS m,
               {_SNF_NH} FROM claims_v WHERE year(from_dt) IN (1997, 1998, 1999, 2000))
    SELECT person_id, CAST(year(m) AS INT) AS yr, CAST(month(m) AS INT) AS mo, max(snf) AS snf, max(nh) AS nh
    FROM rows WHERE m BETWEEN DATE '1997-01-01' AND DATE '2000-03-01' GROUP BY ALL
    """,
)
def member_months_all(spark, sf_dir):
    return _member_months(spark, sf_dir, endpoints_only=False)


_STAYS = """
    d AS (SELECT *, yr * 12 + mo AS m, yr * 12 + mo - lag(yr * 12 + mo) OVER (PARTITION BY person_id ORDER BY yr, mo) AS diff FROM mm),
    v AS (SELECT *, CAST(sum(CASE WHEN diff > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY person_id ORDER BY m
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INT) AS visit_id FROM d),
    s AS (SELECT *, row_number() OVER w AS rn, sum(snf) OVER (PARTITION BY person_id, visit_id ORDER BY m
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS snf_so_far FROM v
          WINDOW w AS (PARTITION BY person_id, visit_id ORDER BY m)),
    k AS (SELECT *, count(*) OVER (PARTITION BY person_id, visit_id) AS n FROM s WHERE snf_so_far <> rn),
    stays AS (SELECT person_id, CAST(min(yr) AS INT) AS yr_start, min(make_date(yr, mo, 1)) AS min_iltc4_month
              FROM k WHERE n >= 3 GROUP BY person_id)
"""
MIN_MONTHS = 3


def _stays(spark, sf_dir, **options):
    return cg.long_stays(_member_months(spark, sf_dir), MIN_MONTHS, **options)


@query("long_stays", "WITH " + _MM + "," + _STAYS + "SELECT * FROM stays")
def long_stays(spark, sf_dir):
    return _stays(spark, sf_dir)


@query(
    "long_stays_per_stay",
    "WITH "
    + _MM
    + ","
    + _STAYS
    + """
    SELECT person_id, visit_id, CAST(year(min(make_date(yr, mo, 1))) AS INT) AS yr_start, min(make_date(yr, mo, 1)) AS min_iltc4_month
    FROM k WHERE n >= 3 GROUP BY person_id, visit_id
    """,
)
def long_stays_per_stay(spark, sf_dir):
    return _stays(spark, sf_dir, per_stay=True)


STAY_PERIODS = {"99": [1999], "9798": [1997, 1998]}
_STAY_FLAGS = """
    stay_flags AS (
        SELECT person_id, max(CASE WHEN yr_start IN (1999) THEN 1 ELSE 0 END) AS iltc_4m_99,
               max(CASE WHEN yr_start IN (1997, 1998) THEN 1 ELSE 0 END) AS iltc_4m_9798
        FROM stays GROUP BY person_id)
"""


@query("long_stay_flags", "WITH " + _MM + "," + _STAYS + "," + _STAY_FLAGS + "SELECT * FROM stay_flags")
def long_stay_flags(spark, sf_dir):
    return cg.long_stay_flags(_stays(spark, sf_dir), STAY_PERIODS)


_FIRST_INST = """
    first_inst AS (
        SELECT person_id, min_iltc_month, min_iltc4_month
        FROM (SELECT person_id, min(make_date(yr, mo, 1)) AS min_iltc_month FROM mm WHERE nh = 1 GROUP BY person_id)
        LEFT JOIN stays USING (person_id))
"""


def _first_institution(spark, sf_dir):
    return cg.first_institution_month(_member_months(spark, sf_dir), _stays(spark, sf_dir))


@query("first_institution_month", "WITH " + _MM + "," + _STAYS + "," + _FIRST_INST + "SELECT * FROM first_inst")
def first_institution_month(spark, sf_dir):
    return _first_institution(spark, sf_dir)


_FIRST_HOME = """
    first_home AS (
        SELECT person_id, CAST(date_trunc('month', min(claim_service_from_dt)) AS DATE) AS min_hltc_month
        FROM care_lines_v
        WHERE (cpt_cd = 'Brand#7' OR service_cd = 'Brand#7' OR procedure_cd = 'Brand#7' OR revenue_cd = '23' OR revenue_cd2 = '23')
          AND claim_service_from_dt BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'
        GROUP BY person_id)
"""


def _first_homecare(spark, sf_dir):
    return cg.first_homecare_month(care_lines_v(spark, sf_dir), _rules()["hltc"], "1997-01-01", "1999-12-31")


@query("first_homecare_month", "WITH " + _FIRST_HOME + "SELECT * FROM first_home")
def first_homecare_month(spark, sf_dir):
    return _first_homecare(spark, sf_dir)


@query(
    "events_by_text",
    """
    SELECT user_id, min(CAST(ts AS DATE)) AS death_dt FROM events
    WHERE (lower(event_type) LIKE '%urch%' OR lower(event_type) LIKE '%err%') AND year(ts) = 2024 GROUP BY user_id
    """,
)
def events_by_text(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", F.to_date("ts").alias("event_dt"))
    return cg.events_by_text(events, 2024, ["%urch%", "%err%"], key="user_id", text="event_type")


# ---- index date and category

_DEATHS = """
    deaths AS (SELECT o_custkey AS person_id, min(CAST(o_orderdate AS DATE)) AS death_dt FROM orders
               WHERE lower(o_orderpriority) LIKE '%low%' AND year(o_orderdate) = 1999 GROUP BY 1)
"""
_GROUPED = (
    "WITH "
    + _flags_sql()
    + ","
    + _MM
    + ","
    + _STAYS
    + ","
    + _STAY_FLAGS
    + ","
    + _FIRST_INST
    + ","
    + _FIRST_HOME
    + ","
    + _MONTHS
    + ","
    + _DEATHS
    + """,
    joined AS (
        SELECT flags.*, CAST(substr(cust_id, 2) AS BIGINT) AS person_id, coalesce(iltc_4m_99, 0) AS iltc_4m_99,
               coalesce(iltc_4m_9798, 0) AS iltc_4m_9798, months_enrolled, min_iltc_month, min_iltc4_month, min_hltc_month, death_dt
        FROM flags LEFT JOIN stay_flags ON stay_flags.person_id = CAST(substr(cust_id, 2) AS BIGINT)
        LEFT JOIN months ON months.person_id = CAST(substr(cust_id, 2) AS BIGINT)
        LEFT JOIN first_inst ON first_inst.person_id = CAST(substr(cust_id, 2) AS BIGINT)
        LEFT JOIN first_home ON first_home.person_id = CAST(substr(cust_id, 2) AS BIGINT)
        LEFT JOIN deaths ON deaths.person_id = CAST(substr(cust_id, 2) AS BIGINT)),
    indexed AS (
        SELECT *, last_day(CASE
            WHEN iltc_4m_99 = 1 AND min_iltc4_month >= DATE '1999-01-01' THEN min_iltc4_month
            WHEN iltc_99 = 1 AND min_iltc_month >= DATE '1999-01-01' THEN min_iltc_month
            WHEN hltc_99 = 1 AND min_hltc_month >= DATE '1999-01-01' THEN min_hltc_month
            WHEN death_dt IS NOT NULL AND death_dt >= DATE '1999-01-01' THEN death_dt
            ELSE make_date(1999, CAST(CAST('0x' || substr(md5(cust_id || '789'), 1, 8) AS BIGINT) % 12 + 1 AS INT), 1) END) AS index_dt
        FROM joined),
    labelled AS (
        SELECT *, CASE WHEN months_enrolled < 6 OR utiliz_99 = 0 THEN 'Not in study'
            WHEN iltc_4m_99 = 1 AND iltc_4m_9798 = 0 THEN 'ILTC long 1999, start 1999'
            WHEN iltc_4m_99 = 1 AND iltc_4m_9798 = 1 THEN 'ILTC long 1999, start 97-98'
            WHEN iltc_99 = 1 AND iltc_9798 = 0 THEN 'ILTC short 1999, start 1999'
            WHEN iltc_99 = 1 AND iltc_9798 = 1 THEN 'ILTC short 1999, start 97-98'
            WHEN hltc_99 = 1 AND hltc_9798 = 0 THEN 'HLTC 1999, start 1999'
            WHEN hltc_99 = 1 AND hltc_9798 = 1 THEN 'HLTC 1999, start 97-98'
            WHEN iltc_99 = 0 AND hltc_99 = 0 AND iltc_9798 = 0 AND hltc_9798 = 0 THEN 'No LTC 1999, nor 97-98'
            WHEN iltc_99 = 0 AND hltc_99 = 0 AND (iltc_9798 = 1 OR hltc_9798 = 1) THEN 'No LTC 1999, but LTC in 97-98' END AS ltc_cat
        FROM indexed)
    """
)


def _grouped(spark, sf_dir):
    """Flags of everybody enrolled in the year, with months, candidate dates and deaths."""
    deaths = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("person_id"), F.col("o_orderpriority").alias("reason"), F.to_date("o_orderdate").alias("event_dt")
    )
    deaths = cg.events_by_text(deaths, 1999, ["%low%"], key="person_id")
    joined = _flags(spark, sf_dir).withColumn("person_id", F.expr("substring(cust_id, 2)").cast("bigint"))
    sides = [
        cg.long_stay_flags(_stays(spark, sf_dir), STAY_PERIODS),
        _months(spark, sf_dir),
        _first_institution(spark, sf_dir),
        _first_homecare(spark, sf_dir),
        deaths,
    ]
    for side in sides:
        joined = joined.join(side, "person_id", "left")
    return joined.withColumns({f"iltc_4m_{p}": F.coalesce(f"iltc_4m_{p}", F.lit(0)) for p in PERIODS})


@query("index_date", _GROUPED + "SELECT cust_id, index_dt FROM indexed")
def index_date(spark, sf_dir):
    return cg.index_date(_grouped(spark, sf_dir), 1999, suffix="99").select("cust_id", "index_dt")


@query("ltc_category", _GROUPED + "SELECT cust_id, ltc_cat FROM labelled")
def ltc_category(spark, sf_dir):
    grouped = _grouped(spark, sf_dir)
    return cg.ltc_category(grouped, "99", "9798", 6, "1999", "97-98").select("cust_id", "ltc_cat")
