"""Episodes, scores, the study cohort, links, delivery windows and costs on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortweave.catalog.registry import query
from cohortweave.catalog.views import (
    base_day,
    claim_lines_v,
    claims_v,
    deliveries_v,
    enroll_v,
    members_v,
    plus,
    referrals_v,
    scores_v,
    table,
)
from cohortweave.operators import cohort as ch
from cohortweave.operators import costs
from cohortweave.operators import episodes as ep
from cohortweave.operators import linking as li
from cohortweave.operators import windows as wi

# ---- episodes

_EPISODES = """
    WITH gaps AS (
        SELECT *, date_diff('day', lag(from_dt) OVER w, from_dt) AS gap FROM claims_v
        WINDOW w AS (PARTITION BY person_id ORDER BY from_dt NULLS LAST, to_dt)),
    numbered AS (
        SELECT * EXCLUDE (gap), CAST(SUM(CASE WHEN gap > 140 THEN 1 ELSE 0 END) OVER (
            PARTITION BY person_id ORDER BY from_dt NULLS LAST, to_dt
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INT) AS episode
        FROM gaps)
"""


@query("gap_episodes", _EPISODES + "SELECT claim_id, person_id, from_dt, to_dt, episode FROM numbered")
def gap_episodes(spark, sf_dir):
    claims = claims_v(spark, sf_dir).select("claim_id", "person_id", "from_dt", "to_dt")
    return ep.gap_episodes(claims)


@query(
    "episode_spans",
    _EPISODES
    + """
    SELECT person_id, episode, MIN(from_dt) AS start_dt, MAX(to_dt) AS end_dt, COUNT(*) AS n_events
    FROM numbered GROUP BY person_id, episode
    """,
)
def episode_spans(spark, sf_dir):
    return ep.episode_spans(claims_v(spark, sf_dir))


_DELIVERY_EPISODES = """
    dgaps AS (
        SELECT *, date_diff('day', lag(from_dt) OVER w, from_dt) AS gap FROM deliveries_v
        WINDOW w AS (PARTITION BY person_id ORDER BY from_dt, to_dt, id_code)),
    dnum AS (
        SELECT * EXCLUDE (gap), CAST(SUM(CASE WHEN gap > 3 THEN 1 ELSE 0 END) OVER (
            PARTITION BY person_id ORDER BY from_dt, to_dt, id_code
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INT) AS deliv_id FROM dgaps),
    dflag AS (
        SELECT person_id, deliv_id, MIN(from_dt) AS deliv_start_dt, MAX(to_dt) AS deliv_end_dt,
            MAX(CASE WHEN substr(id_code,1,3) IN ('O80','O81','O82','O83') THEN 1 ELSE 0 END) AS singleton_o,
            MAX(CASE WHEN substr(id_code,1,3) = 'O84' THEN 1 ELSE 0 END) AS multiple_o,
            MAX(CASE WHEN substr(id_code,1,5) IN ('Z37.0','Z37.1','Z38.0','Z38.1','Z38.2') THEN 1 ELSE 0 END) AS singleton_z,
            MAX(CASE WHEN substr(id_code,1,5) IN ('Z37.2','Z37.3','Z37.4','Z37.5','Z37.6','Z37.7','Z37.8','Z38.3','Z38.4',
                'Z38.5','Z38.6','Z38.7','Z38.8') THEN 1 ELSE 0 END) AS multiple_z
        FROM dnum GROUP BY person_id, deliv_id),
    episodes AS (
        SELECT *, CAST(deliv_end_dt - deliv_start_dt AS INT) AS deliv_claims_days,
            CASE WHEN singleton_z = 1 THEN 1 WHEN singleton_o = 1 THEN 1 WHEN multiple_z = 1 THEN 0
                 WHEN multiple_o = 1 THEN 0 END AS singleton
        FROM dflag)
"""


def delivery_episodes(spark, sf_dir):
    return ep.episode_summary(deliveries_v(spark, sf_dir), max_gap=3)


@query("episode_summary", "WITH " + _DELIVERY_EPISODES + "SELECT * FROM episodes")
def episode_summary(spark, sf_dir):
    return delivery_episodes(spark, sf_dir)


@query(
    "latest_rows",
    """
    WITH d AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, event_type FROM events
               WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25')
    SELECT * FROM d QUALIFY rank() OVER (PARTITION BY user_id ORDER BY day DESC) = 1
    """,
)
def latest_rows(spark, sf_dir):
    days = table(spark, sf_dir, "events").select("event_id", "user_id", F.to_date("ts").alias("day"), "event_type")
    return ep.latest_rows(days, "user_id", "day", "2024-01-05", "2024-01-25")


# ---- scores and cohort

_HIGH = """
    high AS (SELECT * FROM scores_v WHERE score IS NOT NULL AND score > 0.2
             AND score_dt BETWEEN DATE '2024-01-01' AND DATE '2024-01-28')
"""


def high(spark, sf_dir):
    return ch.high_scores(scores_v(spark, sf_dir), "2024-01-01", "2024-01-28", 0.2)


@query("high_scores", "WITH " + _HIGH + "SELECT * FROM high")
def high_scores(spark, sf_dir):
    return high(spark, sf_dir)


_REFERRED = (
    _HIGH
    + """,
    cm AS (SELECT * EXCLUDE (population) FROM referrals_v WHERE population = 'maternity'),
    referred AS (
        SELECT DISTINCT h.person_id, h.score_dt, h.score, cm.file_date, cm.program_name, cm.assessment_complete_date, cm.engaged
        FROM high h FULL JOIN cm ON h.person_id = cm.person_id
        WHERE h.score IS NOT NULL
          AND (cm.file_date IS NULL OR cm.file_date BETWEEN h.score_dt AND h.score_dt + 60))
"""
)


def referred(spark, sf_dir):
    tracking = referrals_v(spark, sf_dir).where(F.col("population") == "maternity").drop("population")
    return ch.score_referral(high(spark, sf_dir), tracking)


@query("score_referral", "WITH " + _REFERRED + "SELECT * FROM referred")
def score_referral(spark, sf_dir):
    return referred(spark, sf_dir)


@query(
    "single_record",
    "WITH " + _REFERRED + "SELECT * FROM referred QUALIFY count(*) OVER (PARTITION BY person_id) = 1",
)
def single_record(spark, sf_dir):
    return ch.single_record(referred(spark, sf_dir))


_TIE_ORDER = (
    "score_dt DESC, score DESC NULLS LAST, file_date DESC NULLS LAST, program_name DESC NULLS LAST, "
    "assessment_complete_date DESC NULLS LAST, engaged DESC NULLS LAST"
)
TIES = ["score", "file_date", "program_name", "assessment_complete_date", "engaged"]


@query(
    "latest_before",
    "WITH "
    + _REFERRED
    + f"SELECT * FROM referred WHERE score_dt <= file_date "
    f"QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY {_TIE_ORDER}) = 1",
)
def latest_before(spark, sf_dir):
    return ch.latest_before(referred(spark, sf_dir), ties=TIES)


@query(
    "paired_scores",
    "WITH "
    + _HIGH
    + """,
    c AS (SELECT *, count(*) OVER p AS n, max(score_dt) OVER p AS hi, min(score_dt) OVER p AS lo FROM high
          WINDOW p AS (PARTITION BY person_id))
    SELECT person_id, score_dt, score FROM c WHERE n = 2 AND hi - lo <= 10 AND score_dt = hi
    """,
)
def paired_scores(spark, sf_dir):
    return ch.paired_score_rule(high(spark, sf_dir), max_days=10)


_DEDUPED = (
    _REFERRED
    + f""",
    single AS (SELECT * FROM referred QUALIFY count(*) OVER (PARTITION BY person_id) = 1),
    before AS (SELECT * FROM referred WHERE file_date IS NOT NULL AND score_dt <= file_date
               AND person_id NOT IN (SELECT person_id FROM single)
               QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY {_TIE_ORDER}) = 1),
    rest AS (SELECT *, count(*) OVER p AS n, max(score_dt) OVER p AS hi, min(score_dt) OVER p AS lo FROM referred
             WHERE person_id NOT IN (SELECT person_id FROM single) AND person_id NOT IN (SELECT person_id FROM before)
             WINDOW p AS (PARTITION BY person_id)),
    pool AS (SELECT * FROM single UNION ALL SELECT * FROM before
             UNION ALL SELECT * EXCLUDE (n, hi, lo) FROM rest WHERE n = 2 AND hi - lo <= 10 AND score_dt = hi)
"""
)


def pool(spark, sf_dir):
    return ch.dedupe_by_policy(referred(spark, sf_dir), max_days=10, ties=TIES)


@query("dedupe_by_policy", "WITH " + _DEDUPED + "SELECT * FROM pool")
def dedupe_by_policy(spark, sf_dir):
    return pool(spark, sf_dir)


_STUDY = (
    _DEDUPED
    + ","
    + _DELIVERY_EPISODES
    + """,
    matched AS (
        SELECT * FROM pool JOIN episodes USING (person_id)
        WHERE score_dt < deliv_start_dt AND deliv_start_dt BETWEEN score_dt AND score_dt + 14
        QUALIFY count(*) OVER (PARTITION BY person_id) = 1),
    study AS (
        SELECT *, CASE WHEN file_date IS NULL THEN 'Not Sent'
            WHEN engaged = 1 AND program_name = 'Maternity High Risk' AND days_between_assess_deliv > 3 THEN 'Engaged MHR'
            WHEN engaged = 1 AND program_name = 'Maternity High Risk' THEN 'Engaged MHR, too late?'
            WHEN engaged = 1 THEN 'Engaged Other Program' WHEN file_date IS NOT NULL THEN 'Sent, Not Engaged' END AS groups
        FROM (SELECT *, CAST(deliv_start_dt - assessment_complete_date AS INT) AS days_between_assess_deliv FROM matched))
"""
)


def matched(spark, sf_dir):
    return ch.attach_event_in_window(pool(spark, sf_dir), delivery_episodes(spark, sf_dir), weeks=2)


@query("event_in_window", "WITH " + _STUDY + "SELECT * FROM matched")
def event_in_window(spark, sf_dir):
    return matched(spark, sf_dir)


def study(spark, sf_dir):
    return ch.study_groups(matched(spark, sf_dir), min_days=3)


@query("study_groups", "WITH " + _STUDY + "SELECT * FROM study")
def study_groups(spark, sf_dir):
    return study(spark, sf_dir)


# ---- links

_SPAN_COHORT = "SELECT person_id, DATE '1998-01-01' + CAST(person_id % 365 AS INT) AS deliv_start_dt FROM members_v"


@query(
    "active_span_lookup",
    f"""
    WITH c AS ({_SPAN_COHORT}),
    active AS (SELECT e.* FROM enroll_v e JOIN c USING (person_id)
               WHERE deliv_start_dt BETWEEN eff_dt AND end_dt AND deliv_start_dt BETWEEN benefit_eff_dt AND benefit_end_dt)
    SELECT DISTINCT household_id, person_id FROM active
    QUALIFY eff_dt = max(eff_dt) OVER (PARTITION BY person_id)
    """,
)
def active_span_lookup(spark, sf_dir):
    cohort = members_v(spark, sf_dir).select(
        "person_id", base_day("1998-01-01", F.col("person_id") % 365).alias("deliv_start_dt")
    )
    intervals = [("eff_dt", "end_dt"), ("benefit_eff_dt", "benefit_end_dt")]
    return li.active_span_lookup(cohort, enroll_v(spark, sf_dir), "deliv_start_dt", intervals)


_MOTHERS = """
    mothers AS (
        SELECT person_id AS mother_id, hh_id, region_cd, birth_dt + CAST(30 + person_id % 15 AS INT) AS deliv_start_dt,
               birth_dt + CAST(30 + person_id % 15 + (person_id * 7) % 90 AS INT) AS deliv_end_dt
        FROM members_v),
    links AS (
        SELECT DISTINCT m.hh_id AS household_id, m.mother_id, i.person_id AS infant_id, i.birth_dt AS infant_birth_dt
        FROM mothers m JOIN members_v i ON m.hh_id = i.hh_id
        WHERE i.birth_dt BETWEEN deliv_start_dt - 7 AND deliv_end_dt + 7)
"""


def mothers(spark, sf_dir):
    k = F.col("person_id")
    return (
        members_v(spark, sf_dir)
        .withColumn("deliv_start_dt", plus("birth_dt", F.lit(30) + k % 15))
        .withColumn("deliv_claims_days", ((k * 7) % 90).cast("int"))
        .withColumn("deliv_end_dt", plus("deliv_start_dt", F.col("deliv_claims_days")))
    )


def household_links(spark, sf_dir):
    members = members_v(spark, sf_dir).withColumnRenamed("hh_id", "household_id")
    return li.link_by_household(mothers(spark, sf_dir), members.select("household_id", "person_id"), members)


@query("link_by_household", "WITH " + _MOTHERS + "SELECT * FROM links")
def link_by_household(spark, sf_dir):
    return household_links(spark, sf_dir)


@query(
    "group_proportions",
    "WITH "
    + _MOTHERS
    + """,
    marked AS (SELECT region_cd, CASE WHEN mother_id IN (SELECT mother_id FROM links) THEN 1 ELSE 0 END AS linked FROM mothers),
    counts AS (SELECT region_cd, linked, count(*) AS n FROM marked GROUP BY ALL)
    SELECT *, round(n / CAST(sum(n) OVER (PARTITION BY region_cd) AS DOUBLE), 9) AS prop FROM counts
    """,
)
def group_proportions(spark, sf_dir):
    linked = household_links(spark, sf_dir).select(F.col("mother_id").alias("person_id")).distinct()
    marked = mothers(spark, sf_dir).join(linked.withColumn("linked", F.lit(1)), "person_id", "left")
    marked = marked.withColumn("linked", F.coalesce("linked", F.lit(0)))
    return li.group_proportions(marked, "region_cd", "linked").withColumn("prop", F.round("prop", 9))


@query(
    "key_checks",
    """
    SELECT count(*) AS n_rows, count(DISTINCT hh_id) AS n_keys, count(hh_id) - count(DISTINCT hh_id) AS n_repeats,
           count(*) - count(hh_id) AS n_null_keys
    FROM members_v
    """,
)
def key_checks(spark, sf_dir):
    return li.key_checks(members_v(spark, sf_dir), "hh_id")


@query("unmatched_keys", "SELECT claim_id FROM claims_v EXCEPT SELECT claim_id FROM claim_lines_v")
def unmatched_keys(spark, sf_dir):
    return li.unmatched_keys(claims_v(spark, sf_dir), claim_lines_v(spark, sf_dir), "claim_id")


# ---- delivery windows

_ANCHORS = """
    anchors AS (
        SELECT mother_id, min(delivery_dt) AS delivery_dt, min(delivery_dt - 308) AS claim_window_start_dt,
               max(delivery_dt + 182) AS claim_window_end_dt
        FROM (SELECT m.mother_id, CASE WHEN infant_birth_dt IS NOT NULL THEN infant_birth_dt
                     WHEN deliv_end_dt - deliv_start_dt <= 60 THEN deliv_start_dt END AS delivery_dt
              FROM mothers m LEFT JOIN (SELECT DISTINCT mother_id, infant_birth_dt FROM links) l USING (mother_id))
        GROUP BY mother_id)
"""


@query("anchor_and_window", "WITH " + _MOTHERS + "," + _ANCHORS + "SELECT * FROM anchors")
def anchor_and_window(spark, sf_dir):
    return wi.anchor_and_window(mothers(spark, sf_dir), household_links(spark, sf_dir))


@query("weekly_histogram", "SELECT CAST(date_trunc('week', from_dt) AS DATE) AS week_dt, count(*) AS n FROM claims_v GROUP BY 1")
def weekly_histogram(spark, sf_dir):
    return wi.weekly_histogram(claims_v(spark, sf_dir), "from_dt")


# ---- interval costs

_COST_CTES = """
    anchors AS (SELECT person_id AS mother_id, DATE '1996-01-01' + CAST((person_id * 11) % 1500 AS INT) AS delivery_dt
                FROM members_v),
    links AS (SELECT person_id AS mother_id, person_id + 1 AS infant_id FROM members_v
              UNION ALL SELECT person_id, CASE WHEN person_id % 7 <> 0 THEN person_id + 2 END FROM members_v),
    mc AS (SELECT a.mother_id, a.delivery_dt, c.* FROM anchors a JOIN claims_v c ON a.mother_id = c.person_id),
    bc AS (SELECT a.mother_id, a.delivery_dt, c.* FROM anchors a JOIN links l USING (mother_id)
           JOIN claims_v c ON l.infant_id = c.person_id)
"""

_COST_CONDITIONS = {
    "m_admit_disch": ("mc", "delivery_dt BETWEEN admission_dt AND discharge_dt"),
    "m_admit_minus1": ("mc", "delivery_dt BETWEEN admission_dt - 1 AND discharge_dt"),
    "m_span_deliv": ("mc", "delivery_dt BETWEEN from_dt AND to_dt"),
    "m_deliv_minus1": ("mc", "delivery_dt BETWEEN from_dt - 1 AND to_dt"),
    "b_admit_disch": ("bc", "delivery_dt BETWEEN admission_dt AND discharge_dt"),
    "b_admit_plus7": ("bc", "admission_dt <= delivery_dt + 7"),
    "b_span_birth": ("bc", "delivery_dt BETWEEN from_dt AND to_dt"),
    "b_birth_plus7": ("bc", "from_dt <= delivery_dt + 7"),
}


def _cost_sql(name: str, skip: bool = False) -> str:
    source, condition = _COST_CONDITIONS[name]

    def total(column: str) -> str:
        value = f"CAST(sum({column}) AS DOUBLE)"
        return value if skip else f"CASE WHEN count(*) = count({column}) THEN {value} END"

    return (
        f"SELECT mother_id, {total('paid')} AS {name}_cost, {total('patient_paid')} AS {name}_patient_cost "
        f"FROM {source} WHERE {condition} GROUP BY mother_id"
    )


def cost_inputs(spark, sf_dir):
    k = F.col("person_id")
    members = members_v(spark, sf_dir)
    anchors = members.select(k.alias("mother_id"), base_day("1996-01-01", (k * 11) % 1500).alias("delivery_dt"))
    links = members.select(
        k.alias("mother_id"), F.explode(F.array(k + 1, F.when(k % 7 != 0, k + 2))).alias("infant_id")
    )
    return anchors, links, claims_v(spark, sf_dir)


def _doubles(df):
    return df.withColumns({c: F.col(c).cast("double") for c in df.columns if c.endswith("_cost")})


def _register_cost(outcome: costs.CostOutcome) -> None:
    name = outcome.paid_name.removesuffix("_cost")

    @query(f"cost_{name}", "WITH " + _COST_CTES + _cost_sql(name))
    def single_cost(spark, sf_dir):
        anchors, links, claims = cost_inputs(spark, sf_dir)
        return _doubles(costs.interval_cost(anchors, claims, outcome, links))


for _outcome in costs.delivery_outcomes():
    _register_cost(_outcome)


def _assembled_sql(skip: bool) -> str:
    joins = " ".join(f"LEFT JOIN ({_cost_sql(n, skip)}) {n} USING (mother_id)" for n in _COST_CONDITIONS)
    columns = ", ".join(f"{n}_cost, {n}_patient_cost" for n in _COST_CONDITIONS)
    return f"WITH {_COST_CTES} SELECT mother_id, {columns} FROM anchors {joins}"


@query("assembled_outcomes", _assembled_sql(False))
def assembled_outcomes(spark, sf_dir):
    anchors, links, claims = cost_inputs(spark, sf_dir)
    return _doubles(costs.assemble_outcomes(anchors, claims, links))


@query("assembled_outcomes_skip_null", _assembled_sql(True))
def assembled_outcomes_skip_null(spark, sf_dir):
    anchors, links, claims = cost_inputs(spark, sf_dir)
    return _doubles(costs.assemble_outcomes(anchors, claims, links, null_policy="skip"))
