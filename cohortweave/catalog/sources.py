"""Readers, code lists, code matching and claim shaping on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortweave.catalog.registry import query
from cohortweave.catalog.views import (
    claim_lines_v,
    claims_v,
    claims_wide_v,
    events_v,
    members_v,
    scores_v,
    table,
)
from cohortweave.functions.rules import label_rules
from cohortweave.operators import claims as cl
from cohortweave.operators import codes as co
from cohortweave.session import shared_path, written
from cohortweave.sources import codelists, tables


@query(
    "typed_csv",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, "
    "o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders",
)
def typed_csv(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate")
    )
    path = shared_path(spark, "orders-csv")
    tables.write_table(orders, path, "csv")
    return tables.read_typed_csv(spark, path, {"o_totalprice": "double", "o_orderdate": "date"}, escaped=True)


@query(
    "written_csv",
    """
    SELECT doc_id, text, lang, CASE doc_id % 6 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN '  ' || lang || ' '
           WHEN 4 THEN '"' || lang || '", ' || chr(10) || '\\n' || chr(13) || '\\' ELSE text || chr(10) END AS note
    FROM documents
    """,
)
def written_csv(spark, sf_dir):
    note = (
        "CASE doc_id % 6 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN concat('  ', lang, ' ') "
        "WHEN 4 THEN concat('\"', lang, '\", ', char(10), char(92), 'n', char(13), char(92)) ELSE concat(text, char(10)) END"
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", F.expr(note).alias("note"))
    path = shared_path(spark, "documents-csv")
    tables.write_table(docs, path, "csv")
    return tables.read_typed_csv(spark, path, {"doc_id": "bigint"}, escaped=True)


@query(
    "parquet_dates",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, "
    "o_orderpriority FROM orders",
)
def parquet_dates(spark, sf_dir):
    return tables.read_parquet_dates(spark, f"{sf_dir}/orders.parquet", suffix="date")


@query("written_table", "SELECT * FROM members_v")
def written_table(spark, sf_dir):
    path = shared_path(spark, "members")
    tables.write_table(members_v(spark, sf_dir), path, "parquet")
    return spark.read.parquet(path)


@query(
    "reference_code_list",
    """
    WITH picked AS (
        SELECT DISTINCT CASE WHEN length(p_brand) > 3 THEN substr(p_brand, 1, 3) || '.' || substr(p_brand, 4, 7)
                             ELSE p_brand END AS code
        FROM part
        WHERE p_type = 'ECONOMY' AND (contains(lower(p_name), 'ring') OR contains(lower(p_name), 'bolt'))
          AND p_brand IS NOT NULL)
    SELECT 'childbirth' AS list_name, code, CAST(length(code) AS INT) AS match_len FROM picked
    """,
)
def reference_code_list(spark, sf_dir):
    return codelists.code_list(
        table(spark, sf_dir, "part"),
        "childbirth",
        code_type="ECONOMY",
        definition_contains=["ring", "bolt"],
        lower=True,
        dotted=True,
        type_col="p_type",
        code_col="p_brand",
        definition_col="p_name",
    )


@query(
    "code_range_lines",
    """
    WITH lists AS (
        SELECT 'low' AS list_name, 'Brand#' || n AS code FROM range(1, 10) t(n)
        UNION ALL SELECT 'high', 'Brand#' || n FROM range(20, 26) t(n))
    SELECT list_name, code, CAST(length(code) AS INT) AS match_len, COUNT(*) AS n_lines
    FROM lists JOIN claim_lines_v ON code = proc_cd GROUP BY ALL
    """,
)
def code_range_lines(spark, sf_dir):
    lists = codelists.code_ranges(spark, [("low", "Brand#", 1, 9), ("high", "Brand#", 20, 25)])
    counts = claim_lines_v(spark, sf_dir).groupBy("proc_cd").agg(F.count(F.lit(1)).alias("n_lines"))
    return lists.join(counts, F.col("code") == F.col("proc_cd")).drop("proc_cd")


@query(
    "snapshot_features",
    """
    WITH snaps AS (
        SELECT CAST(ts AS DATE) AS snapshot_dt, user_id AS person_id, COUNT(*) AS age,
               MAX(event_id) AS previous_visit, MIN(event_id) AS race_code
        FROM events WHERE event_type = 'view' GROUP BY ALL)
    SELECT CAST(person_id AS VARCHAR) AS person_id, snapshot_dt, CAST(age AS VARCHAR) AS age,
           CAST(previous_visit AS VARCHAR) AS previous_visit, CAST(race_code AS VARCHAR) AS race_code
    FROM snaps WHERE EXISTS (SELECT 1 FROM scores_v s WHERE s.person_id = snaps.person_id AND s.score_dt = snapshot_dt)
    """,
)
def snapshot_features(spark, sf_dir):
    day = F.to_date("ts")
    snaps = (
        events_v(spark, sf_dir, "view")
        .groupBy(day.alias("day"), F.col("user_id").alias("person_id"))
        .agg(
            F.count(F.lit(1)).alias("age"),
            F.max("event_id").alias("previous_visit"),
            F.min("event_id").alias("race_code"),
            F.max("value").alias("unused"),
        )
        .withColumn("file", F.concat(F.lit("Feature_df_"), F.date_format("day", "MMddyyyy"), F.lit(".csv")))
        .drop("day")
    )
    folder = shared_path(spark, "snapshots")
    # one sorted file per date, as the nightly export leaves them
    snaps.repartition("file").write.partitionBy("file").option("header", True).csv(folder)
    keys = scores_v(spark, sf_dir).select(F.col("person_id").cast("string").alias("person_id"), "score_dt")
    return tables.snapshot_lookup(keys, folder, columns=["age"], prefixes=["previous", "race"])


DIAGNOSES = [f"diagnosis_{i}_cd" for i in range(1, 8)]


@query(
    "melted_codes",
    """
    SELECT claim_id, replace(replace(diag_seq, 'diagnosis_', ''), '_cd', '') AS diag_seq, diag_cd
    FROM (UNPIVOT claims_wide_v ON COLUMNS('^diagnosis_') INTO NAME diag_seq VALUE diag_cd) WHERE diag_cd IS NOT NULL
    """,
)
def melted_codes(spark, sf_dir):
    names = {c: c.replace("_cd", "") for c in DIAGNOSES}
    long = co.melt_codes(
        claims_wide_v(spark, sf_dir), ["claim_id"], r"^diagnosis_\d+$", rename=names, strip_prefix="diagnosis_"
    )
    return long.where(F.col("diag_cd").isNotNull())


_ANY_PREFIX = " OR ".join(f"substr({c}, 1, 7) IN ('Brand#1', 'Brand#3')" for c in DIAGNOSES)
_ANY_LISTED = " OR ".join(f"{c} IN (SELECT code FROM listed)" for c in DIAGNOSES)


@query("matched_codes", f"SELECT * FROM claims_wide_v WHERE {_ANY_PREFIX}")
def matched_codes(spark, sf_dir):
    return co.match_codes(claims_wide_v(spark, sf_dir), DIAGNOSES, ["Brand#1", "Brand#3"], match_len=7)


@query(
    "matched_code_table",
    f"""
    WITH listed AS (SELECT DISTINCT p_brand AS code FROM part WHERE p_type = 'PROMO' AND contains(p_name, 'red ring'))
    SELECT * FROM claims_wide_v WHERE {_ANY_LISTED}
    """,
)
def matched_code_table(spark, sf_dir):
    listed = codelists.code_list(
        table(spark, sf_dir, "part"),
        "promo",
        code_type="PROMO",
        definition_contains=["red ring"],
        type_col="p_type",
        code_col="p_brand",
        definition_col="p_name",
    )
    return co.match_codes(claims_wide_v(spark, sf_dir), DIAGNOSES, listed)


_ANY_HEAD = " OR ".join(
    f"substr({c}, 1, 7) IN ('Brand#4', 'Brand#5') OR substr({c}, 1, 8) IN ('Brand#21', 'Brand#22', 'Brand#23')" for c in DIAGNOSES
)


@query("matched_code_lengths", f"SELECT * FROM claims_wide_v WHERE {_ANY_HEAD}")
def matched_code_lengths(spark, sf_dir):
    listed = codelists.code_ranges(spark, [("short", "Brand#", 4, 5), ("long", "Brand#", 21, 23)])
    return co.match_codes(claims_wide_v(spark, sf_dir), DIAGNOSES, listed, co.PER_CODE)


_IGNORED = ["Brand#1", "Brand#2", "Brand#3"]


@query(
    "excluded_codes",
    "SELECT * FROM claim_lines_v WHERE NOT (proc_cd IN ('Brand#1','Brand#2','Brand#3')) "
    "AND NOT (rev_cd IN ('Brand#1','Brand#2','Brand#3'))",
)
def excluded_codes(spark, sf_dir):
    lines = claim_lines_v(spark, sf_dir)
    return co.exclude_codes(lines, ["proc_cd", "rev_cd"], _IGNORED)


@query(
    "excluded_codes_keep_null",
    "SELECT * FROM claim_lines_v WHERE NOT coalesce(proc_cd IN ('Brand#1','Brand#2','Brand#3'), FALSE) "
    "AND NOT coalesce(rev_cd IN ('Brand#1','Brand#2','Brand#3'), FALSE)",
)
def excluded_codes_keep_null(spark, sf_dir):
    return co.exclude_codes(claim_lines_v(spark, sf_dir), ["proc_cd", "rev_cd"], _IGNORED, null_policy="keep")


TIERS = ["icd10_1st", "drg", "icd10_2nd", "revenue", "cpt"]
_FIRST, _SECOND = ["Brand#11"], [("icd10_2nd", "Brand#", 20, 22)]


def _diagnosis_finds(method: str, listed: str) -> str:
    return f"""
        SELECT person_id, from_dt, to_dt, '{method}' AS id_method, code AS id_code
        FROM claims_v JOIN (UNPIVOT claims_wide_v ON COLUMNS('^diagnosis_') INTO NAME diag_seq VALUE code) USING (claim_id) WHERE code IN ({listed})"""


def _line_finds(method: str, column: str, listed: str) -> str:
    return f"""
        SELECT person_id, line_dt AS from_dt, line_dt AS to_dt, '{method}' AS id_method, {column} AS id_code
        FROM claims_v JOIN claim_lines_v USING (claim_id) WHERE {column} IN ({listed})"""


_TIERS = f"""
    WITH all_finds AS (
        SELECT 0 AS tier, * FROM ({_diagnosis_finds("icd10_1st", "'Brand#11'")})
        UNION SELECT 1, person_id, from_dt, to_dt, 'drg', coalesce(drg, status)
              FROM claims_v WHERE substr(drg, 1, 1) IN ('1') OR substr(status, 1, 1) IN ('1')
        UNION SELECT 2, * FROM ({_diagnosis_finds("icd10_2nd", "SELECT 'Brand#' || n FROM range(20, 23) t(n) UNION SELECT p_brand FROM part WHERE p_type = 'ECONOMY' AND (contains(p_name, 'red ring') OR contains(p_name, 'blue bolt'))")})
        UNION SELECT 3, * FROM ({_line_finds("revenue", "rev_cd", "SELECT p_type FROM part WHERE p_type = 'PROMO'")})
        UNION SELECT 4, * FROM ({_line_finds("cpt", "proc_cd", "SELECT p_brand FROM part WHERE p_type = 'SMALL' AND contains(lower(p_name), 'widget')")})),
    finds AS (SELECT * EXCLUDE (tier) FROM all_finds QUALIFY tier = min(tier) OVER (PARTITION BY person_id))
"""


def claim_tables(spark, sf_dir):
    """The claim headers with their diagnoses and the claim lines, as the five code systems read them.

    Orders, line items and parts are each read once: both tables come from one written table.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    lines = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    claims = claims_v(spark, sf_dir).select("claim_id", "person_id", "from_dt", "to_dt", "drg", "status")
    joined = claims.join(lines, F.col("claim_id") == F.col("l_orderkey"), "left").select(
        *claims.columns,
        F.col("l_linenumber").alias("line_no"),
        F.col("p_brand").alias("diagnosis"),
        F.when(F.col("l_partkey") % 10 != 0, F.col("p_brand")).alias("proc_cd"),
        F.col("p_type").alias("rev_cd"),
        F.to_date("l_shipdate").alias("line_dt"),
    )
    joined = written(joined, "claim-lines")
    diagnoses = [F.max(F.when(F.col("line_no") == i, F.col("diagnosis"))).alias(f"diagnosis_{i}_cd") for i in range(1, 8)]
    headers = joined.groupBy("claim_id").agg(*[F.first(c).alias(c) for c in claims.columns if c != "claim_id"], *diagnoses)
    return headers, joined.where(F.col("line_no").isNotNull())


def identified(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    columns = {"type_col": "p_type", "code_col": "p_brand", "definition_col": "p_name"}
    listed = codelists.code_list(part, "icd10_2nd", code_type="ECONOMY", definition_contains=["red ring", "blue bolt"], **columns)
    second = codelists.code_ranges(spark, _SECOND).unionByName(listed)
    revenue = codelists.code_list(part.withColumn("code", F.col("p_type")), "revenue", code_type="PROMO", type_col="p_type")
    cpt = codelists.code_list(part, "cpt", code_type="SMALL", definition_contains=["widget"], lower=True, **columns)
    whole = F.lit(None).cast("int")  # codes are compared as wholes
    headers, lines = claim_tables(spark, sf_dir)
    return co.identify_by_tiers(
        [
            co.TierTable(
                headers,
                (
                    co.TierRule("icd10_1st", tuple(DIAGNOSES), codelists.code_literals(spark, {"icd10_1st": _FIRST}).withColumn("match_len", whole)),
                    co.TierRule("drg", ("drg", "status"), codelists.code_literals(spark, {"drg": ["1"]}), "first"),
                    co.TierRule("icd10_2nd", tuple(DIAGNOSES), second.withColumn("match_len", whole)),
                ),
            ),
            co.TierTable(
                lines,
                (co.TierRule("revenue", ("rev_cd",), revenue.withColumn("match_len", whole)), co.TierRule("cpt", ("proc_cd",), cpt.withColumn("match_len", whole))),
                from_dt="line_dt",
                to_dt="line_dt",
            ),
        ],
        TIERS,
    )


@query("tiered_identify", _TIERS + "SELECT * FROM finds")
def tiered_identify(spark, sf_dir):
    return identified(spark, sf_dir)


@query("method_counts", _TIERS + "SELECT id_method, COUNT(*) AS n FROM finds WHERE id_method IS NOT NULL GROUP BY 1")
def method_counts(spark, sf_dir):
    return co.method_counts(identified(spark, sf_dir))


@query(
    "code_family_flags",
    """
    SELECT claim_id, MAX(CASE WHEN substr(proc_cd, 1, 7) IN ('Brand#1') THEN 1 ELSE 0 END) AS ones,
           MAX(CASE WHEN substr(proc_cd, 1, 7) IN ('Brand#2') THEN 1 ELSE 0 END) AS twos,
           MAX(CASE WHEN proc_cd IN ('Brand#5', 'Brand#25') THEN 1 ELSE 0 END) AS fives
    FROM claim_lines_v GROUP BY claim_id
    """,
)
def code_family_flags(spark, sf_dir):
    families = {"ones": (["Brand#1"], 7), "twos": (["Brand#2"], 7), "fives": (["Brand#5", "Brand#25"], None)}
    return co.code_flags(claim_lines_v(spark, sf_dir), "proc_cd", families, ["claim_id"])


@query(
    "claim_star",
    """
    SELECT o_orderkey AS claim_header_pk, o_orderpriority AS place_of_service_cd,
           CAST(o_orderdate AS DATE) AS claim_service_from_dt, l_linenumber AS line_no,
           l_returnflag || l_linestatus AS claim_ln_place_of_service_cd, l_partkey AS medical_procedure_cd_fk,
           l_suppkey AS medical_revenue_cd_fk, p_brand AS procedure_cd, s_name AS revenue_cd2
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
         LEFT JOIN (SELECT * FROM part WHERE p_type = 'PROMO') ON l_partkey = p_partkey
         LEFT JOIN supplier ON l_suppkey = s_suppkey
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
    """,
)
def claim_star(spark, sf_dir):
    header = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("claim_header_pk"),
        F.col("o_orderpriority").alias("place_of_service_cd"),
        F.to_date("o_orderdate").alias("claim_service_from_dt"),
    )
    detail = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("claim_header_fk"),
        F.col("l_linenumber").alias("line_no"),
        F.concat("l_returnflag", "l_linestatus").alias("place_of_service_cd"),
        F.col("l_partkey").alias("medical_procedure_cd_fk"),
        F.col("l_suppkey").alias("medical_revenue_cd_fk"),
    )
    procedures = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("medical_procedure_cd_pk"),
        F.col("p_type").alias("procedural_coding_system_cd"),
        F.col("p_brand").alias("procedure_cd"),
    )
    revenues = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("medical_revenue_cd_pk"), F.col("s_name").alias("revenue_cd")
    )
    return cl.claim_lines(
        header, detail, procedures, revenues, first="1996-01-01", last="2000-12-31", coding_system="PROMO"
    )


_CROSSWALK = """
    WITH claims AS (
        SELECT o_custkey AS member_id, o_orderkey AS claim_id, CAST(o_orderdate AS DATE) AS firstdos,
               o_orderstatus AS clmstat, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'M' END AS sexcod,
               CAST(floor(o_totalprice / 6000) AS INT) AS ageyears
        FROM orders),
    pairs AS (SELECT DISTINCT c_custkey AS member_id, 'C' || (c_custkey // 2) AS cust_id, c_acctbal FROM customer)
"""


def _crosswalk_inputs(spark, sf_dir):
    k = F.col("c_custkey")
    membership = table(spark, sf_dir, "customer").select(
        k.alias("member_id"), F.concat(F.lit("C"), F.floor(k / 2).cast("bigint").cast("string")).alias("cust_id"), "c_acctbal"
    )
    claims = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("member_id"),
        F.col("o_orderkey").alias("claim_id"),
        F.to_date("o_orderdate").alias("firstdos"),
        F.col("o_orderstatus").alias("clmstat"),
        F.when(F.col("o_orderstatus") == "F", "F").otherwise("M").alias("sexcod"),
        F.floor(F.col("o_totalprice") / 6000).cast("int").alias("ageyears"),
    )
    return membership, claims


@query(
    "crosswalk_claims_by_status",
    _CROSSWALK
    + """
    SELECT member_id, cust_id, claim_id, firstdos, clmstat, sexcod, ageyears FROM claims
    JOIN (SELECT DISTINCT member_id, cust_id FROM pairs
          WHERE cust_id IN (SELECT cust_id FROM pairs WHERE c_acctbal > 0)) USING (member_id)
    WHERE clmstat IN ('P', 'F')
    """,
)
def crosswalk_claims_by_status(spark, sf_dir):
    membership, claims = _crosswalk_inputs(spark, sf_dir)
    eligible = membership.where(F.col("c_acctbal") > 0)
    return cl.person_crosswalk_claims(membership, claims, eligible, status=["P", "F"])


@query(
    "crosswalk_claims_by_sex_age",
    _CROSSWALK
    + """
    SELECT member_id, cust_id, claim_id, firstdos, clmstat, sexcod, ageyears
    FROM claims JOIN pairs USING (member_id) WHERE sexcod = 'F' AND ageyears BETWEEN 8 AND 50
    """,
)
def crosswalk_claims_by_sex_age(spark, sf_dir):
    membership, claims = _crosswalk_inputs(spark, sf_dir)
    return cl.person_crosswalk_claims(membership, claims, sex="F", ages=(8, 50))


@query(
    "ordered_labels",
    """
    SELECT claim_id, CASE WHEN paid > 400000 THEN 'high' WHEN admission_dt IS NOT NULL AND paid > 200000 THEN 'inpatient'
           WHEN status = 'P' THEN 'pending' WHEN paid <= 100000 THEN 'low' ELSE 'other' END AS label
    FROM claims_v
    """,
)
def ordered_labels(spark, sf_dir):
    rules = [
        (F.col("paid") > 400000, "high"),
        (F.col("admission_dt").isNotNull() & (F.col("paid") > 200000), "inpatient"),
        (F.col("status") == "P", "pending"),
        (F.col("paid") <= 100000, "low"),
    ]
    return label_rules(claims_v(spark, sf_dir), "label", rules, "other").select("claim_id", "label")
