"""Claims-shaped views over the driver's tables, as DataFrames and as the same SQL.

Every view maps a whole table; NULLs and end dates come from column formulas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PRICE = "decimal(18,2)"


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its footer is read for the schema once, not by every view that uses it."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def plus(day: str | Column, days: Column) -> Column:
    return F.date_add(F.col(day) if isinstance(day, str) else day, days.cast("int"))


def base_day(text: str, days: Column) -> Column:
    return plus(F.lit(text).cast("date"), days)


def claims_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    inpatient = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    from_dt = F.to_date("o_orderdate")
    to_dt = plus(from_dt, F.col("o_orderkey") % 40)
    return o.select(
        F.col("o_custkey").alias("person_id"),
        F.col("o_orderkey").alias("claim_id"),
        from_dt.alias("from_dt"),
        to_dt.alias("to_dt"),
        F.when(inpatient, from_dt).alias("admission_dt"),
        F.when(inpatient, to_dt).alias("discharge_dt"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("drg"),
        F.when(F.col("o_orderkey") % 50 != 0, F.col("o_totalprice").cast(PRICE)).alias("paid"),
        (F.col("o_orderkey") % 1000).cast(PRICE).alias("patient_paid"),
    )


def claim_lines_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return (
        table(spark, sf_dir, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").alias("claim_id"),
            F.col("l_linenumber").alias("line_no"),
            F.concat("l_returnflag", "l_linestatus").alias("place_of_service"),
            F.when(F.col("l_partkey") % 10 != 0, F.col("p_brand")).alias("proc_cd"),
            F.col("p_type").alias("rev_cd"),
            F.to_date("l_shipdate").alias("line_dt"),
            F.col("l_extendedprice").cast(PRICE).alias("cost"),
        )
    )


def claims_wide_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven diagnosis columns per claim."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    return lines.groupBy(F.col("l_orderkey").alias("claim_id")).agg(
        *[F.max(F.when(F.col("l_linenumber") == i, F.col("p_brand"))).alias(f"diagnosis_{i}_cd") for i in range(1, 8)]
    )


def members_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("person_id"),
        F.when(k % 10 != 0, F.floor(k / 4).cast("bigint")).alias("hh_id"),
        base_day("1930-01-01", (k * 37) % 25000).alias("birth_dt"),
        F.col("c_nationkey").alias("region_cd"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )


def enroll_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    start = F.to_date("o_orderdate")
    return o.select(
        F.col("o_custkey").alias("person_id"),
        (F.col("o_orderkey") % 500).alias("household_id"),
        start.alias("eff_dt"),
        F.date_add(start, 89).alias("end_dt"),
        F.date_sub(start, 10).alias("benefit_eff_dt"),
        plus(start, F.lit(40) + F.col("o_orderkey") % 60).alias("benefit_end_dt"),
    )


def events_v(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.col("event_type") == kind)


def scores_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_v(spark, sf_dir, "signup").select(
        F.col("user_id").alias("person_id"), F.to_date("ts").alias("score_dt"), (F.col("value") / 500).alias("score")
    )


def referrals_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, day = F.col("event_id"), F.to_date("ts")
    return events_v(spark, sf_dir, "purchase").select(
        F.col("user_id").alias("person_id"),
        F.when(F.col("value") >= 110, "maternity").otherwise("other").alias("population"),
        F.when(e % 10 != 0, day).alias("file_date"),
        F.when(e % 4 == 1, "Other Program").otherwise("Maternity High Risk").alias("program_name"),
        F.when(e % 4 != 0, plus(day, e % 5)).alias("assessment_complete_date"),
        F.when(e % 3 == 0, 1).when(e % 3 == 1, 0).alias("engaged"),
    )


def deliveries_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, day = F.col("event_id"), F.to_date("ts")
    code = F.when(e % 5 == 0, "Z37.0").when(e % 5 == 1, "Z37.2").when(e % 5 == 2, "O80").when(e % 5 == 3, "O84")
    return events_v(spark, sf_dir, "error").select(
        F.col("user_id").alias("person_id"),
        day.alias("from_dt"),
        plus(day, e % 3).alias("to_dt"),
        code.otherwise("O75").alias("id_code"),
    )


def bmi_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, v = F.col("event_id"), F.col("value")
    return events_v(spark, sf_dir, "view").select(
        F.col("user_id").alias("cust_id"),
        F.to_date("ts").alias("index_dt"),
        F.when(e % 3 == 0, v).alias("bmi_val"),
        F.when(e % 4 == 1, v).alias("bmi_range_lower"),
        F.when(e % 4 == 2, v).alias("bmi_range_upper"),
        F.when(e % 5 == 0, v).alias("bmi_pct"),
        F.when(e % 6 == 1, F.floor(v / 10).cast("double")).alias("bmi_pct_range_lower"),
        F.when(e % 6 == 1, v + 5).alias("bmi_pct_range_upper"),
        F.when(e % 11 != 0, e % 7 == 0).alias("e66"),
    )


def diagnoses_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per claim line with its person, claim date and code."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return lines.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("cust_id"),
        F.to_date("o_orderdate").alias("event_dt"),
        F.col("p_brand").alias("diag_cd"),
        F.col("o_orderpriority").alias("drg"),
    )


def care_lines_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claim headers with their lines, shaped for the long-term-care rules."""
    part = table(spark, sf_dir, "part")
    lines = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    orders = table(spark, sf_dir, "orders")
    start = F.to_date("o_orderdate")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").alias("person_id"),
        start.alias("claim_service_from_dt"),
        plus(start, F.col("o_orderkey") % 40).alias("claim_service_to_dt"),
        F.col("o_orderpriority").alias("place_of_service_cd"),
        F.concat("l_returnflag", "l_linestatus").alias("claim_ln_place_of_service_cd"),
        F.col("p_type").alias("cpt_cd"),
        F.col("p_type").alias("service_cd"),
        F.when(F.col("l_partkey") % 10 != 0, F.col("p_brand")).alias("procedure_cd"),
        (F.col("l_suppkey") % 50).cast("string").alias("revenue_cd"),
        (F.col("l_suppkey") % 60).cast("string").alias("revenue_cd2"),
    )


# The same views for DuckDB.
SQL_VIEWS = {
    "claims_v": """
        SELECT o_custkey AS person_id, o_orderkey AS claim_id, CAST(o_orderdate AS DATE) AS from_dt,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INT) AS to_dt,
               CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN CAST(o_orderdate AS DATE) END AS admission_dt,
               CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH')
                    THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INT) END AS discharge_dt,
               o_orderstatus AS status, o_orderpriority AS drg,
               CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS paid,
               CAST(o_orderkey % 1000 AS DECIMAL(18,2)) AS patient_paid
        FROM orders""",
    "claim_lines_v": """
        SELECT l_orderkey AS claim_id, l_linenumber AS line_no, l_returnflag || l_linestatus AS place_of_service,
               CASE WHEN l_partkey % 10 <> 0 THEN p_brand END AS proc_cd, p_type AS rev_cd,
               CAST(l_shipdate AS DATE) AS line_dt, CAST(l_extendedprice AS DECIMAL(18,2)) AS cost
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "claims_wide_v": """
        SELECT l_orderkey AS claim_id,
               MAX(CASE WHEN l_linenumber = 1 THEN p_brand END) AS diagnosis_1_cd,
               MAX(CASE WHEN l_linenumber = 2 THEN p_brand END) AS diagnosis_2_cd,
               MAX(CASE WHEN l_linenumber = 3 THEN p_brand END) AS diagnosis_3_cd,
               MAX(CASE WHEN l_linenumber = 4 THEN p_brand END) AS diagnosis_4_cd,
               MAX(CASE WHEN l_linenumber = 5 THEN p_brand END) AS diagnosis_5_cd,
               MAX(CASE WHEN l_linenumber = 6 THEN p_brand END) AS diagnosis_6_cd,
               MAX(CASE WHEN l_linenumber = 7 THEN p_brand END) AS diagnosis_7_cd
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""",
    "members_v": """
        SELECT c_custkey AS person_id, CASE WHEN c_custkey % 10 <> 0 THEN c_custkey // 4 END AS hh_id,
               DATE '1930-01-01' + CAST((c_custkey * 37) % 25000 AS INT) AS birth_dt,
               c_nationkey AS region_cd, c_mktsegment AS segment, c_acctbal AS balance
        FROM customer""",
    "enroll_v": """
        SELECT o_custkey AS person_id, o_orderkey % 500 AS household_id, CAST(o_orderdate AS DATE) AS eff_dt,
               CAST(o_orderdate AS DATE) + 89 AS end_dt, CAST(o_orderdate AS DATE) - 10 AS benefit_eff_dt,
               CAST(o_orderdate AS DATE) + CAST(40 + o_orderkey % 60 AS INT) AS benefit_end_dt
        FROM orders""",
    "scores_v": """
        SELECT user_id AS person_id, CAST(ts AS DATE) AS score_dt, value / 500 AS score
        FROM events WHERE event_type = 'signup'""",
    "referrals_v": """
        SELECT user_id AS person_id, CASE WHEN value >= 110 THEN 'maternity' ELSE 'other' END AS population,
               CASE WHEN event_id % 10 <> 0 THEN CAST(ts AS DATE) END AS file_date,
               CASE WHEN event_id % 4 = 1 THEN 'Other Program' ELSE 'Maternity High Risk' END AS program_name,
               CASE WHEN event_id % 4 <> 0 THEN CAST(ts AS DATE) + CAST(event_id % 5 AS INT) END
                   AS assessment_complete_date,
               CASE WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 3 = 1 THEN 0 END AS engaged
        FROM events WHERE event_type = 'purchase'""",
    "deliveries_v": """
        SELECT user_id AS person_id, CAST(ts AS DATE) AS from_dt,
               CAST(ts AS DATE) + CAST(event_id % 3 AS INT) AS to_dt,
               CASE event_id % 5 WHEN 0 THEN 'Z37.0' WHEN 1 THEN 'Z37.2' WHEN 2 THEN 'O80' WHEN 3 THEN 'O84'
                    ELSE 'O75' END AS id_code
        FROM events WHERE event_type = 'error'""",
    "bmi_v": """
        SELECT user_id AS cust_id, CAST(ts AS DATE) AS index_dt,
               CASE WHEN event_id % 3 = 0 THEN value END AS bmi_val,
               CASE WHEN event_id % 4 = 1 THEN value END AS bmi_range_lower,
               CASE WHEN event_id % 4 = 2 THEN value END AS bmi_range_upper,
               CASE WHEN event_id % 5 = 0 THEN value END AS bmi_pct,
               CASE WHEN event_id % 6 = 1 THEN floor(value / 10) END AS bmi_pct_range_lower,
               CASE WHEN event_id % 6 = 1 THEN value + 5 END AS bmi_pct_range_upper,
               CASE WHEN event_id % 11 <> 0 THEN event_id % 7 = 0 END AS e66
        FROM events WHERE event_type = 'view'""",
    "diagnoses_v": """
        SELECT o_custkey AS cust_id, CAST(o_orderdate AS DATE) AS event_dt, p_brand AS diag_cd, o_orderpriority AS drg
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey""",
    "care_lines_v": """
        SELECT o_custkey AS person_id, CAST(o_orderdate AS DATE) AS claim_service_from_dt,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INT) AS claim_service_to_dt,
               o_orderpriority AS place_of_service_cd, l_returnflag || l_linestatus AS claim_ln_place_of_service_cd,
               p_type AS cpt_cd, p_type AS service_cd, CASE WHEN l_partkey % 10 <> 0 THEN p_brand END AS procedure_cd,
               CAST(l_suppkey % 50 AS VARCHAR) AS revenue_cd, CAST(l_suppkey % 60 AS VARCHAR) AS revenue_cd2
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey""",
}
