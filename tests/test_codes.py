import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortweave.catalog import QUERIES, sources
from cohortweave.catalog.views import claims_wide_v
from cohortweave.functions.rules import label_rules, sum_where
from cohortweave.operators import claims as cl
from cohortweave.operators import codes as co
from cohortweave.plans import maternity
from cohortweave.session import written

D = dt.date(2022, 1, 1)


@pytest.fixture(scope="module")
def wide(spark):
    return spark.createDataFrame(
        [(1, "Z37.0", None, "A"), (2, None, None, None), (3, "B", "C", "O80.1"), (4, "O8", "X", "Y")],
        "id int, prdiagcd string, diag2 string, diagn3 string",
    )


def test_melt_renames_strips_and_keeps_null(wide, rows):
    got = co.melt_codes(
        wide, ["id"], r"^diag\d+$", rename={"prdiagcd": "diag1", "diagn3": "diag3"}, strip_prefix="diag"
    )
    assert got.count() == 12
    assert (1, "2", None) in rows(got) and (3, "3", "O80.1") in rows(got)


@pytest.mark.parametrize("as_table", [False, True])
def test_match_any_column_by_prefix(spark, wide, rows, as_table):
    codes = ["O80", "Z37"]
    listed = spark.createDataFrame([(c,) for c in [*codes, "O80", None]], "code string") if as_table else codes
    got = co.match_codes(wide, ["prdiagcd", "diag2", "diagn3"], listed, match_len=3)
    assert [r[0] for r in rows(got)] == [1, 3]
    assert got.columns == wide.columns
    assert [r[0] for r in rows(co.match_codes(wide, "diagn3", listed, match_len=3))] == [3]


def test_match_by_each_codes_own_length(spark, wide, rows):
    listed = spark.createDataFrame(
        [("O80", 3), ("Z37.0", 5), ("X", 4), ("B", None), ("YY", 1), (None, 3)], "code string, match_len int"
    )
    got = co.match_codes(wide, ["prdiagcd", "diag2", "diagn3"], listed, co.PER_CODE)
    assert [r[0] for r in rows(got)] == [1, 3, 4]
    assert got.columns == wide.columns
    assert [r[0] for r in rows(co.match_codes(wide, "diag2", listed, co.PER_CODE))] == [4]
    assert rows(co.match_codes(wide, "prdiagcd", listed.limit(0), co.PER_CODE)) == []
    with pytest.raises(ValueError):
        co.match_codes(wide, "diag2", ["O80"], co.PER_CODE)


@pytest.mark.parametrize("match_len", [None, 3, co.PER_CODE])
def test_long_lists_are_joined_and_give_the_same(spark, wide, rows, monkeypatch, match_len):
    listed = spark.createDataFrame([("O80", 3), ("Z37.0", 5), ("B", None), ("YY", 1), (None, 3)], "code string, match_len int")
    columns = ["prdiagcd", "diag2", "diagn3"]
    as_filter = co.match_codes(wide, columns, listed, match_len)
    assert " Join" not in as_filter._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(co, "DICTIONARY", 1)
    joined = co.match_codes(wide, columns, listed, match_len)
    assert "Join" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert rows(joined) == rows(as_filter)


def test_listed_codes_do_not_move_the_claims(spark):
    """A list as a table, seven code columns, no broadcasting: only the claims' own steps shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        claims = claims_wide_v(spark, "/root/testdata/sf0.001")
        own = claims._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        plan = QUERIES["matched_code_lengths"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == own
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tiers_from_one_pass_equal_tiers_one_by_one(small_tasks, rows):
    rng = random.Random(6)
    codes = ["Z37.0", "O80", "O61.1", "540", "541x", "0720", "99", None]
    header = [(rng.randrange(30) or None, D, D, *(rng.choice(codes) for _ in range(4))) for _ in range(200)] + [(40, D, D, "O61.1", "B", None, None)]
    lines = [(rng.randrange(45), D, D, rng.choice(codes), rng.choice(codes)) for _ in range(200)]
    header = small_tasks.createDataFrame(header, "person_id int, from_dt date, to_dt date, d1 string, d2 string, drg string, sub string")
    lines = small_tasks.createDataFrame(lines, "person_id int, from_dt date, to_dt date, rev string, cpt string")

    def listed(codes, length):
        return small_tasks.createDataFrame([(c, length) for c in codes], "code string, match_len int")

    order = ["first", "drg", "second", "revenue", "cpt"]
    one_pass = co.identify_by_tiers(
        [
            co.TierTable(
                header,
                (
                    co.TierRule("first", ("d1", "d2"), listed(["Z37"], 3)),
                    co.TierRule("drg", ("drg", "sub"), listed(["540", "541"], 3), "first"),
                    co.TierRule("second", ("d1", "d2"), listed(["O61"], 3)),
                ),
            ),
            co.TierTable(lines, (co.TierRule("revenue", ("rev",), listed(["0720"], None)), co.TierRule("cpt", ("cpt",), listed(["99"], None)))),
        ],
        order,
    )
    one_by_one = co.tiered_identify(
        [
            co.code_tier(header, "first", ["d1", "d2"], ["Z37"], match_len=3),
            co.code_tier(header, "drg", ["drg", "sub"], ["540", "541"], match_len=3, report="first"),
            co.code_tier(header, "second", ["d1", "d2"], ["O61"], match_len=3),
            co.code_tier(lines, "revenue", "rev", ["0720"]),
            co.code_tier(lines, "cpt", "cpt", ["99"]),
        ]
    )
    assert rows(one_pass) == rows(one_by_one) and {r.id_method for r in one_pass.collect()} == set(order)


def test_deliveries_by_five_code_systems(small_tasks, rows):
    """One person per system, one that an earlier system names, one that none does."""
    ref = small_tasks.createDataFrame(
        [("ICD-10-CM", "O9902", "Anemia complicating childbirth"), ("ICD-10-CM", "Z331", "Pregnant"), ("CPT", "59400", "Vaginal Delivery"), ("CPT", "1", "x")],
        "type string, code string, definition string",
    )
    rooms = small_tasks.createDataFrame([("UBREV", "0720", "room"), ("CPT", "2", "x")], "type string, code string, definition string")
    when = "date, claim_service_to_dt date"
    headers = small_tasks.createDataFrame(
        [(1, D, D, "Z37.0", "O99.02", None, None), (2, D, D, None, None, "111", "540"), (3, D, D, "X", "O99.021", None, None), (4, D, D, "O77", None, None, None), (7, D, D, "Z331", None, "5", None)],
        f"person_id int, claim_service_from_dt {when}, d1 string, d2 string, diagnosis_related_group_cd string, claim_header_sub_drg_cd string",
    )
    lines = small_tasks.createDataFrame([(5, D, D, "0720"), (1, D, D, "0720"), (7, D, D, "07201")], "person_id int, claim_line_service_start_dt date, claim_line_service_end_dt date, revenue_cd string")
    services = small_tasks.createDataFrame([(6, D, D, "59400"), (5, D, D, "59400"), (7, D, D, "594001")], "person_id int, claim_ln_service_from_dt date, claim_ln_service_to_dt date, service_cd string")
    lists = maternity.delivery_lists(small_tasks, ref, rooms)
    assert set(lists) == set(maternity.DELIVERY_TIERS)
    got = maternity.delivery_finds(headers, lines, services, lists, diagnoses=["d1", "d2"])
    assert rows(got, "person_id", "id_method", "id_code") == [
        (1, "icd10_1st", "Z37.0"), (2, "drg", "111"), (3, "icd10_2nd", "O99.021"), (4, "icd10_2nd", "O77"), (5, "revenue", "0720"), (6, "cpt", "59400"),
    ]


def test_each_claims_table_is_read_once_for_all_tiers(spark, monkeypatch):
    """Scans of base tables in every table written on the way to the finds."""
    plans = []
    for module in (co, sources):
        monkeypatch.setattr(module, "written", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or written(df, name))
    QUERIES["tiered_identify"](spark, "/root/testdata/sf0.001")
    assert sum(p.count("l_shipdate#") > 0 for p in plans) == 1 and sum(p.count("o_orderpriority#") > 0 for p in plans) == 1
    base, finds = plans
    assert base.count("Relation") == 3  # orders, line items, parts
    assert finds.count("Relation") == 2  # the written lines, as headers and as lines


def test_exclude_codes_null_policies(spark, rows):
    df = spark.createDataFrame([(1, None, None), (2, None, "S5100"), (3, "A", "B"), (4, "A", None)], "id int, a string, b string")
    assert [r[0] for r in rows(co.exclude_codes(df, ["a", "b"], ["S5100"]))] == [3]
    assert [r[0] for r in rows(co.exclude_codes(df, ["a", "b"], ["S5100"], "keep"))] == [1, 3, 4]
    with pytest.raises(ValueError):
        co.exclude_codes(df, "a", ["x"], "maybe")


def tier(spark, method, data):
    return spark.createDataFrame(
        [(p, D, D, method, c) for p, c in data], "person_id int, from_dt date, to_dt date, id_method string, id_code string"
    )


def test_tiers_exclude_people_found_earlier(small_tasks, rows):
    first = tier(small_tasks, "icd", [(1, "Z37"), (1, "O80"), (2, "Z38")])
    second = tier(small_tasks, "drg", [(2, "768"), (3, "540")])
    third = tier(small_tasks, "rev", [(1, "0720"), (3, "0720"), (4, "0721")])
    got = co.tiered_identify([first, second, third])
    assert rows(got, "person_id", "id_method", "id_code") == [
        (1, "icd", "O80"), (1, "icd", "Z37"), (2, "icd", "Z38"), (3, "drg", "540"), (4, "rev", "0721"),
    ]
    assert got.where("from_dt is null").count() == 0
    assert rows(co.method_counts(got)) == [("drg", 1), ("icd", 3), ("rev", 1)]


def test_drg_tier_reports_the_main_code_even_if_only_the_other_matched(spark, rows):
    df = spark.createDataFrame(
        [(1, D, D, "111", "540"), (2, D, D, None, "541"), (3, D, D, "999", "888")],
        "person_id int, from_dt date, to_dt date, drg string, sub string",
    )
    got = co.code_tier(df, "drg", ["drg", "sub"], ["540", "541"], match_len=3, report="first")
    assert rows(got, "person_id", "id_code") == [(1, "111"), (2, "541")]


def test_tier_over_several_columns_lists_each_matching_code(spark, rows):
    df = spark.createDataFrame([(1, D, D, "Z37.0", "O80"), (1, D, D, "Z37.0", "X")], "person_id int, from_dt date, to_dt date, a string, b string")
    got = co.code_tier(df, "icd", ["a", "b"], ["Z37", "O80"], match_len=3)
    assert rows(got, "person_id", "id_code") == [(1, "O80"), (1, "Z37.0")]


def test_code_flags_and_keep_listed(small_tasks, rows):
    df = small_tasks.createDataFrame([(1, "O81"), (1, None), (2, "Z37.0"), (3, None)], "p int, c string")
    got = co.code_flags(df, "c", {"o": (["O81"], 3), "z": (["Z37.0"], 5)}, ["p"])
    assert rows(got) == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]
    listed = small_tasks.createDataFrame([(1,), (1,), (9,)], "p int")
    assert rows(co.keep_listed(df, listed, "p")) == [(1, "O81"), (1, None)]


def test_label_rules_skip_null_conditions(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 1)], "id int, x int")
    got = label_rules(df, "l", [(F.col("x") > 3, "big"), (F.col("x").isNull(), "none")], "small")
    assert rows(got, "id", "l") == [(1, "none"), (2, "big"), (3, "small")]


def test_sum_policies(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (0, None)], "m int, x double")
    keep = df.agg(sum_where("x", F.col("m") == 1).alias("a"), sum_where("x", F.col("m") == 1, "skip").alias("b"),
                  sum_where("x", F.col("m") == 7).alias("c")).first()
    assert (keep.a, keep.b, keep.c) == (None, 2.0, None)


def test_claim_lines_keep_headers_without_lines(spark, rows):
    header = spark.createDataFrame([(1, "11", D), (2, "31", D), (3, "31", dt.date(2016, 1, 1))], "claim_header_pk long, place_of_service_cd string, claim_service_from_dt date")
    detail = spark.createDataFrame([(1, "32", 7, 70), (1, "33", None, None)], "claim_header_fk long, place_of_service_cd string, medical_procedure_cd_fk long, medical_revenue_cd_fk long")
    proc = spark.createDataFrame([(7, "CP", "99301"), (7, "XX", "nope")], "medical_procedure_cd_pk long, procedural_coding_system_cd string, procedure_cd string")
    rev = spark.createDataFrame([(70, "023")], "medical_revenue_cd_pk long, revenue_cd string")
    got = cl.claim_lines(header, detail, proc, rev, first="2017-01-01", last="2022-12-31")
    assert rows(got, "claim_header_pk", "claim_ln_place_of_service_cd", "procedure_cd", "revenue_cd2") == [
        (1, "32", "99301", "023"), (1, "33", None, None), (2, None, None, None),
    ]


def test_crosswalk_claims(small_tasks, rows):
    membership = small_tasks.createDataFrame([("m1", "c1"), ("m1", "c1"), ("m2", "c1"), ("m3", "c3")], "member_id string, cust_id string")
    claims = small_tasks.createDataFrame(
        [("m1", "PA", "F", 30), ("m2", "AP", "F", 51), ("m2", "DE", "M", 20), ("m3", "PA", "F", 8), (None, "PA", "F", 8)],
        "member_id string, clmstat string, sexcod string, ageyears int",
    )
    eligible = small_tasks.createDataFrame([("c1",)], "cust_id string")
    paid = cl.person_crosswalk_claims(membership, claims, eligible, status=["PA", "AP"])
    assert rows(paid, "cust_id", "member_id") == [("c1", "m1"), ("c1", "m2")]
    women = cl.person_crosswalk_claims(membership, claims, sex="F", ages=(8, 50))
    assert rows(women, "cust_id", "member_id") == [("c1", "m1"), ("c3", "m3")]
