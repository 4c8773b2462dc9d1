import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortweave.catalog import QUERIES
from cohortweave.functions.fixed_values import DAY_CARE_PROCEDURES
from cohortweave.operators import care_groups as cg
from cohortweave.operators import labels as la
from cohortweave.operators import timeline as tl
from cohortweave.operators import windows as wi

LINE = (
    "person_id int, claim_service_from_dt date, claim_service_to_dt date, place_of_service_cd string, claim_ln_place_of_service_cd string, "
    "cpt_cd string, service_cd string, procedure_cd string, revenue_cd string, revenue_cd2 string"
)


def iso(text):
    return dt.date.fromisoformat(text)


def line(person, start, end=None, pos="11", ln=None, cpt="x", svc="x", proc="x", rev="x", rev2="x"):
    return (person, iso(start), iso(end or start), pos, ln, cpt, svc, proc, rev, rev2)


def lines(spark, data):
    return spark.createDataFrame(data, LINE)


PERIODS = {"19": ("2019-01-01", "2019-12-31"), "1718": ("2017-01-01", "2018-12-31")}


@pytest.mark.parametrize("null_policy", ["drop", "keep"])
def test_period_flags(small_tasks, null_policy):
    people = small_tasks.createDataFrame([(f"c{i}",) for i in range(1, 8)], "cust_id string")
    crosswalk = small_tasks.createDataFrame([(f"c{i}", i) for i in range(1, 8)] + [("c1", 11), ("c1", 11)], "cust_id string, person_id int")
    claims = lines(small_tasks, [
        line(1, "2019-01-01", pos="32"), line(11, "2018-12-31", ln="31"),
        line(2, "2019-12-31", pos="32", svc=DAY_CARE_PROCEDURES[1]),
        line(3, "2019-05-05", pos="13", proc=None), line(4, "2017-01-01", rev2="023"), line(4, "2019-03-09", cpt="T1019"),
        line(5, "2016-12-31", pos="32"), line(6, "2018-01-01"),
    ])
    rules = cg.care_rules(null_policy=null_policy)
    got = cg.period_flags(people, crosswalk, claims, rules, PERIODS, first_months={"first_home": rules["hltc"]})
    table = {r.cust_id: {k for k, v in r.asDict().items() if v == 1} for r in got.collect()}
    assert table["c1"] == {"utiliz_19", "utiliz_1718", "iltc_19", "snf_1718"}
    assert table["c2"] == {"utiliz_19", "cltc_19"}
    assert table["c3"] == ({"utiliz_19"} if null_policy == "drop" else {"utiliz_19", "iltc_19"})
    assert table["c4"] == {"utiliz_19", "utiliz_1718", "hltc_19", "hltc_1718"}
    assert table["c5"] == set() and table["c7"] == set() and table["c6"] == {"utiliz_1718"}
    homes = {r.cust_id: r.first_home for r in got.collect() if r.first_home}
    assert homes == {"c4": dt.date(2017, 1, 1)}


def test_member_months_endpoints_and_all(spark, rows):
    claims = lines(spark, [
        line(1, "2018-11-20", "2019-02-03", pos="31"), line(1, "2019-02-10", ln="32"), line(2, "2019-12-05", "2020-04-01", pos="33"),
        line(3, "2016-12-31", "2017-02-01", pos="31"), line(4, "2019-01-01", pos="11"),
    ])
    assert rows(cg.member_months(claims)) == [(1, 2018, 11, 1, 0), (1, 2019, 2, 1, 1), (2, 2019, 12, 0, 1)]
    every = rows(cg.member_months(claims, endpoints_only=False), "person_id", "yr", "mo")
    assert every == [(1, 2018, 11), (1, 2018, 12), (1, 2019, 1), (1, 2019, 2), (2, 2019, 12), (2, 2020, 1), (2, 2020, 2), (2, 2020, 3)]


def months(spark, data):
    """Month numbers from January 2017 (1), each 's', 'n' or 'b' for skilled nursing, nursing home, both."""
    out = [(p, 2017 + (m - 1) // 12, (m - 1) % 12 + 1, int(k in "sb"), int(k in "nb")) for p, text in data.items() for m, k in text]
    return spark.createDataFrame(out, "person_id int, yr int, mo int, snf int, nh int")


STAYS = {
    1: [(3, "s"), (4, "s"), (5, "n"), (6, "n"), (7, "n"), (8, "n")],  # leading skilled nursing goes
    2: [(1, "n"), (2, "s"), (3, "n"), (4, "s")],  # later skilled nursing counts
    3: [(1, "b"), (2, "n"), (3, "n"), (4, "n")],  # both at once counts as leading
    4: [(m, "s") for m in range(1, 9)],
    5: [(1, "n"), (2, "n"), (3, "n"), (5, "n")],  # broken by a month
    6: [(11, "n"), (12, "n"), (13, "n"), (14, "n")],  # over the year's end
    7: [(1, "n"), (2, "n"), (3, "n"), (4, "n"), (25, "n"), (26, "n"), (27, "n"), (28, "n")],
}


def test_long_stays(spark, rows):
    got = cg.long_stays(months(spark, STAYS))
    assert rows(got) == [(1, 2017, dt.date(2017, 5, 1)), (2, 2017, dt.date(2017, 1, 1)), (6, 2017, dt.date(2017, 11, 1)), (7, 2017, dt.date(2017, 1, 1))]


def test_stay_flags_by_person_and_per_stay(spark, rows):
    stays, periods = months(spark, STAYS), {"19": [2019], "1718": [2017, 2018]}
    by_person = {r[0]: r[1:] for r in rows(cg.long_stay_flags(cg.long_stays(stays), periods))}
    per_stay = {r[0]: r[1:] for r in rows(cg.long_stay_flags(cg.long_stays(stays, per_stay=True), periods))}
    assert by_person[7] == (0, 1) and per_stay[7] == (1, 1)


def test_first_months_and_crosswalk(spark, rows):
    mm = months(spark, {1: [(1, "s"), (2, "n"), (3, "n"), (4, "n"), (5, "n")], 2: [(6, "n")], 3: [(7, "s")]})
    got = cg.first_institution_month(mm, cg.long_stays(mm))
    assert rows(got) == [(1, dt.date(2017, 2, 1), dt.date(2017, 2, 1)), (2, dt.date(2017, 6, 1), None)]
    pairs = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "cust_id string, person_id int")
    assert ("a", 2017, 7, 1, 0) in rows(cg.months_by_cust(mm, pairs))
    home = lines(spark, [line(1, "2018-03-17", cpt="T1019"), line(1, "2018-02-28", rev="023"), line(2, "2020-01-01", cpt="T1019")])
    assert rows(cg.first_homecare_month(home, cg.care_rules()["hltc"], "2017-01-01", "2019-12-31")) == [(1, dt.date(2018, 2, 1))]


def test_events_by_text(spark, rows):
    df = spark.createDataFrame(
        [("a", "DEATH of member", iso("2019-05-05")), ("a", "Deceased", iso("2019-04-04")), ("b", "death", iso("2018-12-31")), ("c", None, iso("2019-01-01"))],
        "cust_id string, reason string, event_dt date",
    )
    assert rows(cg.events_by_text(df, 2019)) == [("a", iso("2019-04-04"))]


def grouped(spark):
    names = "cust_id string, iltc_4m_19 int, iltc_19 int, hltc_19 int, min_iltc4_month date, min_iltc_month date, min_hltc_month date, death_dt date"
    d = iso
    return spark.createDataFrame([
        ("long", 1, 1, 1, d("2019-02-01"), d("2019-01-01"), d("2019-03-01"), None),
        ("short", 1, 1, 0, d("2018-02-01"), d("2019-04-01"), None, None),
        ("home", 0, 1, 1, None, d("2018-04-01"), d("2019-06-01"), d("2019-01-15")),
        ("death", 0, 0, 0, None, None, None, d("2019-11-01")),
        ("none", 0, 0, 0, None, None, None, None), ("none2", 0, 0, 0, None, None, None, d("2018-11-01")),
    ], names)


def test_index_date_branches_and_stable_random_month(spark):
    first = {r.cust_id: r.index_dt for r in cg.index_date(grouped(spark)).collect()}
    again = {r.cust_id: r.index_dt for r in cg.index_date(grouped(spark).repartition(7)).collect()}
    assert first == again
    assert [first[k] for k in ("long", "short", "home", "death")] == [iso("2019-02-28"), iso("2019-04-30"), iso("2019-06-30"), iso("2019-11-30")]
    assert {first["none"].year, first["none2"].year} == {2019}
    assert cg.index_date(grouped(spark), seed=1).where("cust_id like 'none%'").count() == 2


def test_categories(spark):
    flags = ["months_enrolled", "utiliz_19", "iltc_4m_19", "iltc_4m_1718", "iltc_19", "iltc_1718", "hltc_19", "hltc_1718"]
    cases = [
        ((19, 1, 1, 0, 1, 0, 0, 0), "Not in study"), ((24, 0, 1, 0, 1, 0, 0, 0), "Not in study"), ((None, 0, 0, 0, 0, 0, 0, 0), "Not in study"),
        ((20, 1, 1, 0, 1, 1, 1, 1), "ILTC long 2019, start 2019"), ((20, 1, 1, 1, 1, 1, 0, 0), "ILTC long 2019, start 17-18"),
        ((20, 1, 0, 0, 1, 0, 1, 1), "ILTC short 2019, start 2019"), ((20, 1, 0, 1, 1, 1, 0, 0), "ILTC short 2019, start 17-18"),
        ((20, 1, 0, 0, 0, 1, 1, 0), "HLTC 2019, start 2019"), ((20, 1, 0, 0, 0, 0, 1, 1), "HLTC 2019, start 17-18"),
        ((20, 1, 0, 0, 0, 0, 0, 0), "No LTC 2019, nor 17-18"), ((20, 1, 0, 0, 0, 1, 0, 0), "No LTC 2019, but LTC in 17-18"),
        ((None, 1, 0, 0, 0, 0, 0, 1), "No LTC 2019, but LTC in 17-18"),
    ]
    df = spark.createDataFrame([(*v, want) for v, want in cases], ", ".join(f"{f} int" for f in flags) + ", want string")
    assert cg.ltc_category(df).where("not (ltc_cat <=> want)").count() == 0


# ---- weight status

FLAGS = [*la.WEIGHT_FLAGS, *[f"prior_{f}" for f in la.WEIGHT_FLAGS]]
RULES = [
    ({"obese_e66", "obese_bmi"}, 1), ({"obese_e66", "prior_obese_bmi"}, 1), ({"obese_bmi", "prior_obese_e66"}, 1),
    ({"ovrwgt_e66", "ovrwgt_bmi"}, 1), ({"ovrwgt_e66", "prior_ovrwgt_bmi"}, 1), ({"ovrwgt_bmi", "prior_ovrwgt_e66"}, 1),
    ({"normwgt_bmi"}, 0), ({"undrwgt_bmi"}, 0), ({"obese_e66", "ovrwgt_bmi"}, 1), ({"ovrwgt_e66", "obese_bmi"}, 1),
    ({"obese_e66"}, None), ({"normwgt_bmi", "prior_obese_bmi"}, None), ({"normwgt_bmi", "prior_normwgt_bmi"}, 0),
]


def test_weight_rules_and_age(spark, rows):
    day = iso("2022-06-01")
    current = [(i, day, *[int(f in on) for f in la.WEIGHT_FLAGS]) for i, (on, _) in enumerate(RULES)]
    prior = [(i, *[int(f"prior_{f}" in on) for f in la.WEIGHT_FLAGS]) for i, (on, _) in enumerate(RULES) if any(f.startswith("prior") for f in on)]
    current += [(90, day, 1, 0, 1, 0, 0, 0), (91, day, 1, 0, 1, 0, 0, 0)]
    names = ", ".join(f"{f} int" for f in la.WEIGHT_FLAGS)
    cur = spark.createDataFrame(current, "cust_id int, index_dt date, " + names)
    pri = spark.createDataFrame(prior, "cust_id int, " + ", ".join(f"prior_{f} int" for f in la.WEIGHT_FLAGS))
    births = [(i, iso("1980-01-01")) for i in range(len(RULES))] + [(90, iso("2020-06-01")), (91, iso("2020-06-02"))]
    persons = spark.createDataFrame(births, "cust_id int, birth_dt date")
    got = dict(rows(la.weight_label(cur, pri, persons), "cust_id", "obese"))
    # 730 days are under two years of 365.25 days
    assert got == {i: want for i, (_, want) in enumerate(RULES) if want is not None}


def test_bmi_label(spark):
    cases = [
        ((25.0, None, None, None, None, None, None), 1), ((24.9, 30.0, None, None, None, None, None), 0),
        ((None, 25.0, None, None, None, None, None), 1), ((None, 20.0, 24.9, None, None, None, None), 0), ((None, 20.0, 26.0, None, None, None, True), None),
        ((None, None, None, 85.0, None, None, None), 1), ((None, None, None, None, 5.0, 84.0, None), 0), ((None, None, None, None, 6.0, 84.0, None), None),
        ((26.0, None, None, 90.0, None, None, None), 1), ((26.0, None, None, 50.0, None, None, None), None), ((26.0, None, None, 50.0, None, None, True), 1),
        ((None, None, None, None, None, None, True), 1), ((None, None, None, None, None, None, False), None),
    ]
    schema = "bmi_val double, bmi_range_lower double, bmi_range_upper double, bmi_pct double, bmi_pct_range_lower double, bmi_pct_range_upper double, e66 boolean, want int"
    df = spark.createDataFrame([(*v, w) for v, w in cases], schema)
    assert [(tuple(r)) for r in la.bmi_label(df).where("not (obese <=> want)").collect()] == []


def test_unambiguous_latest(spark, rows):
    d = iso
    records = [
        ("a", d("2022-01-02"), 1), ("a", d("2022-01-02"), 1), ("a", d("2021-01-02"), 0), ("b", d("2022-01-02"), 1), ("b", d("2022-01-02"), 0),
        ("c", d("2022-01-02"), 1), ("d", d("2030-01-01"), 1), ("e", d("2022-03-01"), None), ("e", d("2022-02-01"), 0),
    ]
    df = spark.createDataFrame(records, "cust_id string, index_dt date, obese int")
    main = spark.createDataFrame([("c", d("2021-05-05"), 0)], "cust_id string, index_dt date, obese int")
    assert rows(la.unambiguous_latest(df, main, "2020-11-01", "2022-11-01")) == [("a", d("2022-01-02"), 1), ("c", d("2021-05-05"), 0), ("e", d("2022-02-01"), 0)]


def test_lookback_bounds_and_fused_form(small_tasks, rows):
    fam = {"x": (["A"], None), "y": (["B"], None)}
    d = dt.date(2022, 6, 1)
    events = [(1, d, "A"), (1, d - dt.timedelta(1), "B"), (2, d, "B"), (2, d - dt.timedelta(365), "A"), (3, d, "A"), (3, d - dt.timedelta(366), "B"), (4, d + dt.timedelta(400), "A")]
    ev = small_tasks.createDataFrame(events, "cust_id int, event_dt date, diag_cd string")
    index = small_tasks.createDataFrame([(p, d) for p in (1, 2, 3)], "cust_id int, index_dt date")
    assert rows(wi.lookback_flags(index, ev, fam)) == [(1, 0, 1), (2, 1, 0)]
    daily = ev.groupBy("cust_id", "event_dt").agg(*[F.max(F.col("diag_cd").isin(c).cast("int")).alias(n) for n, (c, _) in fam.items()])
    fused = wi.current_and_prior_flags(daily, ["x", "y"], "2022-01-01", "2022-12-31")
    assert rows(fused, "cust_id", "index_dt", "x", "y", "prior_x", "prior_y") == [(1, d, 1, 0, 0, 1), (2, d, 0, 1, 1, 0), (3, d, 1, 0, 0, 0)]


def test_pregnancy_days(spark, rows):
    d = iso("2022-01-01")
    ev = spark.createDataFrame([("a", d, "P"), ("b", d, "P"), ("b", d, "X"), ("c", d, "D"), ("c", d, "X"), ("c", d, "P")], "cust_id string, event_dt date, diag_cd string")
    assert rows(wi.pregnancy_days(ev, ["P"], ["X"], ["D"])) == [("a", d, "p"), ("c", d, "d")]


def test_exclusion_windows_month_ends_and_contained_pregnancies(spark, rows):
    d = iso
    days = [("a", d("2021-11-30"), "p"), ("b", d("2021-05-31"), "d"), ("b", d("2021-11-30"), "p"), ("b", d("2021-12-01"), "p"), ("b", d("2020-08-31"), "p"), ("b", d("2020-08-30"), "p")]
    df = spark.createDataFrame(days, "cust_id string, event_dt date, assignment string")
    drg = spark.createDataFrame([("c", d("2021-03-31")), ("b", d("2021-05-31"))], "cust_id string, event_dt date")
    assert rows(wi.exclusion_windows(df, drg)) == [
        ("a", d("2021-02-28"), d("2022-11-30")),
        ("b", d("2019-11-30"), d("2021-08-30")),
        ("b", d("2020-08-31"), d("2021-11-30")),
        ("b", d("2021-03-01"), d("2022-12-01")),
        ("c", d("2020-06-30"), d("2021-09-30")),
    ]


def test_exclusion_windows_equal_pairwise_comparison(spark, rows):
    rng = random.Random(3)
    start = iso("2019-01-29")
    data = sorted({(rng.randint(1, 4), start + dt.timedelta(rng.randint(0, 1500))) for _ in range(120)})
    marked = [(p, day, rng.choice("ppppd")) for p, day in data]
    df = spark.createDataFrame(marked, "cust_id int, event_dt date, assignment string")
    got = rows(wi.exclusion_windows(df, df.where("false").select("cust_id", "event_dt")))
    df.createOrReplaceTempView("days")
    want = spark.sql("""
        SELECT cust_id, add_months(event_dt, -9), add_months(event_dt, 6) FROM days WHERE assignment = 'd'
        UNION ALL SELECT cust_id, add_months(event_dt, -9), add_months(event_dt, 12) FROM days p WHERE assignment = 'p' AND NOT EXISTS (
            SELECT 1 FROM days d WHERE d.cust_id = p.cust_id AND d.assignment = 'd'
            AND p.event_dt BETWEEN add_months(d.event_dt, -9) AND add_months(d.event_dt, 6))""")
    assert got == rows(want)


def test_exclude_in_windows_includes_both_ends(spark, rows):
    d = iso
    labels = spark.createDataFrame([("a", d("2021-01-01")), ("a", d("2021-02-01")), ("a", d("2021-02-02")), ("b", d("2021-01-15"))], "cust_id string, index_dt date")
    wins = spark.createDataFrame([("a", d("2021-01-01"), d("2021-02-01")), ("a", d("2021-01-01"), d("2021-02-01"))], "cust_id string, exclude_start date, exclude_end date")
    assert rows(wi.exclude_in_windows(labels, wins)) == [("a", d("2021-02-02")), ("b", d("2021-01-15"))]


def months_of(bits):
    return [i for i in range(64) if bits >> i & 1]


def test_month_bitmaps_agree_with_months_and_stays(spark):
    """Random claims: months, first months and long stays of the timelines against the row-wise operators."""
    rng = random.Random(12)
    claims = []
    for p in range(150):
        for _ in range(rng.randrange(1, 14)):
            a = dt.date(2017, 1, 1) + dt.timedelta(rng.randrange(1_000))
            b = rng.choice([a + dt.timedelta(rng.randrange(120)), None, a])
            claims.append((p, a, b, rng.random() < 0.45, rng.random() < 0.45))
    df = spark.createDataFrame(claims, "person_id int, a date, b date, snf boolean, nh boolean")
    first, count = dt.date(2017, 1, 1), 39
    for endpoints_only in (True, False):
        months = cg.member_months(df, start="a", end="b", snf=F.col("snf"), nh=F.col("nh"), endpoints_only=endpoints_only)
        timelines = tl.care_timeline(df, {"any": F.lit(True)}, {"s": F.col("snf"), "n": F.col("nh")}, first, count, start="a", end="b", endpoints_only=endpoints_only)
        told = {}
        for r in months.collect():
            for kind in ("snf", "nh"):
                if r[kind]:
                    told.setdefault((r.person_id, kind), set()).add((r.yr - 2017) * 12 + r.mo - 1)
        for r in timelines.collect():
            assert set(months_of(r.s)) == told.get((r.person_id, "snf"), set()) and set(months_of(r.n)) == told.get((r.person_id, "nh"), set())
        for least in (1, 2, 4):
            starts = tl.long_stay_starts(F.col("s"), F.col("n"), least)
            got = {(r.person_id, i) for r in timelines.select("person_id", starts.alias("x")).collect() for i in months_of(r.x)}
            stays = cg.long_stays(months, least, per_stay=True).collect()
            assert got == {(r.person_id, (r.yr_start - 2017) * 12 + r.min_iltc4_month.month - 1) for r in stays}
            earliest = timelines.select("person_id", tl.first_month(starts, first).alias("m")).where("m IS NOT NULL")
            assert {tuple(r) for r in earliest.collect()} == {(r.person_id, r.min_iltc4_month) for r in cg.long_stays(months, least).collect()}


def test_periods_are_masks_of_whole_months(spark):
    first = dt.date(2017, 1, 1)
    assert months_of(tl.mask(("2017-03-01", "2017-05-31"), first, 39)) == [2, 3, 4]
    assert months_of(tl.mask(("2016-11-01", "2017-01-31"), first, 39)) == [0] and tl.mask(("2030-01-01", "2030-12-31"), first, 39) == 0
    with pytest.raises(ValueError, match="begin and end with a month"):
        tl.mask(("2017-03-02", "2017-05-31"), first, 39)
    with pytest.raises(ValueError):
        tl.care_timeline(spark.range(1), {}, {}, first, 61)
    row = spark.sql("SELECT 6L AS b, 0L AS z, CAST(NULL AS BIGINT) AS n").select(
        *[tl.any_in(F.col(c), 2).alias(f"any_{c}") for c in "bzn"], *[tl.first_month(F.col(c), first).alias(f"first_{c}") for c in "bzn"]
    )
    assert tuple(row.first()) == (1, 0, 0, dt.date(2017, 2, 1), None, None)


def test_care_plan_reads_the_claims_once(spark):
    plan = QUERIES["long_term_care_groups"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bit_or(") > 0 and plan.count("Window") == 0
    # one scan of the lines, one of the claim status that stands beside them, one of the disenrolments
    assert plan.count("Relation [l_") <= 1 and plan.count("Relation [o_") <= 3
