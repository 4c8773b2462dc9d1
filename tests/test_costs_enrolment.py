import datetime as dt
from decimal import Decimal

import pytest

from cohortweave.operators import costs
from cohortweave.operators import enrolment as en

D = dt.date(2022, 6, 15)


def on(n):
    return D + dt.timedelta(days=n)


def inputs(spark):
    anchors = spark.createDataFrame([(1, D), (2, D), (3, None), (4, D)], "mother_id int, delivery_dt date")
    links = spark.createDataFrame([(1, 101), (1, 102), (2, None)], "mother_id int, infant_id int")
    data = [
        (1, 0, 3, 0, 3, 100, 1), (1, -3, 0, -3, 0, 200, 2), (1, 1, 4, 1, 4, 50, 5), (1, None, None, -1, 1, 7, None),
        (101, 0, 2, 0, 2, 10, 1), (101, 7, 9, 7, 9, 20, 1), (102, 8, 9, 8, 9, 40, 1), (102, -300, -290, -300, -290, 80, 1), (3, 0, 1, 0, 1, 9, 9),
    ]
    d = lambda n: None if n is None else on(n)
    claims = spark.createDataFrame(
        [(p, d(a), d(b), d(c), d(e), Decimal(x), None if y is None else Decimal(y)) for p, a, b, c, e, x, y in data],
        "person_id int, admission_dt date, discharge_dt date, from_dt date, to_dt date, paid decimal(18,2), patient_paid decimal(18,2)",
    )
    return anchors, links, claims


def test_outcomes_of_one_mother(small_tasks):
    anchors, links, claims = inputs(small_tasks)
    table = {r.mother_id: r for r in costs.assemble_outcomes(anchors, claims, links).collect()}
    assert sorted(table) == [1, 2, 3, 4]
    one = table[1]
    assert (one.m_admit_disch_cost, one.m_admit_disch_patient_cost) == (300, 3)
    assert one.m_admit_minus1_cost == 350
    assert (one.m_span_deliv_cost, one.m_span_deliv_patient_cost) == (307, None)
    assert one.m_deliv_minus1_cost == 357
    assert one.b_admit_disch_cost == 10 and one.b_span_birth_cost == 10
    assert one.b_admit_plus7_cost == 110 and one.b_birth_plus7_cost == 110
    assert all(v is None for m in (2, 3, 4) for k, v in table[m].asDict().items() if k != "mother_id")


def test_null_cost_policies_and_lower_bound(small_tasks):
    anchors, links, claims = inputs(small_tasks)
    skip = costs.assemble_outcomes(anchors, claims, links, null_policy="skip").where("mother_id = 1").first()
    assert skip.m_span_deliv_patient_cost == 3
    bounded = costs.assemble_outcomes(anchors, claims, links, costs.delivery_outcomes(lower_days=7)).where("mother_id = 1").first()
    assert bounded.b_admit_plus7_cost == 30


def test_single_outcomes_equal_the_assembled_table(small_tasks):
    anchors, links, claims = inputs(small_tasks)
    together = {r.mother_id: r.asDict() for r in costs.assemble_outcomes(anchors, claims, links).collect()}
    for outcome in costs.delivery_outcomes():
        alone = {r.mother_id: r.asDict() for r in costs.interval_cost(anchors, claims, outcome, links).collect()}
        for mother, row in together.items():
            for name in (outcome.paid_name, outcome.patient_name):
                assert row[name] == alone.get(mother, {}).get(name)


def test_infant_outcome_needs_links(spark):
    anchors, _, claims = inputs(spark)
    with pytest.raises(ValueError):
        costs.interval_cost(anchors, claims, costs.delivery_outcomes()[4])


def spans(spark, data):
    return spark.createDataFrame([(p, dt.date.fromisoformat(a), dt.date.fromisoformat(b)) for p, a, b in data], "person_id int, start_dt date, end_dt date")


def test_enrolled_is_half_open(spark, rows):
    df = spans(spark, [
        (1, "2022-06-01", "2022-09-02"),
        (2, "2022-06-01", "2022-09-01"),
        (3, "2022-06-01", "2022-07-02"), (3, "2022-07-01", "2022-07-15"), (3, "2022-10-01", "2023-01-01"),
        (4, "2010-01-01", "2030-01-01"),
    ])
    assert rows(en.enrolled_k_of_n(df, dt.date(2022, 11, 1), 6, 4)) == [(1, 4), (3, 4), (4, 6)]


def test_months_enrolled_is_inclusive_and_keeps_zero(spark, rows):
    df = spans(spark, [
        (1, "2016-01-01", "2018-12-01"), (2, "2017-01-02", "2018-12-31"), (3, "2017-01-01", "2017-06-01"), (3, "2017-05-15", "2017-08-01"),
        (4, "2019-01-01", "2019-12-31"), (5, "2017-03-02", "2017-03-31"),
    ])
    got = en.enrolment_thresholds(en.months_enrolled(df, dt.date(2017, 1, 1), 24))
    assert rows(got) == [(1, 24, 1, 1, 1), (2, 23, 0, 1, 1), (3, 8, 0, 0, 1), (4, 0, 0, 0, 0), (5, 0, 0, 0, 0)]


@pytest.mark.parametrize("first", [dt.date(2015, 2, 1), dt.date(2015, 2, 17)])
@pytest.mark.parametrize("half_open", [False, True])
def test_more_marks_than_one_mask_equal_brute_force(spark, rows, first, half_open):
    data = [(i % 4, first + dt.timedelta(days=37 * i - 300), first + dt.timedelta(days=37 * i - 300 + (i * 61) % 400)) for i in range(60)]
    df = spark.createDataFrame([*data, (9, None, first), (9, first, None)], "k int, s date, e date")
    got = dict(rows(df.groupBy("k").agg(en.marks_covered(first, 75, "s", "e", half_open).alias("n"))))
    marks = [dt.date(first.year + (first.month - 1 + i) // 12, (first.month - 1 + i) % 12 + 1, first.day) for i in range(75)]
    for k in range(4):
        hit = {m for m in marks for kk, s, e in data if kk == k and s <= m and (m < e if half_open else m <= e)}
        assert got[k] == len(hit)
    assert got[9] == 0


def test_marks_on_days_some_months_lack_are_refused(spark):
    with pytest.raises(ValueError):
        en.marks_covered(dt.date(2020, 1, 31), 6, "s", "e", True)


def test_thresholds_of_unknown_months(spark):
    row = en.enrolment_thresholds(spark.createDataFrame([(None,)], "months_enrolled int")).first()
    assert row.enroll_24mo is None and row.enroll_6mo is None


def test_members_in_period(small_tasks, rows):
    data = [(1, -10, 10, -10, 10), (1, 1, 400, -400, -1), (2, 364, 500, 0, 0), (3, -9, -1, 0, 9)]
    df = small_tasks.createDataFrame([(p, *[on(x) for x in d]) for p, *d in data], "person_id int, eff_dt date, end_dt date, benefit_eff_dt date, benefit_end_dt date")
    people = small_tasks.createDataFrame([(1, dt.date(1964, 1, 1)), (2, dt.date(1964, 1, 2)), (3, dt.date(1950, 1, 1))], "person_id int, birth_dt date")
    got = en.members_in_period(df, people, str(on(0)), str(on(364)), "1964-01-01")
    assert rows(got, "person_id", "eff_dt") == [(1, on(-10))]
    assert rows(en.members_in_period(df, None, str(on(0)), str(on(364))), "person_id") == [(1,), (2,)]
