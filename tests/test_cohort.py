import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortweave.operators import cohort as ch
from cohortweave.operators import episodes as ep
from cohortweave.operators import linking as li
from cohortweave.operators import windows as wi

D = dt.date(2022, 1, 1)


def on(n):
    return D + dt.timedelta(days=n)


def claims(spark, data):
    return spark.createDataFrame(
        [(p, None if f is None else on(f), None if t is None else on(t), c) for p, f, t, c in data],
        "person_id int, from_dt date, to_dt date, id_code string",
    )


EPISODES = [
    (1, 0, 2, "Z37.0"), (1, 140, 141, "O84"), (1, 281, 290, "O84"), (1, 281, 285, "Z37.2"),
    (2, 5, 5, "O99"), (2, None, 9, "O80"), (3, 7, 7, None),
]


def test_gap_of_140_stays_and_141_splits(small_tasks, rows):
    got = ep.gap_episodes(claims(small_tasks, EPISODES))
    assert rows(got, "person_id", "from_dt", "episode") == sorted(
        [(1, on(0), 0), (1, on(140), 0), (1, on(281), 1), (1, on(281), 1), (2, on(5), 0), (2, None, 0), (3, on(7), 0)],
        key=repr,
    )


def test_episode_summary_labels_in_rule_order(small_tasks, rows):
    got = ep.episode_summary(claims(small_tasks, EPISODES))
    assert rows(got, "person_id", "deliv_id", "deliv_start_dt", "deliv_end_dt", "deliv_claims_days", "singleton") == [
        (1, 0, on(0), on(141), 141, 1),
        (1, 1, on(281), on(290), 9, 0),
        (2, 0, on(5), on(9), 4, 1),
        (3, 0, on(7), on(7), 0, None),
    ]


def test_episode_spans_are_ordered_and_apart(small_tasks):
    spans = ep.episode_spans(claims(small_tasks, EPISODES))
    assert [tuple(r) for r in spans.where("person_id = 1").orderBy("episode").collect()] == [
        (1, 0, on(0), on(141), 2), (1, 1, on(281), on(290), 2),
    ]


@pytest.mark.parametrize("per_day", [False, True])
def test_latest_rows_keep_ties(small_tasks, rows, per_day):
    df = small_tasks.createDataFrame([(1, on(0), "a"), (1, on(3), "b"), (1, on(3), "c"), (1, on(9), "d"), (2, None, "e")], "k int, d date, v string")
    got = ep.latest_rows(df, "k", "d", str(on(0)), str(on(5)), per_day=per_day)
    assert rows(got, "k", "v") == [(1, "b"), (1, "c")]


def scores(spark, data):
    return spark.createDataFrame([(p, on(d), s) for p, d, s in data], "person_id int, score_dt date, score double")


def tracking(spark, data):
    return spark.createDataFrame([(p, None if d is None else on(d), n) for p, d, n in data], "person_id int, file_date date, program_name string")


def test_high_scores_are_strictly_above_the_cut(spark, rows):
    df = scores(spark, [(1, 0, 0.1), (2, 0, 0.11), (3, -1, 0.9), (4, 10, 0.5), (5, 0, None)])
    assert [r[0] for r in rows(ch.high_scores(df, str(on(0)), str(on(10))))] == [2, 4]


def test_score_referral_window(small_tasks, rows):
    s = scores(small_tasks, [(1, 0, 0.5), (2, 0, 0.5), (3, 0, 0.5), (4, 0, 0.5), (5, 0, 0.5), (5, 0, 0.5)])
    t = tracking(small_tasks, [(1, 60, "in"), (1, 61, "late"), (2, 61, "late"), (3, -1, "early"), (4, None, "undated"), (9, 5, "no score")])
    got = rows(ch.score_referral(s, t), "person_id", "file_date", "program_name")
    assert got == [(1, on(60), "in"), (4, None, "undated"), (5, None, None)]


def test_score_referral_equals_brute_force_on_a_crowded_person(small_tasks, rows):
    s = [(1, d, 0.5) for d in range(0, 200, 7)]
    t = [(1, d, str(d)) for d in range(0, 260, 5)]
    got = rows(ch.score_referral(scores(small_tasks, s), tracking(small_tasks, t)), "score_dt", "file_date")
    assert got == sorted({(on(a), on(b)) for _, a, _ in s for _, b, _ in t if a <= b <= a + 60}, key=repr)


def pool(spark, data):
    return spark.createDataFrame(
        [(p, on(d), None if f is None else on(f), n) for p, d, f, n in data], "person_id int, score_dt date, file_date date, note string"
    )


POOL = [
    (1, 0, None, "only"),
    (2, 0, 20, "old"), (2, 10, 20, "tie a"), (2, 10, 20, "tie b"), (2, 30, 20, "after"),
    (3, 0, None, "first"), (3, 30, None, "second"),
    (4, 0, None, "first"), (4, 31, None, "second"),
    (5, 0, None, "a"), (5, 1, None, "b"), (5, 2, None, "c"),
    (6, 4, None, "same day"), (6, 4, None, "same day too"),
]


def test_single_latest_and_paired(spark, rows):
    df = pool(spark, POOL)
    assert rows(ch.single_record(df), "person_id", "note") == [(1, "only")]
    assert rows(ch.latest_before(df), "person_id", "note") == [(2, "tie b")]
    assert rows(ch.paired_score_rule(df), "person_id", "note") == [(3, "second"), (6, "same day too"), (6, "same day")]


def test_dedupe_policies_and_columns(spark, rows):
    df = pool(spark, POOL)
    got = ch.dedupe_by_policy(df)
    assert got.columns == df.columns
    assert rows(got, "person_id", "note") == [(1, "only"), (2, "tie b"), (3, "second"), (6, "same day too"), (6, "same day")]


def test_event_strictly_after_and_within_forty_weeks(spark, rows):
    cohort = scores(spark, [(p, 0, 0.5) for p in (1, 2, 3, 4)])
    events = spark.createDataFrame([(1, on(0)), (2, on(280)), (3, on(281)), (4, on(10)), (4, on(200))], "person_id int, deliv_start_dt date")
    assert [r[0] for r in rows(ch.attach_event_in_window(cohort, events), "person_id")] == [2]


def test_study_groups(spark, rows):
    data = [
        (1, None, None, None, None), (2, D, 1, "Maternity High Risk", on(39)), (3, D, 1, "Maternity High Risk", on(40)),
        (4, D, 1, "Maternity High Risk", None), (5, D, 1, "Other", on(0)), (6, D, None, "Other", on(0)), (7, D, 0, "Maternity High Risk", on(0)),
    ]
    df = spark.createDataFrame(data, "person_id int, file_date date, engaged int, program_name string, assessment_complete_date date")
    got = ch.study_groups(df.withColumn("deliv_start_dt", F.lit(on(100))))
    late = "Engaged MHR, too late?"
    assert [r[1] for r in rows(got, "person_id", "groups")] == [
        "Not Sent", "Engaged MHR", late, late, "Engaged Other Program", "Sent, Not Engaged", "Sent, Not Engaged",
    ]


def test_active_span_under_both_ranges_latest_wins(small_tasks, rows):
    spans = [
        (1, "old", 0, 90, 0, 90), (1, "new", 10, 90, 0, 90), (1, "tie", 10, 90, 0, 90), (1, "half", 20, 90, 60, 90), (2, "x", 60, 90, 0, 90),
    ]
    df = small_tasks.createDataFrame(
        [(p, h, on(a), on(b), on(c), on(d)) for p, h, a, b, c, d in spans],
        "person_id int, household_id string, eff_dt date, end_dt date, benefit_eff_dt date, benefit_end_dt date",
    )
    cohort = small_tasks.createDataFrame([(1, on(50)), (2, on(50))], "person_id int, deliv_start_dt date")
    intervals = [("eff_dt", "end_dt"), ("benefit_eff_dt", "benefit_end_dt")]
    assert rows(li.active_span_lookup(cohort, df, "deliv_start_dt", intervals)) == [("new", 1), ("tie", 1)]


def test_household_links_pad_both_ends(small_tasks, rows):
    cohort = small_tasks.createDataFrame([(1, on(0), on(3)), (2, on(0), on(3))], "person_id int, deliv_start_dt date, deliv_end_dt date")
    households = small_tasks.createDataFrame([("h", 1), (None, 2)], "household_id string, person_id int")
    births = [("h", 10, -7), ("h", 11, -8), ("h", 12, 10), ("h", 13, 11), ("h", 14, 0), ("h", 14, 0), (None, 15, 0), ("h", 1, -9000)]
    members = small_tasks.createDataFrame([(h, p, on(b)) for h, p, b in births], "household_id string, person_id int, birth_dt date")
    got = rows(li.link_by_household(cohort, households, members), "mother_id", "infant_id")
    assert got == [(1, 10), (1, 12), (1, 14)]


def test_proportions_and_key_checks(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 0), ("b", 0), (None, 1)], "g string, f int")
    got = li.group_proportions(df, "g", "f")
    assert [(g, f, n, round(p, 3)) for g, f, n, p in rows(got)] == [("a", 0, 1, 0.333), ("a", 1, 2, 0.667), ("b", 0, 1, 1.0), (None, 1, 1, 1.0)]
    assert rows(li.key_checks(df, "g")) == [(5, 2, 2, 1)]
    assert rows(li.key_checks(df.where("false"), "g")) == [(0, 0, 0, 0)]
    other = spark.createDataFrame([("b",)], "k string")
    assert rows(li.unmatched_keys(df, other, "g", "k")) == [("a",), (None,)]


def test_anchor_twins_and_claim_span(spark, rows):
    cohort = spark.createDataFrame([(1, on(0), 5), (2, on(0), 60), (3, on(0), 61)], "person_id int, deliv_start_dt date, deliv_claims_days int")
    links = spark.createDataFrame([(1, on(2)), (1, on(3)), (1, on(3))], "mother_id int, infant_birth_dt date")
    assert rows(wi.anchor_and_window(cohort, links)) == [
        (1, on(2), on(2 - 308), on(3 + 182)), (2, on(0), on(-308), on(182)), (3, None, None, None),
    ]


def test_weekly_histogram_starts_on_monday(spark, rows):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 8),), (dt.date(2024, 1, 14),), (None,)], "d date")
    assert rows(wi.weekly_histogram(df, "d")) == [(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 8), 2)]
