"""What the physical plans must look like: pushdown, pruning, map-side limits, no pair-wise joins."""

import pytest

from cohortweave import session
from cohortweave.catalog import ORACLES, QUERIES
from cohortweave.catalog.views import claims_v, referrals_v, scores_v
from cohortweave.operators import cohort as ch
from cohortweave.operators import episodes as ep

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_score_filters_reach_the_scan_with_few_columns(spark):
    text = plan(ch.high_scores(scores_v(spark, SF), "2024-01-01", "2024-01-10", 0.2))
    assert "EqualTo(event_type,signup)" in text
    assert "ReadSchema: struct<ts:timestamp" in text and "props" not in text.split("ReadSchema")[1].split("\n")[0]


def test_period_filter_of_claims_is_pushed(spark):
    assert "PushedFilters" in plan(QUERIES["members_in_period"](spark, SF))


def test_episodes_need_two_shuffles_and_no_join(spark):
    text = plan(ep.episode_spans(claims_v(spark, SF)))
    assert "Join" not in text and text.count(") Exchange\n") == 2


@pytest.mark.parametrize("per_day", [True])
def test_rank_filters_limit_before_the_shuffle(spark, per_day):
    referred = ch.score_referral(scores_v(spark, SF), referrals_v(spark, SF).drop("population"))
    assert "WindowGroupLimit" in plan(ch.latest_before(referred))
    days = claims_v(spark, SF).select("person_id", "from_dt").distinct()
    assert "WindowGroupLimit" in plan(ep.latest_rows(days, "person_id", "from_dt", per_day=per_day))


@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"weighted_density", "tract_density", "exact_quantiles"}))
def test_no_query_compares_all_pairs_or_runs_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text


def test_weight_labels_end_in_a_stage_of_few_steps(spark):
    """The last stage reads written labels and windows: no claims, no flags of all steps in one task."""
    text = plan(QUERIES["weight_status_labels"](spark, SF))
    assert "lineitem" not in text and text.count("weight-labels-") >= 1 and "exclusion-windows-" in text
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_tuning_leaves_task_sizes_that_the_session_has_set(spark):
    key, size = session.TASK_BYTES
    assert session.tune(spark).conf.get(key) == size
    try:
        spark.conf.set(key, "8m")
        assert session.tune(spark).conf.get(key) == "8m"
    finally:
        spark.conf.set(key, size)


def test_strata_read_their_rows_from_one_written_table(spark):
    text = plan(QUERIES["model_strata"](spark, SF))
    assert "model-rows-" in text and "orders" not in text and "customer" not in text
