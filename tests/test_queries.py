"""Every registered query with SQL against DuckDB on the smallest tables, and the studies' invariants."""

import pytest
from pyspark.sql import functions as F

from cohortweave.catalog import ORACLES, QUERIES
from compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, SF, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", ["tiered_identify", "latest_rows", "score_referral", "link_by_household", "assembled_outcomes",
                                  "household_features", "members_in_period", "crosswalk_claims_by_status", "gap_episodes"])
def test_query_equals_sql_when_every_key_is_hot(small_tasks, duck, name):
    assert compare(small_tasks, duck, SF, QUERIES[name], ORACLES[name]) is None


def test_only_models_lack_sql():
    assert sorted(set(QUERIES) - set(ORACLES)) == ["model_evaluation", "model_leaderboard", "saved_model_scores"]


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_one_row_per_person_and_no_label_inside_a_window(spark):
    care = QUERIES["long_term_care_groups"](spark, SF)
    assert care.count() == care.select("cust_id").distinct().count()
    assert care.where(F.col("ltc_cat") == "ILTC long 1999, start 97-98").count() == 0
    study = QUERIES["study_groups"](spark, SF)
    assert study.count() == study.select("person_id").distinct().count()
