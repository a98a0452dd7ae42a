"""Shape of the physical plans: no Python workers, one scan, bounded windows, pushed columns."""

import pytest
from pyspark.sql import functions as F

from fixtures.inputs import RAW_SURVEY, raw_survey, survey, table
from fixtures.queries import QUERIES
from lakeops.operators import ranking, shares
from lakeops.plans.reports import REPORTS
from parity import SF_DIR


def scans(text):
    """Scans in the part of an executed plan that ran; reused exchanges hold none."""
    return text.split("== Initial Plan ==")[0].count("FileScan")


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_reports_read_the_survey_once(spark, name):
    df = REPORTS[name](survey(spark, SF_DIR))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert scans(plan) <= 1
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_top_k_limits_groups_before_ranking(spark):
    df = ranking.top_k_shares(table(spark, SF_DIR, "customer"), "c_nationkey", "c_mktsegment", 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_score_stacks_in_one_scan(spark):
    df = shares.weighted_code_score(table(spark, SF_DIR, "lineitem"), ["l_quantity", "l_tax"])
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert scans(plan) == 1 and "Expand" in plan


def test_profile_is_one_scan_of_any_number_of_columns(spark):
    df = QUERIES["missing_profile"](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("FileScan") == 1


def test_filter_and_columns_reach_the_scan(spark):
    years = table(spark, SF_DIR, "orders").where(F.col("o_orderstatus") == "F")
    df = shares.share_of_total(years, "o_orderpriority")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_orderstatus:string,o_orderpriority:string>" in plan


def test_decoding_needs_no_python_worker_and_stays_compiled(spark):
    df = survey(spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert len(raw_survey(spark, SF_DIR).columns) == len(RAW_SURVEY) + 1


def test_changes_are_one_lazy_plan(spark):
    yearly = table(spark, SF_DIR, "orders").select("o_orderstatus", F.year("o_orderdate").alias("yr"))
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    df = ranking.change_over_time(yearly, "o_orderstatus", "yr", (1996, 2001))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before
    df.collect()
    assert scans(df._jdf.queryExecution().executedPlan().toString()) == 1
