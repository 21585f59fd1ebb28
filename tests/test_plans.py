"""Physical plans keep what makes them scale."""

import pytest
from conftest import DATA, plan_of

from paidmedia.plans import catalog

FOLDER = f"{DATA}/sf0.001"


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(catalog.queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                     "ArrowEvalPython", "MapInPandas", "RDDScan"):
        assert operator not in plan, operator


def test_scan_reads_only_what_the_trend_needs(spark):
    plan = plan_of(catalog.queries()["cac_monthly_trend"](spark, FOLDER))
    assert "ReadSchema: struct<date:date,channel:string,spend_gbp:decimal(18,2),new_customers:bigint>" in plan
    assert "GreaterThan(new_customers,0)" in plan


def test_row_attribution_does_not_shuffle_the_fact(spark):
    plan = plan_of(catalog.queries()["row_attribution"](spark, FOLDER))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_cohorts_scan_the_fact_once(spark):
    for name in ("ltv_cohort_90d", "isolated_channel_days", "attribution_own_revenue"):
        assert plan_of(catalog.queries()[name](spark, FOLDER)).count("Location:") == 1, name


def test_fact_counts_without_expand(spark):
    from paidmedia.sources.fact import build_fact, raw

    plan = plan_of(build_fact(*(raw(spark, FOLDER, t) for t in ("orders", "lineitem", "part"))))
    assert "Expand" not in plan
    assert "l_tax" not in plan and "l_shipdate" not in plan


def test_top_ranks_are_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(catalog.queries()["top_channels_monthly"](spark, FOLDER))
