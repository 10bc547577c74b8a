"""Structural properties of the physical plans that the scale design relies
on, checked on every registered query (planning only, nothing executed)."""

import re

import pytest

from riskforge.plans.build import Build
from riskforge.plans.queries import registry
from tests.conftest import SMALL

QUERIES = registry()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_products_or_python(spark, name):
    plan = physical(QUERIES[name](spark, SMALL))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in plan, f"{name}: {node}"


def test_staging_filters_reach_the_scan(spark):
    b = Build.from_testdata(spark, SMALL, audit=False)
    plan = physical(b.stg_loan_portfolio)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(exposure_amount,0(\.00)?\)", plan), plan


@pytest.fixture
def no_static_broadcast(spark):
    """Plans as they are for tables beyond any broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_rwa_report_reads_the_stored_table(spark, no_static_broadcast):
    b = Build.from_testdata(spark, SMALL, audit=False)
    plan = physical(b.basel3_rwa_report)
    assert "hashpartitioning(counterparty_id" not in plan and "Join" not in plan
    # partial aggregate below the exchange that feeds the final aggregate
    assert re.search(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_", plan)


def test_enrichment_meets_on_the_loan_key_first(spark, no_static_broadcast):
    b = Build.from_testdata(spark, SMALL, audit=False)
    plan = physical(b.credit_risk_enriched)
    # the counterparty join is outermost, so loans and RWA are exchanged on loan_id below it
    assert plan.index("counterparty_id") < plan.index("hashpartitioning(loan_id")


@pytest.mark.parametrize("name, most", [("segment_drill_through", 5), ("report_watch_list", 2), ("basel3_rwa_report", 1)])
def test_exchanges(spark, no_static_broadcast, name, most):
    plan = physical(QUERIES[name](spark, SMALL))
    assert plan.count("Exchange hashpartitioning") <= most, plan


def test_schema_tests_do_not_evaluate_the_enrichment(spark, no_static_broadcast):
    plan = physical(QUERIES["schema_tests"](spark, SMALL))
    assert plan.count("SortMergeJoin") <= 1  # stress rows with their loans


def test_uniqueness_shuffles_its_column_only(spark):
    plan = physical(QUERIES["dq_loan_portfolio"](spark, SMALL))
    for part in re.findall(r"HashAggregate\(keys=\[loan_id[^\]]*\], functions=\[([^\]]*)\]", plan):
        assert part in ("partial_count(1)", "count(1)"), part
