"""What the physical plans must and must not contain."""

import re

import pytest

from sitewell.plans import registered
from tests.test_registered import FOLDER, pytestmark  # noqa: F401 - skips without test tables


def plan(spark, name):
    return registered.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "stg_pms_procedures", "visit_rollup", "payments_by_payer", "labor_cost_rule", "signed_ledger", "inventory_value",
    "opex_monthly", "scorecard_monthly", "scorecard_weekly", "reconciliation_full", "operations_monthly",
    "dq_unmapped_strict", "pnl_margin", "period_compare_month", "alerts", "od_extract", "feed_fold"])
def test_no_costly_operators(spark, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate", "Python", "SinglePartition"):
        assert operator not in text, operator


def test_two_facts_are_merged(spark):
    assert "SortMergeJoin [l_orderkey" in plan(spark, "visit_rollup")


def test_window_reaches_the_scan(spark):
    scan = [line for line in plan(spark, "since_window").splitlines() if "FileScan" in line]
    assert len(scan) == 1 and re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate", scan[0])


def test_scans_read_few_columns(spark):
    for line in plan(spark, "payments_by_payer").splitlines():
        if "customer.parquet" in line:
            assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in line


def test_scorecard_reads_each_feed_once(spark):
    text = plan(spark, "scorecard_monthly")
    # lines twice as practice lines would be wrong: once each as procedures, timecards, ledger and supplies
    assert text.count("lineitem.parquet") == 4 and text.count("events.parquet") == 2


@pytest.mark.parametrize("name", ["conform_union", "payments_union", "raw_source_counts"])
def test_feeds_of_seven_systems_join_lines_once(spark, name):
    """The gathered feed is written once and split by system afterwards, without another join of facts."""
    assert "lineitem.parquet" not in plan(spark, name) or plan(spark, name).count("SortMergeJoin [l_orderkey") <= 1


def test_one_scan_of_providers(spark):
    assert plan(spark, "od_providers").count("supplier.parquet") == 1


def scans(text, name):
    return [line for line in text.splitlines() if f"{name}.parquet" in line and "FileScan" in line]


@pytest.mark.parametrize("name", ["source_counts", "raw_source_counts"])
def test_counts_read_no_column(spark, name):
    text = plan(spark, name)
    counted = ["orders", "lineitem", "supplier", "pages", "documents", "conversations"] if name == "source_counts" else ["lineitem"]
    for which in counted:
        found = scans(text, which)
        assert found and all("ReadSchema: struct<>" in line for line in found), which
    assert "SortMergeJoin" not in text


def test_findings_read_each_feed_once(spark):
    for name in ("dq_unmapped", "dq_unmapped_strict"):
        assert len(scans(plan(spark, name), "lineitem")) == 4, name


def test_build_summary_reads_each_feed_once(spark, monkeypatch):
    from sitewell.operators import publish
    passes, settled = [], publish.settled

    def counted(df):
        passes.append(len(scans(df._jdf.queryExecution().executedPlan().toString(), "lineitem")))
        return settled(df)

    monkeypatch.setattr(publish, "settled", counted)
    assert len(scans(plan(spark, "build_summary"), "lineitem")) + sum(passes) == 4
