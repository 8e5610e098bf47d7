"""Plans of all registered batch queries: what must not be in them, and what must be pushed down."""

import re

import pytest

from gaugeworks.plans import load_all

DIRECTORY = "/root/testdata/sf0.001"
# Queries that run a job of their own (streams, table writes) before they return a result.
WITH_JOBS = {
    "a2_read_ingest", "a2_ingest_quarantine", "a6_write_fact", "a9_archive_partitions", "a9_archive_log",
    "a9_heartbeat_retention",
}
NAMES = sorted(n for n in load_all() if n not in WITH_JOBS and "stream" not in n and n != "d5_cdc_current_state")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_plan_has_no_pair_explosion_or_python(spark, name):
    plan = _plan(load_all()[name].run(spark, DIRECTORY))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan
    # A window over everything in one partition would not scale.
    assert not re.search(r"Window \[[^\n]*\n[^\n]*Sort [^\n]*\n[^\n]*Exchange SinglePartition", plan)


def test_flagship_reads_only_what_it_needs(spark):
    plan = _plan(load_all()["c1_daily_attribute_stats"].run(spark, DIRECTORY))
    scans = re.findall(r"FileScan parquet \[ts[^\n]*", plan)
    assert scans and all("GreaterThanOrEqual(ts" in s for s in scans)
    assert all("ReadSchema: struct<ts:timestamp,user_id:bigint,event_type:string,value:double>" in s for s in scans)


def test_percentiles_scan_the_fact_three_times_at_most(spark):
    """In the plan that ran: the steps of a percentile read one shuffle again instead of the fact."""
    for name in ("c1_daily_attribute_stats", "c22_category_distribution", "c31_baseline_outliers"):
        df = load_all()[name].run(spark, DIRECTORY)
        df.collect()
        ran = _plan(df).split("== Initial Plan ==")[0]
        scans = len(re.findall(r"FileScan parquet \[ts", ran))
        assert 1 <= scans <= 3 and "ReusedExchange" in ran, (name, scans)


def test_flush_has_no_single_task_top(spark):
    for name in ("a3_flush_moved", "a3_flush_remaining"):
        assert "TakeOrdered" not in _plan(load_all()[name].run(spark, DIRECTORY))


def test_time_filters_reach_the_scan(spark):
    for name in ("c2_hourly_event_rate", "c4_entity_uptime", "c8_attribute_correlation", "c15_tenant_freshness"):
        plan = _plan(load_all()[name].run(spark, DIRECTORY))
        assert "GreaterThanOrEqual(ts" in plan, name
