"""Plan shape: what the optimizer must see for the jobs to scale."""

import pytest

from conftest import SF_SMALL
from ledgerline import registry
from ledgerline.plans import activity as A
from ledgerline.sources import standins as S


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.all_queries()))
def test_no_python_udfs_no_cartesian(spark, name):
    p = plan(registry.all_queries()[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, (name, bad)


def test_filtered_distinct_counts_do_not_expand(spark):
    p = plan(registry.all_queries()["activity_call"](spark, SF_SMALL))
    assert "Expand" not in p
    assert p.count("partial_count") >= 1 or "partial_" in p


def test_day_window_reaches_scan_and_scan_is_narrow(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    forms = S.reachout_forms(spark, SF_SMALL)
    created = A.created_activity(forms, S.members(spark, SF_SMALL), S.ACTIVITY_FIRST_DAY, S.ACTIVITY_LAST_DAY)
    p = plan(created)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(ts," in p and "LessThan(ts," in p       # half-open day range pushed down
    events_scans = [line for line in p.splitlines() if "events.parquet" in line]
    assert events_scans and all("value:" not in line for line in events_scans)   # unused column pruned


def test_aggregations_are_partial_before_shuffle(spark):
    p = plan(registry.all_queries()["retention_funnel"](spark, SF_SMALL))
    assert "partial_count" in p and "partial_sum" in p


def test_asof_joins_by_keys_and_reads_each_side_once(spark):
    for name in ("first_service_after", "activity_utilisation", "reachout_raw"):
        p = plan(registry.all_queries()[name](spark, SF_SMALL))
        joins = [line for line in p.splitlines() if "Join" in line]
        assert joins and all("Join [" in line for line in joins)      # only equi-joins, with their keys
        scans = [line for line in p.splitlines() if "FileScan" in line]
        assert sum("events.parquet" in x for x in scans) == 2, name     # forms once, services once
        assert sum("customer.parquet" in x for x in scans) == 1, name   # one member join
