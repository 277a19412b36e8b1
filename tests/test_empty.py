"""Every registered query runs on empty tables (same schemas, no rows)."""

import os

import pytest

from conftest import SF_SMALL
from ledgerline import registry


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for t in ["customer", "orders", "events", "documents", "labels"]:
        spark.read.parquet(os.path.join(SF_SMALL, f"{t}.parquet")).limit(0).write.parquet(os.path.join(d, f"{t}.parquet"))
    return d


@pytest.mark.parametrize("name", sorted(registry.all_queries()))
def test_query_runs_on_empty_tables(spark, empty_dir, name):
    rows = registry.all_queries()[name](spark, empty_dir).collect()
    if name in ("agent_funnel", "touchpoint_pivot", "utility_breakdown", "disposition_breakdown"):
        assert [r.agent for r in rows] == ["ALL"]          # the total row is kept, at zero
    if name == "retention_funnel_all":
        assert [r.channel for r in rows] == ["ALL"]
