"""Kept tables bucketed by account: the as-of join without a shuffle of either side."""

import os

from conftest import SF_MID
from ledgerline.plans import activity as A
from ledgerline.plans import kept as K
from ledgerline.sources import standins as S


def test_kept_sides_meet_without_a_shuffle(spark, tmp_dir):
    forms, member, services = S.reachout_forms(spark, SF_MID), S.members(spark, SF_MID), S.services(spark, SF_MID)
    name = f"kept{os.getpid()}"
    K.keep_activity_sides(forms, member, services, name, tmp_dir, buckets=8)
    try:
        days = (S.ACTIVITY_FIRST_DAY, S.ACTIVITY_LAST_DAY)
        plan = K.kept_matches(spark, name, *days)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert plan.count("FileScan") == 3                               # forms, their rows without account, services
        bare = [line for line in plan.splitlines() if "unkeyed" in line]
        assert len(bare) == 1
        got, want = K.kept_utilisation(spark, name, *days), A.utilisation_activity(forms, member, services, *days)
        assert sorted(map(tuple, got.collect())) == sorted(tuple(r) for r in want.select(*got.columns).collect())
        assert spark.table(f"{name}_forms_unkeyed").count() > 0
        inner = K.asof.kept_asof(spark, f"{name}_forms", f"{name}_services", left_day="sd", how="inner", **A.FIRST_SERVICE)
        assert inner.count() == K.kept_matches(spark, name).filter("service_id IS NOT NULL").count() > 0
    finally:
        K.drop_kept(spark, name)
