"""Every filter and merge rule drops rows of the stand-in data, so that a green entry says something."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from ledgerline import registry as Q
from ledgerline.functions import codes
from ledgerline.operators import merge as M
from ledgerline.plans import activity as A
from ledgerline.plans import ranking as RK
from ledgerline.plans import refresh as RF
from ledgerline.plans import renewals as R
from ledgerline.sources import standins as S


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_rules_drop_rows(spark, sf):
    forms = S.reachout_forms(spark, sf)
    assert forms.filter(F.col("is_draft").isNull()).count() > 0
    assert forms.filter(F.col("form_type") != codes.FORM_TYPE).count() > 0
    base = Q._base(spark, sf)
    assert R.leaderboard(Q._cube(spark, sf)).count() < base.select("channel", "owner").distinct().count()
    day = S.agent_day(spark, sf)
    assert RK.filtered(day, active_only=True).count() < day.count()
    _, members, services = Q._act(spark, sf)
    prev = A.reachout_raw(RF.log_as_of(forms, Q.CUTOFF), members, services, S.ACTIVITY_FIRST_DAY, S.ACTIVITY_LAST_DAY)
    older = prev.withColumn("d", F.when(F.col("form_uid") % 5 == 0, F.add_months("d", -4)).otherwise(F.col("d")))
    assert M.rolling_months(older, S.ACTIVITY_AS_OF).count() < older.count()


def test_each_form_document_is_parsed_once(spark, tmp_dir):
    S.reachout_forms(spark, SF_SMALL).write.mode("overwrite").parquet(f"{tmp_dir}/forms")
    stored = spark.read.parquet(f"{tmp_dir}/forms")
    calls = A.call_activity(stored, S.ACTIVITY_FIRST_DAY, S.ACTIVITY_LAST_DAY)
    assert calls._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 3


def test_service_scan_starts_at_the_first_day(spark):
    services = S.services(spark, SF_SMALL)
    cut = A.qualifying_services(services, d1=dt.date(2024, 1, 20))
    assert 0 < cut.count() < A.qualifying_services(services).count() and cut.agg(F.min("service_day")).first()[0] == dt.date(2024, 1, 20)


def test_raw_search_filters_before_the_asof(spark):
    for row in Q.raw_search(spark, SF_MID).limit(3).collect():
        assert row.mobile_masked != "-"
    plan = Q.raw_search(spark, SF_MID)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("#00000012") >= 2  # on the rows and on the keys of the as-of join
