"""Read-side views: channel selection, orderings, display page."""

import datetime as dt

from conftest import SF_MID
from ledgerline.plans import activity as A
from ledgerline.plans import agent_tables as T
from ledgerline.plans import renewals as R
from ledgerline.registry import all_queries

Q = all_queries()


def test_channel_views_and_orders(spark):
    lb = Q["owner_leaderboard_all"](spark, SF_MID)
    view = R.leaderboard_view(lb, "ALL", "renewal_pct").collect()
    assert all(r.channel == "ALL" for r in view)
    pcts = [r.renewal_pct for r in view]
    assert pcts == sorted(pcts, reverse=True)
    cyc = [r.cycle for r in R.cycle_view(Q["cycle_retention_all"](spark, SF_MID), "CLINIC").collect()]
    assert cyc == sorted(cyc) and len(cyc) == 4
    f = [r.channel for r in R.funnel_order(Q["retention_funnel"](spark, SF_MID)).collect()]
    assert f == sorted(f)


def test_agent_table_view_all_last(spark):
    t = T.table_view(Q["utility_breakdown"](spark, SF_MID), "booked").collect()
    assert t[-1].agent == "ALL"
    booked = [r.booked for r in t[:-1]]
    assert booked == sorted(booked, reverse=True)


def test_raw_page_caps_display_not_count(spark):
    searched = Q["raw_search"](spark, SF_MID)
    page, count = A.raw_page(searched, cap=10)
    rows = page.collect()
    assert len(rows) == 10 and count.collect()[0].n_rows == searched.count() > 10
    ds = [r.d for r in rows]
    assert ds == sorted(ds, reverse=True)
