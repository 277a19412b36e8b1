"""Cross-report invariants on the sf0.01 tables."""

from pyspark.sql import functions as F

from conftest import SF_MID
from ledgerline.functions import codes
from ledgerline.registry import all_queries


Q = all_queries()


def test_funnel_cycle_leaderboard_agree(spark):
    f = {r.channel: r for r in Q["retention_funnel"](spark, SF_MID).collect()}
    cyc = Q["cycle_retention"](spark, SF_MID).groupBy("channel").agg(
        F.sum("total").alias("t"), F.sum("renewed").alias("r")).collect()
    lb = Q["owner_leaderboard"](spark, SF_MID).groupBy("channel").agg(F.sum("total_accts").alias("t")).collect()
    for r in cyc:
        assert f[r.channel].total == r.t and f[r.channel].renewed == r.r
    for r in lb:
        assert r.t <= f[r.channel].total
    for r in f.values():
        bands = r.not_in_window + r.outreach + r.grace_early + r.grace_late + r.overdue
        assert bands + r.renewed <= r.total


def test_funnel_all_is_sum_of_rounded_channels(spark):
    rows = {r.channel: r for r in Q["retention_funnel_all"](spark, SF_MID).collect()}
    for k in ["total", "rupees_renewed", "rupees_overdue"]:
        assert getattr(rows["ALL"], k) == sum(getattr(rows[c], k) for c in codes.CHANNELS if c in rows)


def test_watchlist_is_global_top_k(spark):
    wl = Q["overdue_watchlist"](spark, SF_MID).collect()
    assert len(wl) == codes.WATCHLIST_SIZE
    prem = [r.old_premium for r in wl]
    assert prem == sorted(prem, reverse=True)


def test_activity_bounds(spark):
    rows = Q["activity_today"](spark, SF_MID)
    bad = rows.filter((F.col("bookings") > F.col("calls")) | (F.col("pending") > F.col("forms"))
                      | ((F.col("di") + F.col("ddnp") + F.col("dre") + F.col("ddnd") + F.col("dig") + F.col("dww")
                          + F.col("dlb") + F.col("dop") + F.col("dno")) > F.col("calls"))
                      | (F.col("u_any") > F.col("calls")))
    assert bad.count() == 0


def test_written_tables_path_equals_registered_queries(spark, tmp_dir):
    """The deployed path (write activity_day, read back) gives the registered answers."""
    from ledgerline.plans import refresh as RF
    from ledgerline.sources import standins as S

    paths = RF.refresh_activity_tables(S.reachout_forms(spark, SF_MID), S.members(spark, SF_MID),
                                       S.services(spark, SF_MID), S.ACTIVITY_FIRST_DAY, S.ACTIVITY_LAST_DAY,
                                       S.ACTIVITY_AS_OF, tmp_dir)
    report = RF.agent_report(spark, paths)
    for name in ["agent_funnel", "touchpoint_pivot", "activity_kpis", "date_presets"]:
        got = sorted(tuple(r) for r in report[name].collect())
        want = sorted(tuple(r) for r in Q[name](spark, SF_MID).select(*report[name].columns).collect())
        assert got == want, name
