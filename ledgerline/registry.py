"""Named queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import columns as C
from .operators import merge as M
from .plans import activity as A
from .plans import agent_tables as T
from .plans import ranking as RK
from .plans import refresh as RF
from .plans import renewals as R
from .session import scratch_path
from .sources import files as FS
from .sources import sinks as SK
from .sources import standins as S

Query = Callable[[SparkSession, str], DataFrame]
RUN_TS = dt.datetime(2024, 1, 15, 18, 30, 0)


def _numbered(view: DataFrame) -> DataFrame:
    """An ordered view, of bounded size, with the position of each row."""
    placed = view.withColumn("__at", F.monotonically_increasing_id())
    return placed.withColumn("pos", F.row_number().over(Window.orderBy("__at")).cast("bigint")).drop("__at")


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.renewal_base(S.retention(spark, sf_dir), S.RETENTION_AS_OF)


def _cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.renewal_cube(_base(spark, sf_dir))


def retention_funnel(spark, sf_dir):
    return R.funnel(_cube(spark, sf_dir))


def retention_funnel_all(spark, sf_dir):
    return R.funnel_all(R.funnel(_cube(spark, sf_dir)))


def owner_leaderboard(spark, sf_dir):
    return R.leaderboard(_cube(spark, sf_dir))


def owner_leaderboard_all(spark, sf_dir):
    return R.leaderboard_all(R.leaderboard(_cube(spark, sf_dir)))


def cycle_retention(spark, sf_dir):
    return R.cycle_retention(_cube(spark, sf_dir))


def cycle_retention_all(spark, sf_dir):
    return R.cycle_all(R.cycle_retention(_cube(spark, sf_dir)))


def cycle_retention_classes(spark, sf_dir):
    return R.with_classes(cycle_retention_all(spark, sf_dir), "acct_ret_pct", "rev_ret_pct")


def overdue_watchlist(spark, sf_dir):
    return R.watchlist(_base(spark, sf_dir), S.RETENTION_AS_OF)


def watchlist_by_channel(spark, sf_dir):
    return R.watchlist_by_channel(R.watchlist(_base(spark, sf_dir), S.RETENTION_AS_OF))


def pipeline_cards(spark, sf_dir):
    return R.pipeline_cards(R.funnel_all(R.funnel(_cube(spark, sf_dir))))


def funnel_by_channel(spark, sf_dir):
    return _numbered(R.funnel_order(retention_funnel_all(spark, sf_dir)))


def leaderboard_online(spark, sf_dir):
    return _numbered(R.leaderboard_view(owner_leaderboard_all(spark, sf_dir), "ONLINE", "renewal_pct"))


def cycle_clinic(spark, sf_dir):
    return _numbered(R.cycle_view(cycle_retention_all(spark, sf_dir), "CLINIC"))


def renewals_meta(spark, sf_dir):
    return R.renewals_meta(owner_leaderboard_all(spark, sf_dir), RUN_TS)


QUERIES: dict[str, Query] = {
    "funnel_by_channel": funnel_by_channel,
    "leaderboard_online": leaderboard_online,
    "cycle_clinic": cycle_clinic,
    "renewals_meta": renewals_meta,
    "retention_funnel": retention_funnel,
    "retention_funnel_all": retention_funnel_all,
    "owner_leaderboard": owner_leaderboard,
    "owner_leaderboard_all": owner_leaderboard_all,
    "cycle_retention": cycle_retention,
    "cycle_retention_all": cycle_retention_all,
    "cycle_retention_classes": cycle_retention_classes,
    "overdue_watchlist": overdue_watchlist,
    "watchlist_by_channel": watchlist_by_channel,
    "pipeline_cards": pipeline_cards,
}


# ------------------------------------------------------------ activity ---

def _forms(spark, sf_dir):
    return S.reachout_forms(spark, sf_dir)


def _members(spark, sf_dir):
    return S.members(spark, sf_dir)


def _services(spark, sf_dir):
    return S.services(spark, sf_dir)


def _agent_day(spark, sf_dir):
    return S.agent_day(spark, sf_dir)


def _act(spark, sf_dir):
    return (_forms(spark, sf_dir), _members(spark, sf_dir), _services(spark, sf_dir))


def activity_created(spark, sf_dir):
    f, m, _ = _act(spark, sf_dir)
    return A.created_activity(f, m, S.ACTIVITY_FIRST_DAY, None)


def created_since_mid_month(spark, sf_dir):
    """The open-ended window (month-to-date form) with a start that lies inside the data."""
    f, m, _ = _act(spark, sf_dir)
    return A.created_activity(f, m, dt.date(2024, 1, 10), None)


def calls_in_range(spark, sf_dir):
    """Submitted forms by agent and touchpoint in a range of days, through a SQL table function with bound dates."""
    forms = A.submitted_forms(_forms(spark, sf_dir), None, None, "UTC").select("form_uid", F.col("sd").alias("d"), "ag", "bk")
    forms.createOrReplaceTempView("ledgerline_submitted")
    FS.create_range_function(spark, "submitted_between", "ledgerline_submitted", forms.schema)
    return FS.read_range_sql(spark, "SELECT ag, bk, count(DISTINCT form_uid) AS calls, min(d) AS first_day, max(d) AS last_day "
                                    "FROM submitted_between(:d1, :d2) GROUP BY ag, bk", dt.date(2024, 1, 8), dt.date(2024, 1, 20))


def activity_call(spark, sf_dir):
    f, _, _ = _act(spark, sf_dir)
    return A.call_activity(f, S.ACTIVITY_FIRST_DAY, None)


def activity_utilisation(spark, sf_dir):
    f, m, s = _act(spark, sf_dir)
    return A.utilisation_activity(f, m, s, S.ACTIVITY_FIRST_DAY, S.ACTIVITY_LAST_DAY)


def activity_today(spark, sf_dir):
    return _rows(spark, sf_dir)


def open_backlog(spark, sf_dir):
    return _backlog(spark, sf_dir)


def first_service_after(spark, sf_dir):
    f, m, s = _act(spark, sf_dir)
    bs = A.with_member(A.form_base(f.filter("is_draft = false")), m)
    return (A.first_service_after(bs, s, how="inner")
            .select("form_uid", "account_uid", "sd", "claim_creation_time", "service_id", "claim_type"))


def reachout_raw(spark, sf_dir):
    f, m, s = _act(spark, sf_dir)
    return A.reachout_raw(f, m, s, S.ACTIVITY_FIRST_DAY, S.ACTIVITY_LAST_DAY)


# The registered search: a name fragment shared by a handful of members.
RAW_QUERY = "#00000012"


def raw_search(spark, sf_dir):
    f, m, s = _act(spark, sf_dir)
    return A.raw_search(A.reachout_raw(f, m, s, S.ACTIVITY_FIRST_DAY, S.ACTIVITY_LAST_DAY, include_pii=True, query=RAW_QUERY))


def raw_search_indexed(spark, sf_dir):
    """The same search, its members found in the trigram index."""
    f, m, s = _act(spark, sf_dir)
    index = _scratch(spark, "member-index")
    A.index_members(m, index)
    return A.raw_search(A.reachout_raw(f, m, s, S.ACTIVITY_FIRST_DAY, S.ACTIVITY_LAST_DAY, include_pii=True, query=RAW_QUERY, member_index=index))


def raw_page_counted(spark, sf_dir):
    """The display page of all member-level rows (its cap is the feature), each with the uncapped count beside it."""
    f, m, s = _act(spark, sf_dir)
    page, count = A.raw_page(A.raw_search(A.reachout_raw(f, m, s, S.ACTIVITY_FIRST_DAY, S.ACTIVITY_LAST_DAY, include_pii=True)))
    return _numbered(page.drop("agent_name", "mobile_masked")).withColumn("n_rows", count.scalar())


def raw_page_booked(spark, sf_dir):
    """The display page (its cap is the feature) of one agent's booked rows in a window of days."""
    f, m, s = _act(spark, sf_dir)
    d1, d2 = dt.date(2024, 1, 5), dt.date(2024, 1, 25)
    raw = A.reachout_raw(f, m, s, d1, d2, include_pii=True, agent="am.3")
    page, _ = A.raw_page(A.raw_search(raw, booked_only=True))
    return _numbered(page.drop("agent_name", "mobile_masked"))


def raw_csv_rows(spark, sf_dir):
    f, m, s = _act(spark, sf_dir)
    return SK.raw_csv_frame(A.reachout_raw(f, m, s, S.ACTIVITY_FIRST_DAY, S.ACTIVITY_LAST_DAY, include_pii=True))


def activity_positional_rows(spark, sf_dir):
    return SK.positional_json(_rows(spark, sf_dir))


QUERIES.update({
    "first_service_after": first_service_after,
    "activity_created": activity_created,
    "activity_call": activity_call,
    "activity_utilisation": activity_utilisation,
    "activity_today": activity_today,
    "open_backlog": open_backlog,
    "reachout_raw": reachout_raw,
    "raw_search": raw_search,
    "raw_search_indexed": raw_search_indexed,
    "raw_page_booked": raw_page_booked,
    "raw_page_counted": raw_page_counted,
    "created_since_mid_month": created_since_mid_month,
    "calls_in_range": calls_in_range,
    "raw_csv_rows": raw_csv_rows,
    "activity_positional_rows": activity_positional_rows,
})


# ------------------------------------------- merges, meta, agent tables ---

CUTOFF = dt.datetime(2024, 1, 15, 12, 0, 0)
NOW_TS = dt.datetime(2024, 1, 15, 18, 37, 40)


def _scratch(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _stale_rows(spark, sf_dir):
    f, m, s = _act(spark, sf_dir)
    return A.activity_day(RF.log_as_of(f, CUTOFF), m, s, S.ACTIVITY_FIRST_DAY, S.ACTIVITY_AS_OF)


def _rows(spark, sf_dir):
    f, m, s = _act(spark, sf_dir)
    return A.activity_day(f, m, s, S.ACTIVITY_FIRST_DAY, S.ACTIVITY_LAST_DAY)


def _backlog(spark, sf_dir):
    return A.open_backlog(_forms(spark, sf_dir), S.ACTIVITY_AS_OF)


def merge_day_slice(spark, sf_dir):
    f, m, s = _act(spark, sf_dir)
    return RF.day_slice_refresh(_stale_rows(spark, sf_dir), f, m, s, S.ACTIVITY_AS_OF)


def merge_carry_forward(spark, sf_dir):
    f, m, s = _act(spark, sf_dir)
    return RF.carry_forward_refresh(_stale_rows(spark, sf_dir), f, m, as_of=S.ACTIVITY_AS_OF)


def _long_history(spark, sf_dir):
    f, m, s = _act(spark, sf_dir)
    prev = A.reachout_raw(RF.log_as_of(f, CUTOFF), m, s, S.ACTIVITY_FIRST_DAY, S.ACTIVITY_LAST_DAY)
    # The kept snapshot has a longer history than the log: a fifth of its rows lie four months back.
    prev = prev.withColumn("d", F.when(F.col("form_uid") % 5 == 0, F.add_months("d", -4)).otherwise(F.col("d")))
    return prev.withColumn("mmdd", C.month_day_string("d"))


def rolling_three_months(spark, sf_dir):
    f, m, s = _act(spark, sf_dir)
    return RF.raw_refresh(_long_history(spark, sf_dir), f, m, s, S.ACTIVITY_AS_OF)


def snapshot_meta(spark, sf_dir):
    return RF.snapshot_meta(_rows(spark, sf_dir), _backlog(spark, sf_dir), RUN_TS, NOW_TS)


def merge_kept_table(spark, sf_dir):
    """The day-slice merge on a written table: the previous rows are read from it, the day's partition replaced."""
    f, m, s = _act(spark, sf_dir)
    path = _scratch(spark, "kept-activity")
    M.write_day_partitions(_stale_rows(spark, sf_dir), path)
    day = S.ACTIVITY_AS_OF
    fresh = A.activity_day(f, m, s, day, day)
    M.replace_days(fresh, path, [day])
    return FS.read_previous(spark, path, fresh.schema)


def retained_three_months(spark, sf_dir):
    """The member-level table kept for three months by dropping day partitions."""
    f, m, s = _act(spark, sf_dir)
    path = _scratch(spark, "kept-raw")
    prev = _long_history(spark, sf_dir)
    M.write_day_partitions(prev, path)
    day = S.ACTIVITY_AS_OF
    M.replace_days(A.reachout_raw(f, m, s, day, day), path, [day])
    M.drop_old_days(spark, path, day)
    return FS.read_previous(spark, path, prev.schema)


def written_snapshot_meta(spark, sf_dir):
    """The snapshot's metadata as the write of its rows observed it."""
    observed = M.replace_days(_rows(spark, sf_dir), _scratch(spark, "observed-activity"), [])
    return RF.written_meta(observed, _backlog(spark, sf_dir).count(), spark, RUN_TS, NOW_TS)


def _extracts(spark, sf_dir, path: str) -> None:
    """One positional document per agent's backlog; the second agent's ends in the middle, and the third one's lists its rows under a name."""
    rows = _backlog(spark, sf_dir).select("ag", F.array(*[F.col(c).cast("variant") for c in RF.BACKLOG_SCHEMA.names]).alias("cells"))
    docs = rows.groupBy("ag").agg(F.to_json(F.collect_list("cells")).alias("value"))
    docs = docs.select("ag", F.when(F.col("ag") == "am.1", F.expr("left(value, length(value) - 5)"))
                       .when(F.col("ag") == "am.2", F.concat(F.lit('{"rows":'), "value", F.lit("}"))).otherwise(F.col("value")).alias("value"))
    docs.repartition("ag").write.partitionBy("ag").text(path)


def quarantined_backlog(spark, sf_dir):
    """Backlog extracts as files: rows of sound documents, and one row for each document that cannot be read."""
    path = _scratch(spark, "extracts")
    _extracts(spark, sf_dir, path)
    rows = FS.read_positional_quarantined(spark, path, RF.BACKLOG_SCHEMA)
    return rows.select(*RF.BACKLOG_SCHEMA.names, F.col(FS.CORRUPT).isNotNull().alias("quarantined"), F.regexp_extract(FS.SOURCE, "ag=([^/]*)/", 1).alias("source_agent"))


def backlog_after_bad_extract(spark, sf_dir):
    """The kept backlog after a refresh whose extract cannot be read: the previous one."""
    path, extracts = _scratch(spark, "kept-backlog"), _scratch(spark, "extracts")
    RF.refresh_backlog(spark, _backlog(spark, sf_dir), path)
    _extracts(spark, sf_dir, extracts)
    return RF.refresh_backlog(spark, RF.read_backlog_extract(spark, extracts), path)


def window_accounts(spark, sf_dir):
    f, m, _ = _act(spark, sf_dir)
    bits = A.account_bitmaps(f, m, S.ACTIVITY_FIRST_DAY, None)
    return T.window_accounts(A.created_activity(f, m, S.ACTIVITY_FIRST_DAY, None), bits, dt.date(2024, 1, 8), dt.date(2024, 1, 20))


def agent_funnel(spark, sf_dir):
    return T.agent_funnel(_rows(spark, sf_dir), _backlog(spark, sf_dir))


def agent_funnel_window(spark, sf_dir):
    win = T.window_rows(_rows(spark, sf_dir), dt.date(2024, 1, 8), dt.date(2024, 1, 20), bucket="Day 15")
    return _numbered(T.table_view(T.agent_funnel(win, _backlog(spark, sf_dir), bucket="Day 15")))


def touchpoint_pivot(spark, sf_dir):
    return T.touchpoint_pivot(_rows(spark, sf_dir))


def utility_breakdown(spark, sf_dir):
    return T.utility_breakdown(_rows(spark, sf_dir))


def disposition_breakdown(spark, sf_dir):
    return T.disposition_breakdown(_rows(spark, sf_dir))


def activity_kpis(spark, sf_dir):
    return T.activity_kpis(_rows(spark, sf_dir))


def date_presets(spark, sf_dir):
    return T.date_presets(_rows(spark, sf_dir))


def selector_values(spark, sf_dir):
    return T.selector_values(_rows(spark, sf_dir), _backlog(spark, sf_dir), _agent_day(spark, sf_dir))


QUERIES.update({
    "merge_day_slice": merge_day_slice,
    "merge_carry_forward": merge_carry_forward,
    "rolling_three_months": rolling_three_months,
    "merge_kept_table": merge_kept_table,
    "retained_three_months": retained_three_months,
    "quarantined_backlog": quarantined_backlog,
    "backlog_after_bad_extract": backlog_after_bad_extract,
    "window_accounts": window_accounts,
    "snapshot_meta": snapshot_meta,
    "written_snapshot_meta": written_snapshot_meta,
    "agent_funnel": agent_funnel,
    "agent_funnel_window": agent_funnel_window,
    "touchpoint_pivot": touchpoint_pivot,
    "utility_breakdown": utility_breakdown,
    "disposition_breakdown": disposition_breakdown,
    "activity_kpis": activity_kpis,
    "date_presets": date_presets,
    "selector_values": selector_values,
})


# ------------------------------------------------------------- ranking ---

_METRICS = ["first_response_secs", "every_chat_response_secs", "resolution_time_secs", "csat"]


def agent_ratings(spark, sf_dir):
    r = RK.rated(_agent_day(spark, sf_dir))
    r = r.select("d", "name", "pod", "total_bucket", "open_bucket", "resolved_cum", *_METRICS, "csat_n",
                 "r_frt", "r_art", "r_res", "r_csat", "r_vol", "score")
    return RK.rounded_out(r, _METRICS + ["score"])


def agent_scores_ranked(spark, sf_dir):
    r = RK.ranked(_agent_day(spark, sf_dir))
    return r.select("d", "name", "pod", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"),
                    C.duration_label("first_response_secs").alias("first_response_label"),
                    C.duration_label("every_chat_response_secs").alias("every_chat_label"),
                    F.when(F.col("csat").isNull(), F.lit("-")).otherwise(RK.fixed2(F.col("csat"))).alias("csat_label"))


def agent_ranks_of_pod(spark, sf_dir):
    day = _agent_day(spark, sf_dir).filter(F.col("d") == F.lit(dt.date(2024, 1, 12)))
    view = RK.sort_view(RK.ranked(day, pod="Postsales - Hindi", active_only=True), "csat")
    return _numbered(view.select("d", "name", "pod", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank")))


def agent_cumulative(spark, sf_dir):
    c = RK.cumulative(_agent_day(spark, sf_dir))
    c = c.select("name", "pod", "days", "total_bucket", "open_bucket", "resolved_cum", *_METRICS, "csat_n",
                 "r_frt", "r_art", "r_res", "r_csat", "r_vol", "score")
    return RK.rounded_out(c, ["total_bucket", "open_bucket", "resolved_cum"] + _METRICS + ["score"])


def ranking_cards(spark, sf_dir):
    return RK.cards(RK.ranked(_agent_day(spark, sf_dir)))


QUERIES.update({
    "agent_ratings": agent_ratings,
    "agent_scores_ranked": agent_scores_ranked,
    "agent_ranks_of_pod": agent_ranks_of_pod,
    "agent_cumulative": agent_cumulative,
    "ranking_cards": ranking_cards,
})


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)
