"""Refresh jobs: fresh slices merged into kept snapshots, plus metadata.

``previous`` snapshots are ordinarily read from the kept table (``sources.files
.read_previous``). For the registered queries they are rebuilt by Spark from
the log as it stood at an earlier ``cutoff`` (forms created before it), so the
merge replaces genuinely stale rows.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions import codes
from ..functions import columns as C
from ..operators import merge as M
from ..session import scratch_path
from ..sources import files as FS
from . import activity as A


def log_as_of(forms: DataFrame, cutoff: dt.datetime) -> DataFrame:
    """The form log as it stood at ``cutoff`` (forms created before it)."""
    return forms.filter(F.col("created_at") < C.ntz_literal(cutoff))


def day_slice_refresh(prev_rows: DataFrame, forms: DataFrame, member: DataFrame, services: DataFrame,
                      day: dt.date, tz: str = "UTC") -> DataFrame:
    """M1 on ``activity_day``: recompute ``day`` from the log and replace its slice."""
    fresh = A.activity_day(forms, member, services, day, day, tz)
    return M.replace_day_slices(prev_rows, fresh)


def carry_forward_refresh(prev_rows: DataFrame | None, forms: DataFrame, member: DataFrame,
                          month_start: dt.date | None = None, tz: str = "UTC", as_of: dt.date | None = None) -> DataFrame:
    """M4: month-to-date created and call rows rebuilt, utilisation carried. Without ``month_start`` the
    month is that of ``as_of`` (P14)."""
    month_start = month_start or C.month_start(as_of)
    created = A.created_activity(forms, member, month_start, None, tz)
    calls = A.call_activity(forms, month_start, None, tz)
    return M.rebuild_with_carry(created, calls, prev_rows)


def raw_refresh(prev_raw: DataFrame, forms: DataFrame, member: DataFrame, services: DataFrame,
                day: dt.date, tz: str = "UTC") -> DataFrame:
    """M2 + M3 on the member-level rows: replace ``day``, keep three months."""
    fresh = A.reachout_raw(forms, member, services, day, day, tz)
    return M.rolling_months(M.replace_day(prev_raw, fresh, day), day)


def written_meta(observed: dict, open_buckets: int, spark: SparkSession, run_ts: dt.datetime, now: dt.datetime | None = None) -> DataFrame:
    """SK6 + P25 from what the write of the rows observed (``replace_days``), without reading them again."""
    row = spark.createDataFrame([(observed["min_date"], observed["max_date"], observed["n_rows"], open_buckets)],
                                "min_date date, max_date date, n_rows long, open_buckets long")
    return _stamped(row, run_ts, now)


def _stamped(row: DataFrame, run_ts: dt.datetime, now: dt.datetime | None) -> DataFrame:
    run = C.ntz_literal(run_ts)
    local = F.convert_timezone(F.lit("UTC"), F.lit(codes.META_ZONE), run)
    row = row.withColumn("refreshed_at", F.concat(F.date_format(local, "dd MMM yyyy, hh:mm a"), F.lit(" IST")))
    return row.withColumn("minutes_since", C.minutes_since(run, C.ntz_literal(now or run_ts)))


def snapshot_meta(rows: DataFrame, backlog: DataFrame | None, run_ts: dt.datetime,
                  now: dt.datetime | None = None) -> DataFrame:
    """SK6 + P25: refreshed-at (IST text), min/max day, row count, open buckets,
    minutes since the refresh. ``run_ts`` and ``now`` are UTC and passed in, so
    the output is reproducible."""
    tagged = rows.select("d", F.lit(False).alias("is_open"))
    if backlog is not None:
        tagged = tagged.unionByName(backlog.select(F.lit(None).cast("date").alias("d"), F.lit(True).alias("is_open")))
    g = tagged.agg(F.min("d").alias("min_date"), F.max("d").alias("max_date"),
                   F.count_if(~F.col("is_open")).alias("n_rows"),
                   F.count_if(F.col("is_open")).alias("open_buckets"))
    return _stamped(g, run_ts, now)


BACKLOG_SCHEMA = StructType([StructField("ag", StringType()), StructField("bk", StringType()),
                             StructField("created_today_open", LongType()), StructField("overdue_open", LongType())])


def read_backlog_extract(spark: SparkSession, path: str) -> DataFrame | None:
    """The backlog of an extract file (positional rows), or None where the file is missing or any of it cannot be read."""
    rows = FS.read_positional_quarantined(spark, path, BACKLOG_SCHEMA)
    good, bad = FS.split_quarantine(rows)
    return good if FS.exists(spark, path) and bad.isEmpty() else None


def refresh_backlog(spark: SparkSession, fresh: DataFrame | None, path: str) -> DataFrame:
    """M5 as a job: the fresh backlog replaces the kept one when there is a fresh one; else the kept one stays.
    The new rows are written beside the old ones first, as they may be derived from them."""
    previous = FS.read_previous(spark, path, BACKLOG_SCHEMA)
    chosen = M.snapshot_or_previous(fresh, previous)
    if fresh is not None:
        kept = scratch_path(spark, f"backlog-{uuid.uuid4().hex}")
        chosen.select(*BACKLOG_SCHEMA.names).write.parquet(kept)
        spark.read.parquet(kept).write.mode("overwrite").parquet(path)
    return FS.read_previous(spark, path, BACKLOG_SCHEMA)


def refresh_activity_tables(forms: DataFrame, member: DataFrame, services: DataFrame, d1: dt.date,
                            d2: dt.date, as_of: dt.date, base_path: str, tz: str = "UTC",
                            backlog_extract: str | None = None, on_repeated_member: str = "first") -> dict:
    """E2 as a job: write ``activity_day`` (day partitions replaced), the days' account bitmaps and the open
    backlog snapshot as tables under ``base_path``; return their paths and what the write observed.

    ``backlog_extract``: take the backlog from this file, or keep the previous one where it cannot be read (M5).
    Members are reduced to one row per key first (H13, ``on_repeated_member``).

    Reports then read the written tables, which cuts the lineage: an executor
    lost later recomputes from the table, not from the log and the as-of join.
    """
    spark = forms.sparkSession
    base = base_path.rstrip("/")
    paths = {name: f"{base}/{name}" for name in ("activity_day", "account_days", "open_backlog")}
    member = A.unique_members(member, on_repeated_member)
    days = [d1 + dt.timedelta(days=k) for k in range((d2 - d1).days + 1)]
    observed = M.replace_days(A.activity_day(forms, member, services, d1, d2, tz), paths["activity_day"], days)
    M.replace_days(A.account_bitmaps(forms, member, d1, d2, tz), paths["account_days"], days)
    fresh = A.open_backlog(forms, as_of, tz) if backlog_extract is None else read_backlog_extract(spark, backlog_extract)
    refresh_backlog(spark, fresh, paths["open_backlog"])
    return paths | {"observed": observed}


def agent_report(spark, paths: dict, d_from: dt.date | None = None, d_to: dt.date | None = None,
                 agent: str = "ALL", bucket: str = "ALL") -> dict[str, DataFrame]:
    """E2 read side: every per-agent table over one window of the kept tables."""
    from . import agent_tables as T

    rows = spark.read.parquet(paths["activity_day"])
    backlog = FS.read_previous(spark, paths["open_backlog"], BACKLOG_SCHEMA)
    win = T.window_rows(rows, d_from, d_to, agent, bucket)
    return {"agent_funnel": T.agent_funnel(win, backlog, agent, bucket),
            "touchpoint_pivot": T.touchpoint_pivot(win),
            "utility_breakdown": T.utility_breakdown(win),
            "disposition_breakdown": T.disposition_breakdown(win),
            "activity_kpis": T.activity_kpis(win),
            "date_presets": T.date_presets(rows)}
