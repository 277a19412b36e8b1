"""Per-agent tables over a window of ``activity_day`` rows.

The input is the kept 25-column snapshot (one row per day x agent x
touchpoint) and the open-backlog snapshot; a window is a day range plus
optional agent and touchpoint filters (F9, ``ALL`` disables a filter). Every
table ends with an ``ALL`` row summing its columns (A19).
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes
from ..operators import bitmaps as B
from ..functions import columns as C


def slug(label: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", label.lower()).strip("_")


def window_rows(rows: DataFrame, d_from: dt.date | None = None, d_to: dt.date | None = None,
                agent: str = "ALL", bucket: str = "ALL") -> DataFrame:
    """rows in the day window, agent and touchpoint filters applied."""
    r = rows
    if d_from is not None:
        r = r.filter(F.col("d") >= F.lit(d_from))
    if d_to is not None:
        r = r.filter(F.col("d") <= F.lit(d_to))
    if agent != "ALL":
        r = r.filter(F.col("ag") == agent)
    if bucket != "ALL":
        r = r.filter(F.col("bk") == bucket)
    return r


def agent_totals(rows: DataFrame, measures: dict[str, F.Column], agent_col: str = "ag") -> DataFrame:
    """Per-agent sums of ``measures`` plus the ``ALL`` row, in one aggregation.

    Grouping sets ``(agent)`` and ``()`` over the detail rows; the measures are
    integer sums, so the total over rows equals the sum of the agent rows (A19).
    One constant seed row keeps the ``ALL`` row (zeros) when there are no rows.
    """
    names = list(measures)
    src = rows.select(F.col(agent_col).alias("agent"), *[c.cast("bigint").alias(n) for n, c in measures.items()],
                      F.lit(False).alias("__seed"))
    seed = rows.sparkSession.range(1).select(F.lit(None).cast("string").alias("agent"),
                                             *[F.lit(None).cast("bigint").alias(n) for n in names],
                                             F.lit(True).alias("__seed"))
    # The seed has a group of its own: rows without an agent are a group like any other.
    g = (src.unionByName(seed).groupingSets([["agent", "__seed"], []], "agent", "__seed")
         .agg(F.grouping("agent").alias("__g"), *[F.sum(n).alias(n) for n in names]))
    g = g.filter((F.col("__g") == 1) | ~F.coalesce("__seed", F.lit(False)))
    return g.select(F.when(F.col("__g") == 1, F.lit(codes.ALL)).otherwise(F.col("agent")).alias("agent"),
                    *[F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n) for n in names])


def agent_funnel(rows: DataFrame, backlog: DataFrame, agent: str = "ALL", bucket: str = "ALL") -> DataFrame:
    """A22 + J7: agents of the window or of the backlog; open today, overdue,
    total open, forms filled (= calls, H27), connected, utilities booked.

    The window rows and the backlog rows are tagged into one relation and
    aggregated once (no full outer join, no second aggregation for ALL)."""
    b = backlog
    if agent != "ALL":
        b = b.filter(F.col("ag") == agent)
    if bucket != "ALL":
        b = b.filter(F.col("bk") == bucket)
    zero = F.lit(0).cast("bigint")
    from_rows = rows.select("ag", zero.alias("ct"), zero.alias("od"), F.col("calls").alias("forms_filled"),
                            C.connected().alias("connected"), F.col("u_any").alias("booked"))
    from_backlog = b.select("ag", F.col("created_today_open").alias("ct"), F.col("overdue_open").alias("od"),
                            zero.alias("forms_filled"), zero.alias("connected"), zero.alias("booked"))
    t = agent_totals(from_rows.unionByName(from_backlog),
                     {c: F.col(c) for c in ["ct", "od", "forms_filled", "connected", "booked"]})
    return t.select("agent", F.col("ct").alias("open_today"), F.col("od").alias("overdue"),
                    (F.col("ct") + F.col("od")).alias("open_total"), "forms_filled", "connected", "booked")


def touchpoint_pivot(rows: DataFrame) -> DataFrame:
    """Accounts and utilities booked per touchpoint, fixed touchpoint order,
    with totals; missing cells are 0. Conditional sums over the fixed list, so
    one aggregation (``pivot`` would add a second)."""
    m: dict[str, F.Column] = {"accts_total": F.col("accts")}
    for b in codes.BUCKETS:
        m[f"accts_{slug(b)}"] = F.when(F.col("bk") == b, F.col("accts")).otherwise(0)
    m["booked_total"] = F.col("u_any")
    for b in codes.BUCKETS:
        m[f"booked_{slug(b)}"] = F.when(F.col("bk") == b, F.col("u_any")).otherwise(0)
    return agent_totals(rows.filter(F.col("bk").isin(codes.BUCKETS)), m)


def utility_breakdown(rows: DataFrame) -> DataFrame:
    """Utilities booked (any) and per service type, per agent."""
    return agent_totals(rows, {"booked": F.col("u_any"), **{u: F.col(u) for u in codes.UTILITY_COLUMNS}})


def disposition_breakdown(rows: DataFrame) -> DataFrame:
    """Connected and the nine dispositions per agent."""
    return agent_totals(rows, {"connected": C.connected(), **{c: F.col(c) for c in codes.DISPOSITION_COLUMNS}})


def activity_kpis(rows: DataFrame) -> DataFrame:
    """A20 + P17: accounts, booked, connected, connect % and booking % of
    connected (null when the base is 0)."""
    g = rows.agg(F.sum("accts").cast("bigint").alias("accounts"),
                 F.sum("u_any").cast("bigint").alias("booked"),
                 F.sum(C.connected()).cast("bigint").alias("connected"))
    g = g.select(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ["accounts", "booked", "connected"]])
    return g.select("accounts", "booked", "connected",
                    C.pct_half_up("connected", "accounts").alias("connected_pct"),
                    C.pct_half_up("booked", "connected").alias("booked_pct"))


def date_presets(rows: DataFrame) -> DataFrame:
    """D1-D4 (W3): today, month-to-date, previous day and last 7 as (from, to)
    over the distinct days present in the data (not calendar days).

    The distinct days are bounded by the calendar, so one small window over
    them is safe.
    """
    days = rows.select("d").distinct()
    ranked = days.select("d", F.row_number().over(Window.orderBy(F.col("d").desc())).alias("rn"))
    # "k-th latest, clamped to the earliest" (fewer than k days present).
    kth = lambda k: F.coalesce(F.max(F.when(F.col("rn") == k, F.col("d"))), F.min("d"))
    g = ranked.agg(F.max("d").alias("max_d"), kth(2).alias("prev_d"), kth(7).alias("seventh_d"))
    preset = lambda name, lo, hi: F.struct(F.lit(name).alias("preset"), lo.alias("d_from"), hi.alias("d_to"))
    presets = F.array(preset("today", F.col("max_d"), F.col("max_d")),
                      preset("mtd", F.trunc("max_d", "MM"), F.col("max_d")),
                      preset("yest", F.col("prev_d"), F.col("prev_d")),
                      preset("last7", F.col("seventh_d"), F.col("max_d")))
    return g.select(F.inline(presets))


def table_view(table: DataFrame, by: str = "booked") -> DataFrame:
    """Agents by a measure descending (booked; ``di`` for dispositions),
    the ``ALL`` row last."""
    return table.orderBy((F.col("agent") == "ALL").asc(), F.col(by).desc(), F.col("agent"))


def selector_values(rows: DataFrame, backlog: DataFrame, agent_day: DataFrame | None = None) -> DataFrame:
    """The sorted value lists the filters offer -- days, agents (window rows
    and backlog), touchpoints present and known pods (both in fixed order)."""
    item = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    listed = lambda df, *items: df.select(F.inline(F.array(*items)))
    agent, bucket = item("agent", F.col("ag")), item("touchpoint", F.col("bk"))
    # Each side is read once; its rows are reduced to distinct values before the shuffle.
    parts = (listed(rows, item("day", F.date_format("d", "yyyy-MM-dd")), agent, bucket).unionByName(listed(backlog, agent, bucket))
             .filter((F.col("kind") != "touchpoint") | F.col("value").isin(codes.BUCKETS)))
    if agent_day is not None:
        parts = parts.unionByName(agent_day.select(F.lit("pod").alias("kind"), F.col("pod").alias("value"))
                                  .filter(F.col("value").isin(codes.PODS)))
    fixed = {"touchpoint": codes.BUCKETS, "pod": codes.PODS}  # kinds whose order is fixed
    order = F.coalesce(*[F.when(F.col("kind") == kind, F.array_position(F.array(*[F.lit(v) for v in values]), F.col("value")))
                         for kind, values in fixed.items()])
    w = Window.partitionBy("kind").orderBy(order.asc_nulls_last(), F.col("value"))
    return parts.distinct().withColumn("pos", F.row_number().over(w).cast("bigint"))


def window_accounts(rows: DataFrame, bitmaps: DataFrame, d_from: dt.date | None = None, d_to: dt.date | None = None,
                    bucket: str = "ALL") -> DataFrame:
    """Per agent and for ``ALL``, over a window of days: the sum of the days' accounts, as the
    reports add them, and beside it the distinct accounts, from the bitmaps of the same days."""
    win, bits = (window_rows(x, d_from, d_to, bucket=bucket) for x in (rows, bitmaps))
    sums = agent_totals(win, {"accts_sum": F.col("accts")})
    ids = bits.select(F.col("ag").alias("agent"), B.BUCKET, B.BITS)
    # Per agent first, so the total joins a few bitmaps and not each day's.
    per_agent = B.union_of(ids, ["agent"])
    both = per_agent.withColumn("__all", F.lit(False)).unionByName(B.union_of(per_agent, []).select(F.lit(None).cast("string").alias("agent"), B.BUCKET, B.BITS, F.lit(True).alias("__all")))
    counted = both.groupBy("agent", "__all").agg(F.sum(F.bitmap_count(B.BITS)).alias("accts_distinct"))
    counted = counted.select(F.when(F.col("__all"), F.lit(codes.ALL)).otherwise(F.col("agent")).alias("__agent"), "accts_distinct")
    return (sums.join(counted, sums["agent"].eqNullSafe(counted["__agent"]), "left")
            .select("agent", "accts_sum", F.coalesce("accts_distinct", F.lit(0)).cast("bigint").alias("accts_distinct")))
