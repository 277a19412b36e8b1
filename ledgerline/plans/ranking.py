"""Support-agent ranking (E3): rating bands, weighted score, rank, cards.

Input: ``agent_day`` rows (day x agent metrics). Everything is column
arithmetic plus one ranking window per day; the only per-group collections
are a day's top three and the exact CSAT median over a day's agents
(bounded by head count, not by data volume).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import columns as C

METRICS = ["first_response_secs", "every_chat_response_secs", "resolution_time_secs", "csat"]


def _band(v: Column, edges, higher_is_better: bool) -> Column:
    chain = None
    for edge, rating in edges:
        cond = v >= edge if higher_is_better else v <= edge
        chain = F.when(cond, F.lit(rating)) if chain is None else chain.when(cond, F.lit(rating))
    return F.when(v.isNull(), F.lit(None).cast("int")).otherwise(chain.otherwise(F.lit(1)))


def rate_csat(v: str | Column, missing: str = "zero") -> Column:
    """>=4.5 5, >=4.3 4, >=4.1 3, >=3.75 2, else 1; missing rates 0 (H7)
    unless ``missing='renormalise'`` (then null: its weight drops out)."""
    v = C.col(v)
    rated = _band(v, codes.CSAT_EDGES, True)
    return F.coalesce(rated, F.lit(0)) if missing == "zero" else rated


def rate_first_response(v: str | Column) -> Column:
    """R2: <=30 5, <=45 4, <=60 3, <=90 2, else 1; missing -> null."""
    return _band(C.col(v), codes.FRT_EDGES, False)


def rate_every_chat(v: str | Column) -> Column:
    """<=90 5, <=105 4, <=120 3, <=150 2, else 1; missing -> null."""
    return _band(C.col(v), codes.ART_EDGES, False)


def rate_volume(v: str | Column) -> Column:
    """R4 (on total in bucket, H8): >=50 5, >=40 4, >=35 3, >=31 2, else 1."""
    return _band(C.col(v), codes.VOL_EDGES, True)


def rate_resolution(v: str | Column) -> Column:
    """Bands pending -- always null."""
    return F.lit(None).cast("int")


def with_ratings(df: DataFrame, csat_missing: str = "zero") -> DataFrame:
    return df.select("*",
                     rate_first_response("first_response_secs").alias("r_frt"),
                     rate_every_chat("every_chat_response_secs").alias("r_art"),
                     rate_resolution("resolution_time_secs").alias("r_res"),
                     rate_csat("csat", csat_missing).alias("r_csat"),
                     rate_volume("total_bucket").alias("r_vol"))


def score(prefix: str = "r_") -> Column:
    """Sum of weight x rating over the rated metrics / sum of their weights;
    null when nothing is rated."""
    keys = ["frt", "art", "res", "csat", "vol"]
    num = None
    den = None
    for k in keys:
        r = F.col(prefix + k)
        w = F.lit(codes.WEIGHTS[k])
        n = F.coalesce(w * r, F.lit(0.0))
        d = F.when(r.isNotNull(), w).otherwise(F.lit(0.0))
        num = n if num is None else num + n
        den = d if den is None else den + d
    return F.when(den > 0, num / den)


def rated(df: DataFrame, csat_missing: str = "zero") -> DataFrame:
    r = with_ratings(df, csat_missing)
    return r.withColumn("score", score())


def filtered(df: DataFrame, pod: str = "All", active_only: bool = False) -> DataFrame:
    """pod selection and active-only (total in bucket > 0)."""
    if pod != "All":
        df = df.filter(F.col("pod") == pod)
    if active_only:
        df = df.filter(F.coalesce(F.col("total_bucket"), F.lit(0)) > 0)
    return df


def ranked(df: DataFrame, pod: str = "All", active_only: bool = False) -> DataFrame:
    """Rank 1..n by score desc among the shown agents of each day; ties
    broken by name (the source keeps input order)."""
    r = filtered(rated(df), pod, active_only)
    w = Window.partitionBy("d").orderBy(F.col("score").desc_nulls_last(), F.col("name").asc())
    return r.withColumn("rank", F.when(F.col("score").isNotNull(), F.row_number().over(w)))


def sort_view(df: DataFrame, key: str, descending: bool = True) -> DataFrame:
    """Sort by any column; missing values sort as -1e9 (rank: +1e9)."""
    fill = F.lit(1e9) if key == "rank" else F.lit(-1e9)
    k = F.coalesce(F.col(key).cast("double"), fill) if dict(df.dtypes)[key] != "string" else F.col(key)
    return df.orderBy(k.desc() if descending else k.asc(), F.col("name").asc())


def cumulative(df: DataFrame) -> DataFrame:
    """One row per agent over all days. Each metric is volume-weighted
    (weight = total in bucket; CSAT weighted by its rating count), volumes are
    per-day averages; then rated and scored like a day."""
    w = F.col("total_bucket")

    def wavg(metric: str, weight: Column) -> Column:
        m = F.col(metric)
        # a zero total weight gives null, not a division error
        return F.try_divide(F.sum(m * weight), F.sum(F.when(m.isNotNull(), weight)))

    g = df.groupBy("name").agg(
        F.max("pod").alias("pod"),
        F.count(F.lit(1)).alias("days"),
        F.avg("total_bucket").alias("total_bucket"),
        F.avg("open_bucket").alias("open_bucket"),
        F.avg("resolved_cum").alias("resolved_cum"),
        wavg("first_response_secs", w).alias("first_response_secs"),
        wavg("every_chat_response_secs", w).alias("every_chat_response_secs"),
        wavg("resolution_time_secs", w).alias("resolution_time_secs"),
        wavg("csat", F.col("csat_n")).alias("csat"),
        F.sum("csat_n").alias("csat_n"))
    return rated(g)


def cards(ranked_df: DataFrame) -> DataFrame:
    """Per day -- agents ranked, top three, mean first
    response and every-chat time (labels), mean and median CSAT, totals over
    active agents, mean score, and whether it is the default (latest) day."""
    active = F.coalesce(F.col("total_bucket"), F.lit(0)) > 0
    on_active = lambda c: F.when(active, F.col(c))
    top = F.when(F.col("rank") <= 3, F.struct("rank", "name", "score"))
    g = ranked_df.groupBy("d").agg(
        F.count("rank").alias("agents"),
        F.sort_array(F.collect_list(top)).alias("_top"),
        F.avg(on_active("first_response_secs")).alias("avg_first_response"),
        F.avg(on_active("every_chat_response_secs")).alias("avg_every_chat"),
        F.avg(on_active("csat")).alias("avg_csat"),
        F.median(on_active("csat")).alias("median_csat"),
        F.sum(F.when(active, F.col("total_bucket")).otherwise(0)).cast("bigint").alias("total_chats"),
        F.sum(F.when(active, F.coalesce("open_bucket", F.lit(0))).otherwise(0)).cast("bigint").alias("open_chats"),
        F.sum(F.when(active, F.coalesce("resolved_cum", F.lit(0))).otherwise(0)).cast("bigint").alias("resolved"),
        F.avg(F.when(F.col("rank").isNotNull(), F.col("score"))).alias("avg_score"))
    top3 = F.array_join(F.transform("_top", lambda t: F.concat(
        t["rank"].cast("string"), F.lit(". "), t["name"], F.lit(" ("), fixed2(t["score"]), F.lit(")"))), "; ")
    latest = F.max("d").over(Window.partitionBy())
    return g.select(
        "d", "agents", top3.alias("top3"),
        F.round("avg_first_response", 6).alias("avg_first_response"),
        C.duration_label(F.floor(F.col("avg_first_response") + 0.5)).alias("avg_first_response_label"),
        F.round("avg_every_chat", 6).alias("avg_every_chat"),
        C.duration_label(F.floor(F.col("avg_every_chat") + 0.5)).alias("avg_every_chat_label"),
        F.round("avg_csat", 6).alias("avg_csat"),
        F.round("median_csat", 6).alias("median_csat"),
        "total_chats", "open_chats", "resolved",
        F.round("avg_score", 6).alias("avg_score"),
        (F.col("d") == latest).alias("is_default_day"))


def fixed2(x: Column) -> Column:
    """Two-decimal text (``toFixed(2)`` on the value)."""
    return C.fixed_text(x, 2)


def rounded_out(df: DataFrame, cols: list[str]) -> DataFrame:
    """Round double metrics to 6 places for stable comparisons."""
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])
