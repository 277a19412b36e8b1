"""Renewals: funnel, owner leaderboard, cycle retention, overdue watchlist.

Plan shape. The row-level table is scanned once into ``renewal_base`` (the
filters and the per-row band), then aggregated once into ``renewal_cube`` --
exact counts and exact decimal sums per (channel, owner, cycle). The funnel,
leaderboard and cycle reports are re-aggregations of that cube, whose size is
bounded by channels x owners x cycles, not by the data; rounding happens only
after the exact sums, per report group, as the source does. Only the watchlist
reads row level again (a top-k, planned as ``TakeOrderedAndProject``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import columns as C
from ..operators.rollup import rollup_rows, sum_of, with_rollup, zero_nulls

BANDS = ["not_in_window", "outreach", "grace_early", "grace_late", "overdue"]
FUNNEL_COUNTS = BANDS + ["renewed", "total"]
FUNNEL_SUMS = ["rupees_in_window", "rupees_overdue", "rupees_renewed"]
FUNNEL_KEYS = FUNNEL_COUNTS + FUNNEL_SUMS
LEADER_KEYS = ["total_accts", "renewed", "outreach", "grace", "overdue",
               "rupees_renewed", "rupees_overdue", "rupees_in_window"]
CYCLE_KEYS = ["total", "renewed", "old_premium", "renewed_amt"]


def band(d, is_renewed):
    """Status band of a non-renewed policy by days-to-end ``d``.

    Null when the policy is renewed, its flag is null, or ``d`` is null: such
    rows fall in no band but still count in ``total`` (H1).
    """
    not_renewed = is_renewed == F.lit(False)
    return (F.when(not_renewed & (d > 15), F.lit("not_in_window"))
            .when(not_renewed & d.between(1, 15), F.lit("outreach"))
            .when(not_renewed & d.between(-15, 0), F.lit("grace_early"))
            .when(not_renewed & d.between(-30, -16), F.lit("grace_late"))
            .when(not_renewed & (d < -30), F.lit("overdue")))


def renewal_base(retention: DataFrame, as_of: dt.date) -> DataFrame:
    """SC1 + P1-P5: kept channels and cycles, days to end, money defaults, band."""
    d = C.days_to("current_policy_end", as_of)
    return (retention
            .filter(F.col("year").between(codes.CYCLE_MIN, codes.CYCLE_MAX)
                    & F.col("channel").isin(codes.CHANNELS))
            .select("channel",
                    C.owner_or_unassigned("renewal_deal_owner").alias("owner"),
                    "is_renewed",
                    F.col("year").alias("cycle"),
                    d.alias("d"),
                    C.money_or_zero("current_policy_amount").alias("oldp"),
                    C.money_or_zero("renewed_amount").alias("renp"),
                    "account_uid",
                    "reason_for_not_renewing",
                    band(d, F.col("is_renewed")).alias("band")))


def renewal_cube(base: DataFrame) -> DataFrame:
    """Exact counts and sums per (channel, owner, cycle); sums stay null if empty (H4)."""
    b = F.col("band")
    renewed = F.col("is_renewed")
    in_window = b.isin("outreach", "grace_early", "grace_late")
    aggs = [F.count(F.lit(1)).alias("total"), F.count_if(renewed).alias("renewed")]
    aggs += [F.count_if(b == name).alias(f"n_{name}") for name in BANDS]
    aggs += [F.sum(F.when(in_window, F.col("oldp"))).alias("s_in_window"),
             F.sum(F.when(b == "overdue", F.col("oldp"))).alias("s_overdue"),
             F.sum(F.when(renewed, F.col("renp"))).alias("s_renewed"),
             F.sum("oldp").alias("s_old"),
             F.sum("renp").alias("s_ren")]
    return base.groupBy("channel", "owner", "cycle").agg(*aggs)


def _bigint_sum(c):
    return F.sum(c).cast("bigint")


def funnel(cube: DataFrame) -> DataFrame:
    """A5: per channel -- five exclusive bands, renewed, total and three rounded sums."""
    return (cube.groupBy("channel")
            .agg(*[_bigint_sum(f"n_{b}").alias(b) for b in BANDS],
                 _bigint_sum("renewed").alias("renewed"),
                 _bigint_sum("total").alias("total"),
                 C.round_whole(F.sum("s_in_window")).alias("rupees_in_window"),
                 C.round_whole(F.sum("s_overdue")).alias("rupees_overdue"),
                 C.round_whole(F.sum("s_renewed")).alias("rupees_renewed")))


def leaderboard(cube: DataFrame) -> DataFrame:
    """A6 + A7: per channel and owner, kept when in-window or renewed is non-zero."""
    g = (cube.groupBy("channel", "owner")
         .agg(_bigint_sum("total").alias("total_accts"),
              _bigint_sum("renewed").alias("renewed"),
              _bigint_sum("n_outreach").alias("outreach"),
              (_bigint_sum("n_grace_early") + _bigint_sum("n_grace_late")).alias("grace"),
              _bigint_sum("n_overdue").alias("overdue"),
              C.round_whole(F.sum("s_renewed")).alias("rupees_renewed"),
              C.round_whole(F.sum("s_overdue")).alias("rupees_overdue"),
              C.round_whole(F.sum("s_in_window")).alias("rupees_in_window"),
              (_bigint_sum("n_outreach") + _bigint_sum("n_grace_early")
               + _bigint_sum("n_grace_late")).alias("_in_window")))
    return g.filter((F.col("_in_window") > 0) | (F.col("renewed") > 0)).drop("_in_window")


def cycle_retention(cube: DataFrame) -> DataFrame:
    """Per channel and policy year -- total, renewed, rounded premiums."""
    return (cube.groupBy("channel", "cycle")
            .agg(_bigint_sum("total").alias("total"),
                 _bigint_sum("renewed").alias("renewed"),
                 C.round_whole(F.sum("s_old")).alias("old_premium"),
                 C.round_whole(F.sum("s_ren")).alias("renewed_amt")))


def watchlist(base: DataFrame, as_of: dt.date, size: int = codes.WATCHLIST_SIZE) -> DataFrame:
    """Global top-``size`` overdue accounts by rounded premium.

    The source orders by premium alone (ties undefined, H5); ``account_uid``
    breaks ties here. ``orderBy().limit()`` plans as a per-partition top-k plus
    one merge, never a full sort.
    """
    return (base.filter(F.col("band") == "overdue")
            .select("channel", "owner", "account_uid", "cycle",
                    (-F.col("d")).alias("days_overdue"),
                    C.round_whole("oldp").alias("old_premium"),
                    C.empty_to_null("reason_for_not_renewing").alias("reason"))
            .orderBy(F.col("old_premium").desc(), F.col("account_uid").asc())
            .limit(size))


# ------------------------------------------------------------ roll-ups ---

def funnel_all(funnel_df: DataFrame) -> DataFrame:
    """A13 + M6: channel rows with nulls zeroed, plus ``ALL`` = sum of the known
    channels' rounded values (H2, H6)."""
    z = zero_nulls(funnel_df, FUNNEL_KEYS)
    return with_rollup(z, "channel", [], FUNNEL_KEYS, keep_labels=codes.CHANNELS)


def leaderboard_all(leader_df: DataFrame) -> DataFrame:
    """A14 + P16: per-channel rows and per-owner ``ALL`` rows, with renewal %."""
    z = zero_nulls(leader_df, LEADER_KEYS)
    both = with_rollup(z, "channel", ["owner"], LEADER_KEYS)
    return both.withColumn("renewal_pct", C.pct_half_even("renewed", "total_accts"))


def cycle_all(cycle_df: DataFrame) -> DataFrame:
    """A15 + P16: per-channel rows and per-cycle ``ALL`` rows with both percents."""
    z = zero_nulls(cycle_df, CYCLE_KEYS)
    both = with_rollup(z, "channel", ["cycle"], CYCLE_KEYS)
    return (both.withColumn("acct_ret_pct", C.pct_half_even("renewed", "total"))
            .withColumn("rev_ret_pct", C.pct_half_even("renewed_amt", "old_premium")))


def with_classes(df: DataFrame, *percents: str) -> DataFrame:
    """Beside each percent its class, ``<name>_class``."""
    return df.withColumns({f"{p}_class": C.pct_class(p) for p in percents})


def watchlist_by_channel(watch_df: DataFrame) -> DataFrame:
    """The same top-k rows listed per channel and under ``ALL``, premium desc.

    The input holds at most ``WATCHLIST_SIZE`` rows, so the per-view window is
    bounded by construction.
    """
    from pyspark.sql import Window

    views = watch_df.select(
        F.explode(F.array(F.col("channel"), F.lit(codes.ALL))).alias("view"),
        "owner", "account_uid", "channel", "cycle",
        F.coalesce("days_overdue", F.lit(0)).alias("days_overdue"),
        F.coalesce("old_premium", F.lit(0).cast("bigint")).alias("old_premium"),
        F.coalesce("reason", F.lit("")).alias("reason"))
    w = Window.partitionBy("view").orderBy(F.col("old_premium").desc(), F.col("account_uid").asc())
    return views.withColumn("pos", F.row_number().over(w).cast("bigint"))


def pipeline_cards(funnel_all_df: DataFrame) -> DataFrame:
    """A30 + P22: the six funnel cards per channel view, as (card, value, amount).

    ``in_grace`` = grace_early + grace_late; amounts carry a money label.
    """
    f = funnel_all_df
    null_amt = F.lit(None).cast("bigint")
    cards = [
        ("total_book", F.col("total"), null_amt),
        ("renewed", F.col("renewed"), F.col("rupees_renewed")),
        ("outreach", F.col("outreach"), null_amt),
        ("in_grace", sum_of(["grace_early", "grace_late"]), F.col("rupees_in_window")),
        ("overdue", F.col("overdue"), F.col("rupees_overdue")),
        ("not_in_window", F.col("not_in_window"), null_amt),
    ]
    arr = F.array(*[F.struct(F.lit(i).alias("card_order"), F.lit(n).alias("card"),
                             v.cast("bigint").alias("value"), a.alias("amount"))
                    for i, (n, v, a) in enumerate(cards)])
    return (f.select("channel", F.explode(arr).alias("c"))
            .select("channel", "c.card_order", "c.card", "c.value", "c.amount",
                    C.money_label("c.amount").alias("amount_label")))


def renewals_refresh(retention: DataFrame, as_of: dt.date) -> dict[str, DataFrame]:
    """Every renewals table from one scan; the cube is persisted and shared."""
    base = renewal_base(retention, as_of)
    cube = renewal_cube(base).persist()
    f = funnel(cube)
    lb = leaderboard(cube)
    cy = cycle_retention(cube)
    wl = watchlist(base, as_of)
    fa = funnel_all(f)
    return {"funnel": fa, "leaderboard": leaderboard_all(lb), "cycle": cycle_all(cy),
            "watchlist": watchlist_by_channel(wl), "cards": pipeline_cards(fa), "_cube": cube}


__all__ = ["renewal_base", "renewal_cube", "funnel", "leaderboard", "cycle_retention", "watchlist",
           "funnel_all", "leaderboard_all", "cycle_all", "watchlist_by_channel", "pipeline_cards",
           "renewals_refresh", "rollup_rows"]


def renewals_meta(leader_all: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """SK6: owners of each channel view and the time of the refresh (UTC, passed in)."""
    generated = F.date_format(C.ntz_literal(run_ts), "yyyy-MM-dd HH:mm 'UTC'")
    return leader_all.groupBy("channel").agg(F.count(F.lit(1)).alias("owners")).withColumn("generated", generated)


# ------------------------------------------------------- read-side views ---

def select_channel(df: DataFrame, channel: str = codes.ALL) -> DataFrame:
    """one channel view (``ALL`` or a channel) of a rolled-up table."""
    return df.filter(F.col("channel") == channel)


def leaderboard_view(leader_all: DataFrame, channel: str = codes.ALL, sort_key: str = "total_accts",
                     descending: bool = True) -> DataFrame:
    """T4: owners of one channel view, by total (the builder's order) or any
    column (the page's default is renewal % descending); owner breaks ties."""
    k = F.col(sort_key)
    return select_channel(leader_all, channel).orderBy(k.desc() if descending else k.asc(), F.col("owner"))


def cycle_view(cycle_all_df: DataFrame, channel: str = codes.ALL) -> DataFrame:
    """T5: cycles of one channel view, ascending."""
    return select_channel(cycle_all_df, channel).orderBy("cycle")


def funnel_order(funnel_df: DataFrame) -> DataFrame:
    """Funnel by channel; leaderboard by channel, total desc; cycle by channel, year."""
    return funnel_df.orderBy("channel")
