"""Rating band edges, weighted score, rank ties, cumulative weights."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.plans import ranking as RK


def ratings_of(spark, column, values, fn):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{column} double")
    return [r[0] for r in df.select(fn(column)).collect()]


def test_csat_edges(spark):
    vals = [4.5, 4.49, 4.3, 4.1, 3.75, 3.74, None]
    assert ratings_of(spark, "c", vals, RK.rate_csat) == [5, 4, 4, 3, 2, 1, 0]
    assert ratings_of(spark, "c", vals, lambda c: RK.rate_csat(c, "renormalise"))[-1] is None


def test_first_response_edges(spark):
    assert ratings_of(spark, "f", [30, 31, 45, 60, 90, 91, None], RK.rate_first_response) == [5, 4, 4, 3, 2, 1, None]


def test_every_chat_edges(spark):
    assert ratings_of(spark, "a", [90, 105, 120, 150, 151, None], RK.rate_every_chat) == [5, 4, 3, 2, 1, None]


def test_volume_edges(spark):
    assert ratings_of(spark, "v", [30, 31, 35, 40, 50, None], RK.rate_volume) == [1, 2, 3, 4, 5, None]


SCHEMA = ("d date, name string, pod string, total_bucket long, open_bucket long, resolved_cum long, "
          "first_response_secs double, every_chat_response_secs double, resolution_time_secs double, "
          "csat double, csat_n long")


def test_score_missing_csat_scores_zero(spark):
    d = dt.date(2024, 1, 1)
    rows = [(d, "a", "P", 50, 1, 1, 30.0, 90.0, 10.0, None, 0),      # all 5 but csat missing -> 0 at 50%
            (d, "b", "P", 50, 1, 1, 30.0, 90.0, 10.0, 4.6, 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.name: r.score for r in RK.rated(df).collect()}
    # weights frt .2 art .2 csat .5 vol .05 (res unrated): (1+1+0+0.25)/0.95
    assert abs(got["a"] - 2.25 / 0.95) < 1e-12
    assert abs(got["b"] - 5.0) < 1e-12
    renorm = {r.name: r.score for r in RK.rated(df, "renormalise").collect()}
    assert abs(renorm["a"] - 5.0) < 1e-12


def test_rank_ties_and_filters(spark):
    d = dt.date(2024, 1, 1)
    rows = [(d, "zed", "P1", 50, 0, 0, 30.0, 90.0, None, 4.6, 1),
            (d, "amy", "P1", 50, 0, 0, 30.0, 90.0, None, 4.6, 1),
            (d, "bob", "P2", 0, 0, 0, 100.0, 200.0, None, None, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.name: r.rank for r in RK.ranked(df).collect()}
    assert got == {"amy": 1, "zed": 2, "bob": 3}
    act = {r.name: r.rank for r in RK.ranked(df, active_only=True).collect()}
    assert act == {"amy": 1, "zed": 2}
    pod = {r.name: r.rank for r in RK.ranked(df, pod="P2").collect()}
    assert pod == {"bob": 1}
    order = [r.name for r in RK.sort_view(RK.ranked(df), "rank", descending=False).collect()]
    assert order == ["amy", "zed", "bob"]


def test_cumulative_weights(spark):
    rows = [(dt.date(2024, 1, 1), "a", "P", 10, 2, 1, 20.0, None, None, 4.0, 1),
            (dt.date(2024, 1, 2), "a", "P", 30, 4, 3, 40.0, 100.0, None, 5.0, 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    r = RK.cumulative(df).collect()[0]
    assert r.total_bucket == 20.0 and r.open_bucket == 3.0
    assert abs(r.first_response_secs - (20 * 10 + 40 * 30) / 40) < 1e-12
    assert abs(r.every_chat_response_secs - 100.0) < 1e-12          # null day's weight excluded
    assert abs(r.csat - (4.0 * 1 + 5.0 * 3) / 4) < 1e-12


def test_cards(spark):
    d = dt.date(2024, 1, 1)
    rows = [(d, n, "P", v, 1, 2, f, 90.0, None, c, 1) for n, v, f, c in
            [("a", 50, 30.0, 4.6), ("b", 40, 45.0, 4.2), ("c", 0, 200.0, None), ("e", 31, 61.0, 4.0)]]
    df = spark.createDataFrame(rows, SCHEMA)
    card = RK.cards(RK.ranked(df)).collect()[0]
    assert card.agents == 4 and card.total_chats == 121 and card.open_chats == 3 and card.resolved == 6
    assert card.top3.startswith("1. a (")
    assert abs(card.avg_first_response - (30 + 45 + 61) / 3) < 1e-6
    assert card.median_csat == 4.2 and card.is_default_day


def test_cumulative_zero_weight_is_null_not_error(spark):
    rows = [(dt.date(2024, 1, 1), "a", "P", 0, 0, 0, 20.0, None, None, 4.0, 0)]
    r = RK.cumulative(spark.createDataFrame(rows, SCHEMA)).collect()[0]
    assert r.first_response_secs is None and r.csat is None and r.r_csat == 0
