"""Filtered distinct counts and the merge laws."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerline.functions import codes
from ledgerline.operators import merge as M
from ledgerline.operators.distinct import distinct_counts


def test_distinct_counts_equal_sql_filter(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("ab"), rnd.randint(0, 30), rnd.choice([True, False, None]), rnd.choice([1, 2, None]))
            for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, e long, f boolean, g int")
    df.createOrReplaceTempView("dc")
    want = spark.sql("""SELECT k, COUNT(DISTINCT e) AS total, COUNT(DISTINCT e) FILTER (WHERE f) AS f,
                        COUNT(DISTINCT e) FILTER (WHERE g = 1) AS g1 FROM dc GROUP BY k""").collect()
    got = distinct_counts(df, ["k"], "e", {"f": F.col("f"), "g1": F.col("g") == 1}, total="total").collect()
    assert sorted(map(tuple, want)) == sorted((r.k, r.total, r.f, r.g1) for r in got)


ROWS = "d date, ag string, bk string, n long"


def _rows(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def test_day_slice_laws(spark):
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    prev = _rows(spark, [(d1, "a", "x", 1), (d2, "a", "x", 2)])
    a = _rows(spark, [(d2, "a", "x", 20), (d2, "b", "x", 21)])
    b = _rows(spark, [(d3, "a", "x", 30)])
    once = M.replace_day_slices(prev, a)
    twice = M.replace_day_slices(once, a)
    assert _set(once) == _set(twice)                          # idempotent
    ab = M.replace_day_slices(M.replace_day_slices(prev, a), b)
    ba = M.replace_day_slices(M.replace_day_slices(prev, b), a)
    assert _set(ab) == _set(ba)                               # order of distinct days does not matter
    empty = _rows(spark, [])
    assert _set(M.replace_day_slices(prev, empty)) == _set(prev)   # empty slice: unchanged
    assert _set(once) == [(d1, "a", "x", 1), (d2, "a", "x", 20), (d2, "b", "x", 21)]


def test_replace_day_drops_even_when_empty(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    prev = _rows(spark, [(d1, "a", "x", 1), (d2, "a", "x", 2)])
    out = M.replace_day(prev, _rows(spark, []), d2)
    assert _set(out) == [(d1, "a", "x", 1)]


def test_rolling_months_january(spark):
    days = [dt.date(2023, 10, 31), dt.date(2023, 11, 1), dt.date(2023, 12, 15), dt.date(2024, 1, 31),
            dt.date(2024, 2, 1), dt.date(2023, 1, 10)]
    df = _rows(spark, [(d, "a", "x", 1) for d in days])
    kept = sorted(r.d for r in M.rolling_months(df, dt.date(2024, 1, 15)).collect())
    assert kept == [dt.date(2023, 11, 1), dt.date(2023, 12, 15), dt.date(2024, 1, 31)]


def test_rebuild_with_carry(spark):
    d = dt.date(2024, 1, 2)
    created = spark.createDataFrame([(d, "a", "x", 3, 1, 4)], "d date, ag string, bk string, accts long, pending long, forms long")
    call_cols = ", ".join(f"{c} long" for c in ["calls", "bookings"] + codes.DISPOSITION_COLUMNS)
    calls = spark.createDataFrame([(d, "b", "x", 5, 1) + (1,) * 9], f"d date, ag string, bk string, {call_cols}")
    prev_cols = ", ".join(f"{c} long" for c in codes.ACTIVITY_MEASURES)
    prev = spark.createDataFrame(
        [(d, "a", "x") + tuple(range(22)), (dt.date(2024, 1, 1), "z", "x") + (9,) * 22],
        f"d date, ag string, bk string, {prev_cols}")
    out = {r.ag: r for r in M.rebuild_with_carry(created, calls, prev).collect()}
    assert set(out) == {"a", "b"}                      # keys = fresh keys only (prev-only 'z' dropped)
    assert out["a"].accts == 3 and out["a"].calls == 0
    assert out["a"].u_tele == 5 and out["a"].u_any == 12   # carried: prev measures 5..12
    assert out["b"].u_any == 0 and out["b"].calls == 5
    assert len(out["a"]) == 25
    assert M.snapshot_or_previous(None, prev) is prev
