"""Per-row rules: band edges, code maps, in-call truth table, roundings, labels."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import codes
from ledgerline.functions import columns as C
from ledgerline.plans import activity as A
from ledgerline.plans.renewals import band


def one(spark, expr, schema="x int", rows=None):
    df = spark.createDataFrame(rows or [(None,)], schema)
    return [r[0] for r in df.select(expr.alias("v")).collect()]


def test_days_to_and_band_edges(spark):
    as_of = dt.date(1998, 6, 1)
    offsets = [-31, -30, -16, -15, 0, 1, 15, 16, None]
    rows = []
    for o in offsets:
        end = None if o is None else as_of + dt.timedelta(days=o)
        for flag in (True, False, None):
            rows.append((end, flag, o))
    df = spark.createDataFrame(rows, "end date, renewed boolean, o int")
    out = df.select("o", "renewed", band(C.days_to("end", as_of), F.col("renewed")).alias("b")).collect()
    expect = {-31: "overdue", -30: "grace_late", -16: "grace_late", -15: "grace_early", 0: "grace_early",
              1: "outreach", 15: "outreach", 16: "not_in_window", None: None}
    for r in out:
        if r.renewed is False:
            assert r.b == expect[r.o], r
        else:  # renewed or unknown flag: in no band (H1)
            assert r.b is None, r


def test_owner_default_and_nullif(spark):
    df = spark.createDataFrame([(None,), ("",), (" ",), ("x",)], "o string")
    assert [r[0] for r in df.select(C.owner_or_unassigned("o")).collect()] == ["Unassigned", "Unassigned", " ", "x"]
    assert [r[0] for r in df.select(C.empty_to_null("o")).collect()] == [None, None, " ", "x"]


def test_agent_of(spark):
    df = spark.createDataFrame([("am.1@x.io",), ("plain",), ("",), (None,)], "a string")
    assert [r[0] for r in df.select(C.agent_of("a")).collect()] == ["am.1", "plain", "", None]


def test_pretty_agent(spark):
    df = spark.createDataFrame([("riya.k_s",), ("aBc",), ("x..y",)], "a string")
    assert [r[0] for r in df.select(C.pretty_agent("a")).collect()] == ["Riya K S", "ABc", "X  Y"]


def test_mask(spark):
    df = spark.createDataFrame([("1234567890",), ("ab",), ("",), (None,)], "u string")
    assert [r[0] for r in df.select(C.mask_id("u")).collect()] == ["1234…890", "ab…ab", "-", "-"]


def test_bucket_label_and_code(spark):
    reasons = [r for r, _, _ in codes.REASONS] + ["BAD_CSAT_LOW", "BADxCSAT", "ENGMT_INACTIVE_ACCOUNT", "MISC", None]
    df = spark.createDataFrame([(r,) for r in reasons], "r string")
    got = df.select(C.bucket_label("r").alias("l"), C.bucket_code("r").alias("c"),
                    C.bucket_label(F.col("r")).alias("l2"), C.bucket_code(F.col("r")).alias("c2")).collect()
    labels = [x for _, x, _ in codes.REASONS] + ["Bad CSAT", "Bad CSAT", "Engagement (Inactive)", "Other", "Other"]
    nums = [x for _, _, x in codes.REASONS] + [6, 6, 7, 9, 9]
    assert [r.l for r in got] == labels and [r.l2 for r in got] == labels
    assert [r.c for r in got] == nums and [r.c2 for r in got] == nums


def test_outcome_and_utility_codes(spark):
    outs = ["INTERESTED", "INTERESTED_NSA", "DNP", "DNP_REALLOCATE", "RESCHEDULED", "DND", "IGNORED",
            "WAIT_AND_WATCH", "LANGUAGE_BARRIER", "OPEN_ND", "OPEN_REIMBURSEMENT", "NEW_THING", None]
    df = spark.createDataFrame([(o,) for o in outs], "o string")
    assert [r[0] for r in df.select(C.outcome_code("o")).collect()] == [0, 0, 1, 1, 2, 3, 4, 5, 6, 7, 7, 8, 8]
    claims = [None, "IN_HOUSE_CONSULT", "SCANNER", "HOME_COLLECTION", "NETWORK_VISIT", "OPD_VISIT", "REIMBURSEMENT", "DENTAL"]
    df = spark.createDataFrame([(c,) for c in claims], "c string")
    assert [r[0] for r in df.select(C.utility_code("c")).collect()] == [0, 1, 2, 3, 4, 4, 5, 6]
    flags = C.disposition_flags("o")
    assert set(flags) == set(codes.DISPOSITION_COLUMNS)


FORM_COLS = ["day75_booked", "day75_booking_id", "day75_hcu", "day150_booked", "day150_booking_id", "day150_hcu",
             "day15_info", "day210_info", "day270_info"]
SCHEMA = ("day75_booked boolean, day75_booking_id string, day75_hcu string, day150_booked boolean, "
          "day150_booking_id string, day150_hcu string, day15_info string, day210_info string, day270_info string")


def _in_call(spark, row):
    df = spark.createDataFrame([row], SCHEMA)
    return df.select(A.in_call_expr()).collect()[0][0]


def test_in_call_each_term_alone(spark):
    base = {c: None for c in FORM_COLS}
    cases = [("day75_booked", True), ("day150_booked", True), ("day75_booking_id", "b"), ("day150_booking_id", "b"),
             ("day75_hcu", "BOOK_ON_CALL"), ("day150_hcu", "BOOK_ON_CALL")]
    for g in ("day15_info", "day210_info", "day270_info"):
        cases += [(g, '{"booked_during_call":true}'), (g, '{"booking_id":"x"}'), (g, '{"hcu_booking":"BOOK_ON_CALL"}')]
    assert len(cases) == 15
    for col_name, value in cases:
        row = dict(base)
        row[col_name] = value
        assert _in_call(spark, tuple(row[c] for c in FORM_COLS)) is True, col_name


def test_in_call_null_semantics(spark):
    # all missing: the hcu terms are null, so the OR is null, not false
    assert _in_call(spark, tuple(None for _ in FORM_COLS)) is None
    # all empty strings / explicit non-booking values: false
    row = (False, "", "NO", False, "", "NO", '{"booking_id":"","hcu_booking":"NO","booked_during_call":false}',
           '{"hcu_booking":"NO"}', '{"hcu_booking":"NO","booking_id":null}')
    assert _in_call(spark, row) is False
    # JSON null is SQL null; "true" text is true
    row2 = (None, None, "NO", None, None, "NO", '{"booked_during_call":null,"hcu_booking":"NO"}',
            '{"hcu_booking":"NO"}', '{"hcu_booking":"NO"}')
    assert _in_call(spark, row2) is False


def test_percent_roundings(spark):
    df = spark.createDataFrame([(1225, 10000), (1, 0), (1, 3), (1, 8)], "n long, d long")
    half_even = [r[0] for r in df.select(C.pct_half_even("n", "d")).collect()]
    assert half_even == [12.2, 0.0, 33.3, 12.5]
    half_up = [r[0] for r in df.select(C.pct_half_up("n", "d")).collect()]
    assert half_up == [12.3, None, 33.3, 12.5]


def test_round_whole_half_away(spark):
    df = spark.createDataFrame([("2.5",), ("-2.5",), ("3.49",)], "x string")
    got = [r[0] for r in df.select(C.round_whole(F.col("x").cast("decimal(18,2)"))).collect()]
    assert got == [3, -3, 3]


def test_money_label(spark):
    vals = [None, 999, 1000, 1499, 1500, 99999, 100000, 150000, 9999999, 10000000, 12350000, 123456789]
    df = spark.createDataFrame([(v,) for v in vals], "n long")
    got = [r[0] for r in df.select(C.money_label("n")).collect()]
    assert got == ["-", "₹999", "₹1k", "₹1k", "₹2k", "₹100k", "₹1.0L", "₹1.5L", "₹100.0L", "₹1.00Cr", "₹1.24Cr", "₹12.35Cr"]


def test_duration_label(spark):
    vals = [None, 0.0, 59.4, 59.5, 60.0, 61.0, 125.2]
    df = spark.createDataFrame([(v,) for v in vals], "s double")
    got = [r[0] for r in df.select(C.duration_label("s")).collect()]
    assert got == ["-", "0s", "59s", "1m", "1m", "1m 1s", "2m 5s"]


def test_pct_class_and_minutes_since(spark):
    df = spark.createDataFrame([(50.0,), (49.9,), (30.0,), (29.9,)], "p double")
    assert [r[0] for r in df.select(C.pct_class("p")).collect()] == ["good", "warn", "warn", "bad"]
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    got = spark.range(1).select(
        C.minutes_since(C.ntz_literal(t0), C.ntz_literal(t0 + dt.timedelta(seconds=90))).alias("a"),
        C.minutes_since(C.ntz_literal(t0), C.ntz_literal(t0 - dt.timedelta(seconds=90))).alias("b")).collect()[0]
    assert got.a == 2 and got.b == 0


def test_local_day_bounds_and_zone(spark):
    lo, hi = C.utc_bounds(dt.date(2024, 1, 15), dt.date(2024, 1, 15), "Asia/Kolkata")
    assert lo == dt.datetime(2024, 1, 14, 18, 30) and hi == dt.datetime(2024, 1, 15, 18, 30)
    df = spark.createDataFrame([(dt.datetime(2024, 1, 14, 19, 0),)], "ts timestamp_ntz")
    got = df.select(C.local_date("ts", "Asia/Kolkata").alias("d"), C.local_date("ts").alias("u"),
                    C.in_local_days("ts", dt.date(2024, 1, 15), dt.date(2024, 1, 15), "Asia/Kolkata").alias("k")).collect()[0]
    assert got.d == dt.date(2024, 1, 15) and got.u == dt.date(2024, 1, 14) and got.k is True


def test_day_strings_month_start_and_days_since(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 5),)], "d date")
    r = df.select(C.day_string("d").alias("a"), C.month_day_string("d").alias("b"),
                  C.days_since("d", dt.date(2024, 3, 15)).alias("c")).collect()[0]
    assert (r.a, r.b, r.c) == ("2024-03-05", "03-05", 10)
    assert C.month_start(dt.date(2024, 3, 15)) == dt.date(2024, 3, 1)


def test_code_decoding(spark):
    df = spark.createDataFrame([(0,), (6,), (7,), (9,), (None,)], "c int")
    got = df.select(C.bucket_label_of_code("c").alias("b"), C.outcome_label_of_code("c").alias("o"),
                    C.utility_label_of_code("c").alias("u")).collect()
    assert [r.b for r in got] == ["Day 15", "Bad CSAT", "Engagement (Inactive)", None, None]
    assert [r.o for r in got][:3] == ["Interested", "Lang. Barrier", "Open"]
    assert [r.u for r in got][:2] == ["—", "Other"]


def test_in_call_junk_boolean_strict_and_tolerant(spark):
    import pytest

    row = (None, None, "NO", None, None, "NO", '{"booked_during_call":"maybe","hcu_booking":"NO"}',
           '{"hcu_booking":"NO"}', '{"hcu_booking":"NO"}')
    df = spark.createDataFrame([row], SCHEMA)
    with pytest.raises(Exception):
        df.select(A.in_call_expr()).collect()
    assert df.select(A.in_call_expr(tolerant=True)).collect()[0][0] is False
