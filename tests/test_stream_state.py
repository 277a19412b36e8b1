"""Keyed state of the stream: no scan of the log, replays, folding, repeats, and every batch equal to the whole."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.plans import activity as A
from ledgerline.sources import standins as S
from ledgerline.streaming import refresh as ST
from ledgerline.streaming import state as FS

ALL_DAYS = (dt.date(2023, 1, 1), dt.date(2025, 12, 31))


@pytest.fixture(scope="module")
def tables(spark):
    forms = S.reachout_forms(spark, SF_SMALL)
    return forms, S.members(spark, SF_SMALL), S.services(spark, SF_SMALL)


def _rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def _deliver(df, t, f):
    return df.withColumns({"__t": F.lit(t).cast("timestamp"), "__f": F.lit(f)})


def _state(spark, tables, path):
    _, member, services = tables
    return FS.FormState(spark, f"{path}/state", member, services, f"{path}/out", raw_path=f"{path}/raw", uid=tables[0].schema["uid"].dataType, buckets=4)


def _check(spark, tables, log, path):
    _, member, services = tables
    want = A.activity_day(log, member, services, *ALL_DAYS)
    assert _rows(spark.read.parquet(f"{path}/out"), want.columns) == _rows(want, want.columns)
    raw = A.reachout_raw(log, member, services, *ALL_DAYS)
    assert _rows(spark.read.parquet(f"{path}/raw"), raw.columns) == _rows(raw, raw.columns)


def test_versions_replays_and_folds(spark, tables, tmp_dir, monkeypatch):
    monkeypatch.setattr(FS, "FOLD", 2)
    forms = tables[0]
    few = forms.filter(F.col("uid") % 10 == 3)
    other = few.withColumns({"outcome": F.lit("DNP"), "is_draft": F.lit(False), "submitted_at": F.expr("created_at + INTERVAL 2 DAYS"), "day75_hcu": F.lit("BOOK_ON_CALL")})
    gone = few.withColumn("reason", F.lit("no such reason"))
    state = _state(spark, tables, tmp_dir)
    rest = forms.filter(F.col("uid") % 10 != 3)
    state.apply(_deliver(rest, "2024-02-01", "a"), 0)
    state.apply(_deliver(few, "2024-02-02", "b"), 1)
    _check(spark, tables, forms, tmp_dir)
    days = state.apply(_deliver(other, "2024-02-03", "c"), 2)
    _check(spark, tables, rest.unionByName(other), tmp_dir)
    assert days and state.apply(_deliver(other, "2024-02-03", "c"), 2) == days  # the same batch again adds nothing twice
    _check(spark, tables, rest.unionByName(other), tmp_dir)
    assert state.apply(_deliver(other, "2024-02-04", "d"), 3) == []             # a repeated file touches no day
    assert state.apply(_deliver(gone, "2024-01-01", "old"), 4) == []            # an older version that lands late changes nothing
    state.apply(_deliver(gone, "2024-02-05", "e"), 5)                           # unmapped: leaves every count
    _check(spark, tables, rest, tmp_dir)
    state.apply(_deliver(few, "2024-02-06", "f"), 6)                            # back to earlier content
    _check(spark, tables, forms, tmp_dir)
    state.apply(_deliver(few.limit(0), "2024-02-07", "g"), 7)
    parts = [p for _, dirs, _ in os.walk(f"{tmp_dir}/state/forms") for p in dirs]
    assert "whole=1" in parts and len([p for p in parts if p == "b=0"]) < 4     # folded, and older parts dropped
    assert state.apply(_deliver(forms.withColumn("uid", F.lit(None).cast("long")), "2024-02-08", "h"), 8) == []


def test_a_day_that_empties_and_fills_again(spark, tables, tmp_dir):
    forms = tables[0].filter(F.col("uid") % 7 == 1)
    away = forms.withColumns({"created_at": F.expr("created_at + INTERVAL 300 DAYS"), "is_draft": F.lit(True)})
    state = _state(spark, tables, tmp_dir)
    state.apply(_deliver(forms, "2024-02-01", "a"), 0)
    first = {p for p in os.listdir(f"{tmp_dir}/out") if p.startswith("d=")}
    state.apply(_deliver(away, "2024-02-02", "b"), 1)
    assert not first & {p for p in os.listdir(f"{tmp_dir}/out") if p.startswith("d=")}
    state.apply(_deliver(forms, "2024-02-03", "c"), 2)
    _check(spark, tables, forms, tmp_dir)


def test_a_batch_does_not_read_the_log(spark, tables, tmp_dir):
    """Files of earlier batches are taken away before the next batch; the answer still is that of the whole log."""
    forms, member, services = tables
    log, out = f"{tmp_dir}/log", f"{tmp_dir}/out"
    name = f"away{os.getpid()}"
    for k in range(3):
        forms.filter(F.col("uid") % 3 == k).coalesce(1).write.mode("append").parquet(log)
        ST.start_refresh(spark, log, forms.schema, member, services, out, name=name, raw_path=f"{tmp_dir}/raw", buckets=4).awaitTermination()
        for f in os.listdir(log):
            if f.endswith(".parquet"):
                os.truncate(os.path.join(log, f), 0)  # no longer a Parquet file: a scan would fail
    _check(spark, tables, forms, tmp_dir)


def test_repeats_are_dropped_in_the_stream(spark, tables, tmp_dir, monkeypatch):
    """With ``repeats_within``: a repeated file gives an empty batch, a new version passes."""
    forms, member, services = tables
    few = forms.filter(F.col("uid") % 20 == 1)
    sizes = []
    plain = FS.FormState.apply
    monkeypatch.setattr(FS.FormState, "apply", lambda self, batch, n: sizes.append(batch.count()) or plain(self, batch, n))
    for chunk in (few, few, few.withColumn("outcome", F.lit("DNP"))):
        chunk.coalesce(1).write.mode("append").parquet(f"{tmp_dir}/log")
        ST.start_refresh(spark, f"{tmp_dir}/log", forms.schema, member, services, f"{tmp_dir}/out", name=f"rep{os.getpid()}", repeats_within="7 days", buckets=4).awaitTermination()
    changed = few.filter(~F.col("outcome").eqNullSafe("DNP")).count()
    assert sizes[0] == few.count() and sum(sizes[1:]) == changed
    want = A.activity_day(few.withColumn("outcome", F.lit("DNP")), member, services, *ALL_DAYS)
    assert _rows(spark.read.parquet(f"{tmp_dir}/out"), want.columns) == _rows(want, want.columns)
