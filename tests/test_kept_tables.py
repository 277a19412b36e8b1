"""Kept tables: retention by partition, clustered writes, observed metadata, quarantine, backlog fallback, member keys, SQL range function."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from conftest import SF_SMALL
from ledgerline.operators import merge as M
from ledgerline.plans import activity as A
from ledgerline.plans import refresh as RF
from ledgerline.sources import files as FS
from ledgerline.sources import standins as S


def _stamps(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_retention_drops_partitions_and_rewrites_none(spark, tmp_dir):
    """January: the kept months are November to January, of these years only; the table then equals the row rule."""
    days = [dt.date(2022, 12, 31), dt.date(2023, 1, 15), dt.date(2023, 10, 31), dt.date(2023, 11, 1), dt.date(2024, 1, 9), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]
    rows = spark.createDataFrame([(d, k) for k, d in enumerate(days)] + [(None, 99)], "d date, n long")
    path = os.path.join(tmp_dir, "t")
    M.write_day_partitions(rows, path)
    before = _stamps(path)
    as_of = dt.date(2024, 1, 9)
    dropped = M.drop_old_days(spark, path, as_of)
    assert dropped == [days[0], days[1], days[2], days[6]] and M.drop_old_days(spark, path, as_of) == []
    after = _stamps(path)
    assert after and all(before[f] == t for f, t in after.items())
    kept = {(r.d, r.n) for r in spark.read.schema(rows.schema).parquet(path).collect()}
    assert kept == {tuple(r) for r in M.rolling_months(rows, as_of).collect()}
    assert M.drop_old_days(spark, os.path.join(tmp_dir, "missing"), as_of) == []


def _rows_scanned(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_clustered_table_skips_row_groups(spark, tmp_dir):
    """A filter on an agent reads a few row groups of the clustered table, and most of a plain one."""
    n = 200_000
    rows = spark.range(n).selectExpr("DATE '2024-01-01' AS d", "concat('am.', CAST(pmod(xxhash64(id), 400) AS STRING)) AS ag",
                                     "concat('b', CAST(id % 5 AS STRING)) AS bk", "id AS n", "repeat(CAST(xxhash64(id, 1) AS STRING), 6) AS x")
    plain, clustered = os.path.join(tmp_dir, "p"), os.path.join(tmp_dir, "c")
    rows.write.partitionBy("d").option("parquet.block.size", 1 << 16).parquet(plain)
    M.write_clustered(rows, clustered, row_group_bytes=1 << 16)
    want = lambda path: spark.read.parquet(path).filter("ag = 'am.17'")
    assert want(clustered).count() == want(plain).count() == rows.filter("ag = 'am.17'").count()
    assert _rows_scanned(want(clustered)) < n / 10 < n / 2 < _rows_scanned(want(plain))
    # An agent between the bounds of a row group, but in none: the bloom filter tells.
    none = spark.read.parquet(clustered).filter("ag = 'am.17x'")
    assert _rows_scanned(none) == 0
    M.write_clustered(rows.limit(10).withColumn("d", F.lit(dt.date(2024, 1, 2))), clustered)
    assert spark.read.parquet(clustered).count() == n + 10  # other days stay


def test_write_observes_its_metadata(spark, tmp_dir):
    rows = spark.createDataFrame([(dt.date(2024, 1, 3), 1), (dt.date(2024, 1, 5), 2), (dt.date(2024, 1, 5), 3)], "d date, n long")
    seen = M.replace_days(rows, os.path.join(tmp_dir, "t"), [dt.date(2024, 1, d) for d in range(3, 7)])
    assert seen == {"n_rows": 3, "min_date": dt.date(2024, 1, 3), "max_date": dt.date(2024, 1, 5)}
    nothing = M.replace_days(rows.limit(0), os.path.join(tmp_dir, "t"), [dt.date(2024, 1, 5)])
    assert nothing == {"n_rows": 0, "min_date": None, "max_date": None}
    assert M.day_folders(spark, os.path.join(tmp_dir, "t")) == [dt.date(2024, 1, 3)]
    plan = RF.written_meta(seen, 4, spark, dt.datetime(2024, 1, 5, 18, 30))._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Aggregate" not in plan


SCHEMA = StructType([StructField("d", DateType()), StructField("ag", StringType()), StructField("n", LongType())])


def _files(base, **texts):
    os.makedirs(base)
    for name, text in texts.items():
        with open(os.path.join(base, f"{name}.json"), "w") as f:
            f.write(text)
    return base


def test_quarantine_keeps_what_cannot_be_read(spark, tmp_dir):
    path = _files(os.path.join(tmp_dir, "x"), a='[["2024-01-01","am.1",3],["2024-01-02",null,null],["x","am.3",1],5,["2024-01-04","z"],null]',
                  b="[[1,", c='{"a":1}', e="[]", n="null", s='"text"')
    rows = FS.read_positional_quarantined(spark, path, SCHEMA)
    good, bad = FS.split_quarantine(rows)
    assert sorted(map(tuple, good.collect()), key=repr) == sorted(
        [(dt.date(2024, 1, 1), "am.1", 3), (dt.date(2024, 1, 2), None, None), (dt.date(2024, 1, 4), "z", None)], key=repr)
    assert sorted((r[FS.CORRUPT], os.path.basename(r[FS.SOURCE])) for r in bad.collect()) == sorted(
        [('["x","am.3",1]', "a.json"), ("5", "a.json"), ("null", "a.json"), ("[[1,", "b.json"), ('{"a":1}', "c.json"), ("null", "n.json"), ('"text"', "s.json")])
    missing = FS.read_positional_quarantined(spark, os.path.join(tmp_dir, "none"), SCHEMA)
    assert missing.count() == 0 and missing.columns == rows.columns


def test_backlog_falls_back_to_the_previous(spark, tmp_dir):
    kept = os.path.join(tmp_dir, "kept")
    read = lambda p: RF.read_backlog_extract(spark, p)
    first = _files(os.path.join(tmp_dir, "1"), a='[["am.1","Day 15",2,3]]')
    assert [tuple(r) for r in RF.refresh_backlog(spark, read(first), kept).collect()] == [("am.1", "Day 15", 2, 3)]
    for bad in (_files(os.path.join(tmp_dir, "2"), a='[["am.1","Day 15",2'), os.path.join(tmp_dir, "none"), _files(os.path.join(tmp_dir, "3"), a='{"rows":[]}')):
        assert read(bad) is None
        assert [tuple(r) for r in RF.refresh_backlog(spark, read(bad), kept).collect()] == [("am.1", "Day 15", 2, 3)]
    assert RF.refresh_backlog(spark, read(_files(os.path.join(tmp_dir, "4"), a="[]")), kept).count() == 0  # a list without rows is a fresh snapshot
    old = spark.read.schema(RF.BACKLOG_SCHEMA).parquet(kept)
    more = old.unionByName(spark.createDataFrame([("am.2", "Day 15", 1, 0)], RF.BACKLOG_SCHEMA))
    assert RF.refresh_backlog(spark, more, kept).count() == 1  # rows that come from the kept table itself


def test_refresh_job_reduces_members_and_observes(spark, tmp_dir):
    forms, member, services = S.reachout_forms(spark, SF_SMALL), S.members(spark, SF_SMALL), S.services(spark, SF_SMALL)
    days = (S.ACTIVITY_FIRST_DAY, S.ACTIVITY_LAST_DAY)
    twice = member.unionByName(member.withColumn("mobile", F.lit("0")))
    bad = _files(os.path.join(tmp_dir, "bad"), a="[[")
    out = RF.refresh_activity_tables(forms, twice, services, *days, S.ACTIVITY_AS_OF, os.path.join(tmp_dir, "out"), backlog_extract=bad)
    want = A.activity_day(forms, member, services, *days)
    got = spark.read.parquet(out["activity_day"]).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert out["observed"]["n_rows"] == want.count()
    assert not os.path.exists(out["open_backlog"])  # no fresh backlog, and none before: reports show no open forms
    assert all(r.open_total == 0 for r in RF.agent_report(spark, out)["agent_funnel"].collect())
    assert {r.ag for r in spark.read.parquet(out["account_days"]).select("ag").distinct().collect()}


def test_repeated_member_keys(spark):
    forms, services = S.reachout_forms(spark, SF_SMALL), S.services(spark, SF_SMALL)
    member = S.members(spark, SF_SMALL)
    twice = member.unionByName(member.withColumns({"account_uid": F.lit(None).cast("bigint"), "mobile": F.lit("1")})).unionByName(member)
    days = (S.ACTIVITY_FIRST_DAY, S.ACTIVITY_LAST_DAY)
    plain = sorted(map(tuple, A.reachout_raw(forms, member, services, *days).collect()))
    once = A.unique_members(twice)
    assert once.columns == member.columns
    assert sorted(map(tuple, A.reachout_raw(forms, once, services, *days).collect())) == plain
    assert A.reachout_raw(forms, twice, services, *days).count() > len(plain)     # what the rule prevents
    assert sorted(map(tuple, A.unique_members(member, "error").collect()), key=repr) == sorted(map(tuple, member.collect()), key=repr)
    with pytest.raises(Exception, match="REPEATED_MEMBER_KEY"):
        A.reachout_raw(forms, A.unique_members(twice, "error"), services, *days).collect()
    some = spark.createDataFrame([(1, None, "5", "x"), (1, 9, "4", "y"), (1, 7, "9", "z"), (1, 7, "8", "w"), (None, 1, "1", "n")],
                                 "individual_uid long, account_uid long, mobile string, full_name string")
    assert [tuple(r) for r in A.unique_members(some).collect()] == [(1, 7, "8", "w")]


def test_range_function_bounds_reach_the_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.range(40).selectExpr("date_add(DATE '2024-01-01', CAST(id AS INT)) AS d", "id AS n").write.parquet(path)
    kept = spark.read.parquet(path)
    kept.createOrReplaceTempView("kept_days")
    FS.create_range_function(spark, "days_between", "kept_days", kept.schema)
    q = FS.read_range_sql(spark, "SELECT * FROM days_between(:d1, :d2)", dt.date(2024, 1, 3), dt.date(2024, 1, 5))
    assert sorted(r.n for r in q.collect()) == [2, 3, 4]
    assert "GreaterThanOrEqual(d,2024-01-03)" in q._jdf.queryExecution().executedPlan().toString()
