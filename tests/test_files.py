"""File-edge readers and export sinks."""

import csv
import datetime as dt
import glob
import os

from pyspark.sql.types import LongType, StringType, StructField, StructType, DateType

from ledgerline.sources import files as FS
from ledgerline.sources import sinks as SK


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_row_map_reader_orders_by_int_key_and_unwraps(spark, tmp_dir):
    schema = StructType([StructField("channel", StringType()), StructField("total", LongType())])
    p = write(os.path.join(tmp_dir, "a.json"),
              '{"10":{"channel":"C","total":3},"2":{"channel":"B","total":null},"1":{"channel":"A","total":1}}')
    rows = FS.read_row_map(spark, p, schema).collect()
    assert [(r.channel, r.total, r.row_key) for r in rows] == [("A", 1, 1), ("B", None, 2), ("C", 3, 10)]
    q = write(os.path.join(tmp_dir, "b.json"), '{"data":{"0":{"channel":"X","total":7}}}')
    assert [(r.channel, r.total) for r in FS.read_row_map(spark, q, schema).collect()] == [("X", 7)]


def test_positional_reader_is_tolerant(spark, tmp_dir):
    schema = StructType([StructField("d", StringType()), StructField("ag", StringType()),
                         StructField("bk", StringType()), StructField("accts", LongType())])
    good = write(os.path.join(tmp_dir, "good.json"), '[["2024-01-01","am.1","Day 15",3],["2024-01-02","am.2","Day 75",null]]')
    got = FS.read_positional_rows(spark, good, schema).collect()
    assert [tuple(r) for r in got] == [("2024-01-01", "am.1", "Day 15", 3), ("2024-01-02", "am.2", "Day 75", None)]
    bad = write(os.path.join(tmp_dir, "bad.json"), "not json")
    notlist = write(os.path.join(tmp_dir, "obj.json"), '{"rows": 1}')
    for p in (bad, notlist, os.path.join(tmp_dir, "missing.json")):
        df = FS.read_positional_rows(spark, p, schema)
        assert df.count() == 0 and df.schema == schema


def test_read_previous_empty_then_written(spark, tmp_dir):
    schema = StructType([StructField("d", DateType()), StructField("n", LongType())])
    path = os.path.join(tmp_dir, "kept")
    assert FS.read_previous(spark, path, schema).count() == 0
    spark.createDataFrame([(dt.date(2024, 1, 1), 1)], schema).write.parquet(path)
    assert FS.read_previous(spark, path, schema).count() == 1


def test_day_partition_overwrite_replaces_only_present_days(spark, tmp_dir):
    from ledgerline.operators.merge import write_day_partitions

    path = os.path.join(tmp_dir, "t")
    s = "d date, n long"
    write_day_partitions(spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 2)], s), path)
    write_day_partitions(spark.createDataFrame([(dt.date(2024, 1, 2), 20)], s), path)
    got = sorted((r.d, r.n) for r in spark.read.parquet(path).collect())
    assert got == [(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 20)]


def test_csv_export_quotes_rfc(spark, tmp_dir):
    raw = spark.createDataFrame(
        [(dt.date(2024, 1, 5), "am.1", "98,76", 'A "B"\nC', 6, 8, None, 0),
         (dt.date(2024, 1, 6), "am.2", None, None, 0, 0, 1, 4)],
        "d date, agent string, mobile string, full_name string, bucket_code int, outcome_code int, in_call int, util_code int")
    out = os.path.join(tmp_dir, "csv")
    SK.write_csv(SK.raw_csv_frame(raw).coalesce(1), out)
    part = glob.glob(os.path.join(out, "part-*.csv"))[0]
    with open(part, newline="") as f:
        rows = list(csv.reader(f))
    assert rows[0] == ["date", "account_manager", "mobile", "member", "touchpoint", "disposition",
                       "booked_on_call", "utility_booked"]
    assert rows[1] == ["2024-01-05", "am.1", "98,76", 'A "B"\nC', "Bad CSAT", "No outcome", "no", ""]
    assert rows[2] == ["2024-01-06", "am.2", "", "", "Day 15", "Interested", "yes", "Clinic / Network visit"]


def test_positional_json_rows(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "am.1", "Day 15", 3, None)],
                               "d date, ag string, bk string, n long, x long")
    assert SK.positional_json(df).collect()[0].value == '["2024-01-01","am.1","Day 15",3,null]'


def test_range_sql_binds_parameters(spark):
    spark.createDataFrame([(dt.date(2024, 1, d), d) for d in range(1, 11)], "d date, n long") \
        .createOrReplaceTempView("days_t")
    got = FS.read_range_sql(spark, "SELECT n FROM days_t WHERE d BETWEEN :d1 AND :d2",
                            dt.date(2024, 1, 3), dt.date(2024, 1, 5)).collect()
    assert sorted(r.n for r in got) == [3, 4, 5]


def test_write_tables_skips_private(spark, tmp_dir):
    a = spark.createDataFrame([(1,)], "x long")
    SK.write_tables({"funnel": a, "_cube": a}, tmp_dir)
    assert os.path.isdir(os.path.join(tmp_dir, "funnel")) and not os.path.exists(os.path.join(tmp_dir, "_cube"))


def test_day_partition_write_spreads_a_hot_day(spark, tmp_dir):
    """A day with most of the rows is still written correctly (rebalance, not one task per day)."""
    from ledgerline.operators.merge import write_day_partitions

    hot = spark.range(0, 50000).selectExpr("CASE WHEN id % 10 = 0 THEN DATE '2024-01-02' ELSE DATE '2024-01-01' END AS d",
                                           "id AS n")
    path = os.path.join(tmp_dir, "hot")
    write_day_partitions(hot, path)
    got = spark.read.parquet(path).groupBy("d").count().collect()
    assert sorted((r.d, r["count"]) for r in got) == [(dt.date(2024, 1, 1), 45000), (dt.date(2024, 1, 2), 5000)]
    plan = hot.hint("rebalance", "d")._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE" in plan.upper()


def test_positional_reader_bad_cell_is_null(spark, tmp_dir):
    schema = StructType([StructField("d", StringType()), StructField("n", LongType())])
    p = write(os.path.join(tmp_dir, "cell.json"), '[["2024-01-01","x"],["2024-01-02",5],["2024-01-03"]]')
    got = [tuple(r) for r in FS.read_positional_rows(spark, p, schema).collect()]
    assert got == [("2024-01-01", None), ("2024-01-02", 5), ("2024-01-03", None)]
