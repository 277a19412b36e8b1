"""ALL rows: sums of the grouped (already rounded) rows, in one pass."""

from ledgerline.operators.rollup import grand_total, with_rollup, zero_nulls


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_grand_total_and_empty(spark):
    e = spark.createDataFrame([], "agent string, n bigint")
    assert rows(grand_total(e, "agent", ["n"])) == [("ALL", 0)]
    d = spark.createDataFrame([("a", 1), ("b", None)], "agent string, n bigint")
    assert rows(grand_total(d, "agent", ["n"])) == [("ALL", 1), ("a", 1), ("b", None)]


def test_rollup_by_key_and_known_labels(spark):
    f = spark.createDataFrame([("A", "x", 1), ("B", "x", 2), ("Z", "y", 5)], "c string, o string, n bigint")
    assert rows(with_rollup(f, "c", ["o"], ["n"])) == [("A", "x", 1), ("ALL", "x", 3), ("ALL", "y", 5), ("B", "x", 2), ("Z", "y", 5)]
    assert rows(with_rollup(f, "c", [], ["n"], keep_labels=["A", "B"])) == [("A", 1), ("ALL", 3), ("B", 2), ("Z", 5)]
    assert rows(zero_nulls(spark.createDataFrame([("a", None)], "c string, n bigint"), ["n"])) == [("a", 0)]


def test_rollup_computes_upstream_once(spark):
    src = spark.range(0, 1000).selectExpr("CAST(id % 7 AS STRING) AS agent", "id AS n").groupBy("agent").sum("n")
    out = grand_total(src.withColumnRenamed("sum(n)", "n"), "agent", ["n"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") <= 2      # the source range once (+ the one-row seed)
