"""Fresh listings, null labels, exact roundings, raised read errors."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerline.functions import columns as C
from ledgerline.operators.rollup import with_rollup
from ledgerline.sources.files import read_previous
from ledgerline.sources.tables import read_table


def test_rows_that_land_later_are_read(spark, tmp_dir):
    spark.range(5).write.parquet(f"{tmp_dir}/events.parquet")
    assert read_table(spark, tmp_dir, "events").count() == 5
    spark.range(5).write.mode("append").parquet(f"{tmp_dir}/events.parquet")
    assert read_table(spark, tmp_dir, "events").count() == 10


def test_a_null_label_keeps_its_row(spark):
    df = spark.createDataFrame([(None, 5), ("a", 1)], "label string, n long")
    got = {(r["label"], r["n"]) for r in with_rollup(df, "label", [], ["n"]).collect()}
    assert got == {(None, 5), ("a", 1), ("ALL", 6)}


def test_percent_equals_python_round(spark):
    pairs = [(n, d) for d in (3, 7, 400, 800, 1000, 1600, 2000) for n in range(0, d + 1, max(1, d // 150))] + [(5, 4000), (3, 2000)]
    df = spark.createDataFrame(pairs, "n long, d long").select("n", "d", C.pct_half_even("n", "d").alias("p"))
    assert all(r["p"] == round(100.0 * r["n"] / r["d"], 1) for r in df.collect())


def _to_fixed(x, places):
    """The nearest decimal to the exact value, the larger of two equally near."""
    from decimal import ROUND_HALF_UP, Decimal

    return str(Decimal(x).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


def test_fixed_text_is_exact(spark):
    rng = random.Random(5)
    xs = [4.385, 2.675, 3.985, 0.125, 2.5, 0.005, 1.005] + [round(rng.uniform(0, 5), 3) for _ in range(300)] + [k / 8 for k in range(40)]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", C.fixed_text(F.col("x"), 2).alias("t")).collect()
    assert [r["t"] for r in got] == [_to_fixed(r["x"], 2) for r in got]
    money = spark.createDataFrame([(10_050_000,), (115_000,)], "n long").select(C.money_label("n")).collect()
    assert [r[0] for r in money] == ["₹1.00Cr", "₹1.1L"] == ["₹" + _to_fixed(1.005, 2) + "Cr", "₹" + _to_fixed(1.15, 1) + "L"]


def test_only_a_missing_path_reads_as_empty(spark, tmp_dir):
    schema = StructType([StructField("id", LongType())])
    assert read_previous(spark, f"{tmp_dir}/none", schema).count() == 0
    with pytest.raises(Exception):
        read_previous(spark, f"{tmp_dir}/none", schema, "no_such_format")


def test_a_cluster_needs_a_shared_checkpoint_folder():
    from types import SimpleNamespace

    from ledgerline.session import ensure_checkpoint_dir

    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(fake)
