"""ST1/ST2: the incremental refresh equals the batch answer, in any arrival order."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.plans import activity as A
from ledgerline.sources import standins as S
from ledgerline.streaming import refresh as ST


def test_stream_equals_batch_with_duplicates_and_late_rows(spark, tmp_dir):
    forms = S.reachout_forms(spark, SF_SMALL)
    member = S.members(spark, SF_SMALL)
    services = S.services(spark, SF_SMALL)
    log_dir = os.path.join(tmp_dir, "log")
    out = os.path.join(tmp_dir, "activity_day")
    # deliveries: later ids first (late data), then a duplicate delivery, then the rest
    chunks = [forms.filter(F.col("uid") % 3 == 2), forms.filter(F.col("uid") % 3 == 0),
              forms.filter(F.col("uid") % 3 == 2), forms.filter(F.col("uid") % 3 == 1)]
    for i, chunk in enumerate(chunks):
        chunk.coalesce(1).write.mode("append").parquet(log_dir)
        q = ST.start_refresh(spark, log_dir, forms.schema, member, services, out, name=f"t{os.getpid()}",
                             raw_path=os.path.join(tmp_dir, "raw"), buckets=8)
        q.awaitTermination()
    got = spark.read.parquet(out)
    want = A.activity_day(forms, member, services, S.ACTIVITY_FIRST_DAY, S.ACTIVITY_LAST_DAY)
    cols = want.columns
    g = sorted(tuple(r) for r in got.select(*cols).collect())
    w = sorted(tuple(r) for r in want.select(*cols).collect())
    assert g == w and len(g) > 0
    raw_got = spark.read.parquet(os.path.join(tmp_dir, "raw"))
    raw_want = A.reachout_raw(forms, member, services, S.ACTIVITY_FIRST_DAY, S.ACTIVITY_LAST_DAY)
    cols = raw_want.columns
    assert sorted(tuple(r) for r in raw_got.select(*cols).collect()) == sorted(tuple(r) for r in raw_want.collect())


def _refresh(spark, log_dir, schema, member, services, out, name):
    ST.start_refresh(spark, log_dir, schema, member, services, out, name=name, buckets=8).awaitTermination()


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_versions_moves_and_old_files_equal_batch(spark, tmp_dir):
    """A draft that is submitted, a day that moves and so becomes empty, a reason that becomes unmapped, a file with an old landing time."""
    forms = S.reachout_forms(spark, SF_SMALL)
    member, services = S.members(spark, SF_SMALL), S.services(spark, SF_SMALL)
    log_dir, out = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "activity_day")
    few = forms.filter(F.col("uid") % 4 == 0)
    early = few.withColumns({"is_draft": F.lit(True), "created_at": F.expr("created_at + INTERVAL 200 DAYS")})
    early.coalesce(1).write.parquet(log_dir)
    name = f"v{os.getpid()}"
    _refresh(spark, log_dir, forms.schema, member, services, out, name)
    assert spark.read.parquet(out).count() > 0
    moved = spark.read.parquet(out).select("d").distinct().count()
    few.coalesce(1).write.mode("append").parquet(log_dir)
    old = os.path.join(tmp_dir, "old")
    forms.filter(F.col("uid") % 4 != 0).coalesce(1).write.parquet(old)
    _refresh(spark, log_dir, forms.schema, member, services, out, name)
    for f in os.listdir(old):  # lands with its old time
        if f.startswith("part-"):
            os.utime(os.path.join(old, f), (1_600_000_000, 1_600_000_000))
            os.link(os.path.join(old, f), os.path.join(log_dir, "late-" + f))
    _refresh(spark, log_dir, forms.schema, member, services, out, name)
    last = forms.filter(F.col("uid") % 8 == 0).withColumn("reason", F.lit("no such reason")) if "reason" in forms.columns else None
    want_log = forms
    if last is not None:
        last.coalesce(1).write.mode("append").parquet(log_dir)
        _refresh(spark, log_dir, forms.schema, member, services, out, name)
        want_log = forms.filter(F.col("uid") % 8 != 0).unionByName(last)
    want = A.activity_day(want_log, member, services, S.ACTIVITY_FIRST_DAY, S.ACTIVITY_LAST_DAY)
    assert moved > 0
    assert _rows(spark.read.parquet(out), want.columns) == _rows(want, want.columns)


def test_a_batch_with_500_days_loses_none(spark):
    days = spark.range(500).selectExpr("id AS uid", "timestampadd(DAY, CAST(id AS INT), TIMESTAMP '2020-01-01 08:00:00') AS created_at",
                                       "true AS is_draft", "CAST(NULL AS TIMESTAMP) AS submitted_at")
    assert len(ST.touched_days(days)) == 500


def test_latest_delivery_per_form_with_a_hot_group_of_copies(spark, tmp_dir):
    log_dir = os.path.join(tmp_dir, "log2")
    base = spark.range(0, 3000).selectExpr("CASE WHEN id < 1000 THEN 7 ELSE id END AS uid", "id AS payload")
    base.coalesce(1).write.parquet(log_dir)
    spark.createDataFrame([(7, -1)], "uid long, payload long").write.mode("append").parquet(log_dir)
    out = ST.latest_per_form(spark.read.parquet(log_dir))
    rows = {r.uid: r.payload for r in out.collect()}
    assert len(rows) == 2001 and rows[7] == -1          # one row per form; the latest file wins


def test_session_keeps_adaptive_skew_handling(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert spark.conf.get("spark.checkpoint.dir")
