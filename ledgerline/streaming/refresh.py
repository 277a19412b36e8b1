"""Incremental refresh of ``activity_day`` from a growing form log (ST1, ST2).

The source refreshes by polling: every run recomputes "today" and replaces
that day's slice. As a stream:

* the form log (a folder of Parquet files new deliveries land in) is read
  with ``readStream``; nothing is dropped from it, whatever its delivery time:
  a form's later versions and late files only re-open days (ST2);
* each micro-batch moves kept state on (``state.FormState``): what the new
  version of a form counts for is added to its days, what its old version did
  is subtracted. The log itself is not read again;
* a repeated delivery with the content the form already has touches no day.
  ``repeats_within`` also lets Spark drop repeats before the batch, by
  ``dropDuplicatesWithinWatermark`` on uid and content. Its clock is the
  arrival, so no version is late; but a form that returns to earlier content
  within that time counts as a repeat, so it is off unless the log's versions
  are known never to return;
* the touched days replace their partitions, and a touched day that has
  become empty loses its partition. Replaying a batch rewrites the same rows.

``recompute_days`` is the rule without state: it rebuilds given days from all
versions in the log, to start a state folder anew or to check one.

The days touched by one batch are bounded by the calendar, so they are brought
to the driver as parameters, all of them; rows never are.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import columns as C
from ..operators.merge import replace_days
from ..plans import activity as A
from ..session import scratch_path
from .state import BUCKETS, FormState, content_digest


def delivered(log: DataFrame) -> DataFrame:
    """A scan of the log with each row's delivery: landing time and path of its file."""
    return log.select("*", F.col("_metadata.file_modification_time").alias("__t"), F.col("_metadata.file_path").alias("__f"))


def latest_per_form(log: DataFrame) -> DataFrame:
    """ST2, exact: one row per form -- the latest delivery (file landing time,
    then file path). A partial aggregation, so many copies of one form are
    combined before the shuffle."""
    tagged = log if "__t" in log.columns else delivered(log)
    cols = [c for c in tagged.columns if c not in ("__t", "__f")]
    latest = tagged.groupBy("uid").agg(F.max_by(F.struct(*cols), F.struct("__t", "__f")).alias("__r"))
    return latest.select("__r.*")


def _days_of(forms: DataFrame, tz: str) -> DataFrame:
    """(uid, d): the days on which any row of ``forms`` counts."""
    created = forms.select("uid", C.local_date("created_at", tz).alias("d"))
    submitted = forms.filter(F.col("is_draft") == F.lit(False)).select("uid", C.local_date("submitted_at", tz).alias("d"))
    return created.unionByName(submitted).filter(F.col("d").isNotNull())


def touched_days(batch: DataFrame, log: DataFrame | None = None, tz: str = "UTC") -> list[dt.date]:
    """The days of the batch's rows and, with ``log``, of all versions of its forms."""
    rows = batch if log is None else log.join(batch.select("uid").distinct(), "uid", "left_semi")
    days = _days_of(batch, tz).select("d") if log is None else _days_of(batch, tz).select("d").union(_days_of(rows, tz).select("d"))
    return sorted(r.d for r in days.distinct().collect())


def forms_on(log: DataFrame, days: list[dt.date], tz: str = "UTC") -> DataFrame:
    """All versions of the forms that have one of ``days`` in any version."""
    wanted = log.sparkSession.createDataFrame([(d,) for d in days], "d date")
    uids = _days_of(log, tz).join(wanted, "d", "left_semi").select("uid").distinct()
    return log.join(uids, "uid", "left_semi")


def recompute_days(spark: SparkSession, log: DataFrame, member: DataFrame, services: DataFrame,
                   days: list[dt.date], out_path: str, tz: str = "UTC", raw_path: str | None = None) -> None:
    """Recompute ``activity_day`` (and, with ``raw_path``, the member-level rows)
    for ``days`` from the forms that concern them; replace exactly those day partitions."""
    if not days:
        return
    wanted = spark.createDataFrame([(d,) for d in days], "d date")
    lo, hi = days[0], days[-1]
    replace_days(A.activity_day(log, member, services, lo, hi, tz).join(wanted, "d", "left_semi"), out_path, days)
    if raw_path is not None:
        replace_days(A.reachout_raw(log, member, services, lo, hi, tz).join(wanted, "d", "left_semi"), raw_path, days)


def start_refresh(spark: SparkSession, log_dir: str, log_schema, member: DataFrame, services: DataFrame,
                  out_path: str, name: str = "activity_day", tz: str = "UTC", available_now: bool = True,
                  raw_path: str | None = None, repeats_within: str | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Start the incremental refresh; the checkpoint and the state live in the shared
    checkpoint folder (``spark.checkpoint.dir``)."""
    # By default the file source ignores files that are a week older than the newest.
    stream = delivered(spark.readStream.schema(log_schema).option("maxFileAge", "36500d").parquet(log_dir))
    if repeats_within is not None:
        stream = (stream.withColumns({"__arrived": F.current_timestamp(), "__digest": content_digest(log_schema.names)})
                  .withWatermark("__arrived", repeats_within).dropDuplicatesWithinWatermark(["uid", "__digest"]).drop("__arrived", "__digest"))
    state = FormState(spark, scratch_path(spark, f"streams/{name}-state"), member, services, out_path, tz, raw_path, log_schema["uid"].dataType, buckets)
    writer = (stream.writeStream.foreachBatch(lambda batch, batch_id: state.apply(batch, batch_id) and None)
              .option("checkpointLocation", scratch_path(spark, f"streams/{name}")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 minutes")
    return writer.start()
