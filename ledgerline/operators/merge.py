"""Incremental merges of refreshed slices into kept tables.

Each source path has its own rule (H18), kept apart here:

* ``replace_day_slices`` (M1): drop the kept rows of every day present in the
  fresh slice, append the fresh rows; an empty slice changes nothing.
* ``replace_day`` (M2): the day is given (the raw path takes it from the
  clock when the slice is empty), so that day is dropped even if nothing new
  arrives.
* ``rolling_months`` (M3): keep the as-of month and the months before it.
* ``rebuild_with_carry`` (M4 = J5 + J6): the output keys are the fresh keys
  only; fresh measures default to 0 and the utilisation measures are carried
  from the previous snapshot by key.
* ``snapshot_or_previous`` (M5): use the fresh snapshot when one was read.

On a table these are partition operations: ``write_day_partitions`` writes
the fresh slice with dynamic partition overwrite on the day column, which
replaces exactly the days present, atomically per partition.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import codes
from ..session import scratch_path


def replace_day_slices(prev: DataFrame, fresh: DataFrame, day_col: str = "d") -> DataFrame:
    """M1: ``prev`` minus the days present in ``fresh``, plus ``fresh``.

    Both sides are tagged and read once: of each day the rows of the newest side stay. The rows are
    aggregates, of which a day has at most agents x touchpoints. Rows without a day are all kept.
    """
    tagged = prev.withColumn("__fresh", F.lit(0)).unionByName(fresh.select(*prev.columns, F.lit(1).alias("__fresh")))
    newest = F.max("__fresh").over(Window.partitionBy(day_col))
    kept = tagged.withColumn("__newest", newest).filter((F.col("__fresh") == F.col("__newest")) | F.col(day_col).isNull())
    return kept.select(*prev.columns)


def replace_day(prev: DataFrame, fresh: DataFrame, day: dt.date | str, day_col: str = "d") -> DataFrame:
    """M2: drop ``prev`` rows of ``day`` (even if ``fresh`` is empty), append ``fresh``."""
    keep = ~F.col(day_col).eqNullSafe(F.lit(day))
    return prev.filter(keep).unionByName(fresh.select(*prev.columns))


def rolling_months(df: DataFrame, as_of: dt.date, months: int = codes.RAW_HISTORY_MONTHS,
                   day_col: str = "d") -> DataFrame:
    """M3: keep days in the as-of month or the ``months - 1`` calendar months
    before it (on full dates, so last year's same months are not kept)."""
    start = F.add_months(F.trunc(F.lit(as_of), "MM"), -(months - 1))
    end = F.add_months(F.trunc(F.lit(as_of), "MM"), 1)
    return df.filter((F.col(day_col) >= start) & (F.col(day_col) < end))


def rebuild_with_carry(created: DataFrame, calls: DataFrame, prev: DataFrame | None,
                       keys: Sequence[str] = tuple(codes.ACTIVITY_KEYS)) -> DataFrame:
    """M4: fresh created rows full-outer-joined with fresh call rows on the keys
    (J5), utilisation measures carried from ``prev`` by key (J6); 25 columns."""
    keys = list(keys)
    fresh = created.join(calls, keys, "full")
    if prev is not None:
        carried = prev.select(*keys, *[F.col(u).alias(f"__prev_{u}") for u in codes.UTIL_MEASURES])
        fresh = fresh.join(carried, keys, "left")
    out = [F.col(k) for k in keys]
    for m in codes.ACTIVITY_MEASURES:
        if m in codes.UTIL_MEASURES:
            src = F.col(f"__prev_{m}") if prev is not None else F.lit(None)
        else:
            src = F.col(m)
        out.append(F.coalesce(src, F.lit(0)).cast("bigint").alias(m))
    return fresh.select(*out)


def snapshot_or_previous(fresh: DataFrame | None, prev: DataFrame | None) -> DataFrame | None:
    """M5: the fresh snapshot when it could be read, else the previous one."""
    return fresh if fresh is not None else prev


def _folder(df_or_spark, path: str):
    """(file system, path) of a table folder."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def day_folders(spark: SparkSession, path: str, day_col: str = "d") -> list[dt.date]:
    """The days a kept table has a partition for, from its folder names; no file is read."""
    fs, p = _folder(spark, path)
    names = [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(dt.date.fromisoformat(n.partition("=")[2]) for n in names if n.startswith(f"{day_col}=") and not n.endswith("__HIVE_DEFAULT_PARTITION__"))


def drop_old_days(spark: SparkSession, path: str, as_of: dt.date, months: int = codes.RAW_HISTORY_MONTHS, day_col: str = "d") -> list[dt.date]:
    """M3 on a kept table: the partitions outside ``rolling_months`` go, rows without a day with them; no kept
    day is read or rewritten. Returns the dropped days. A repeated call drops nothing more."""
    months_from_0 = as_of.year * 12 + as_of.month - 1
    first, after = (dt.date(m // 12, m % 12 + 1, 1) for m in (months_from_0 - (months - 1), months_from_0 + 1))
    old = [d for d in day_folders(spark, path, day_col) if not first <= d < after]
    for name in [*[d.isoformat() for d in old], "__HIVE_DEFAULT_PARTITION__"]:
        fs, p = _folder(spark, f"{path.rstrip('/')}/{day_col}={name}")
        fs.delete(p, True)
    return old


def write_clustered(df: DataFrame, path: str, day_col: str = "d", by: Sequence[str] = ("ag", "bk"), row_group_bytes: int = 8 << 20) -> None:
    """Day partitions whose rows lie in order of ``by``, with Parquet bloom filters on these columns.

    A range-partitioned write gives each task a stretch of (day, agent, touchpoint) and splits a day
    or an agent that holds much of the rows. A reader's filter on an agent or a touchpoint then skips
    row groups by their bounds, and by the bloom filter where bounds overlap.
    """
    w = df.repartitionByRange(day_col, *by).sortWithinPartitions(day_col, *by)
    w = w.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("parquet.block.size", row_group_bytes)
    for c in by:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.partitionBy(day_col).parquet(path)


def write_day_partitions(df: DataFrame, path: str, day_col: str = "d", fmt: str = "parquet") -> None:
    """SK2 / M1 at table scale: replace only the day partitions present in ``df``.

    Rows are clustered by day with the ``rebalance`` hint, so each day is
    written by few tasks and few files, while AQE splits a day that holds a
    large share of the rows across several tasks (a plain ``repartition(day)``
    would give such a day to one task). Rows are sorted within each task (T6).
    """
    (df.hint("rebalance", day_col).sortWithinPartitions(*df.columns)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(day_col).format(fmt).save(path))


def replace_days(df: DataFrame, path: str, days: Sequence[dt.date], day_col: str = "d") -> dict:
    """M1 on a table for given ``days``: their partitions become the rows of ``df``,
    and the partition of a day without rows goes. Returns what the write observed
    (SK6): ``n_rows``, ``min_date``, ``max_date``.

    The rows are written once to the shared checkpoint folder first, so that the days with rows
    are known before the table changes; that folder goes at the end. Days without rows go before
    the others are replaced. A failure in between leaves some days old and some new until the
    call is repeated, which gives the same table as one call.
    """
    spark = df.sparkSession
    kept = scratch_path(spark, f"days-{uuid.uuid4().hex}")
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.min(day_col).alias("min_date"), F.max(day_col).alias("max_date")).write.parquet(kept)
    rows = spark.read.schema(df.schema).parquet(kept)
    present = {r[0] for r in rows.select(day_col).distinct().collect()}  # days, bounded by the calendar
    for day in days:
        if day not in present:
            fs, p = _folder(spark, f"{path.rstrip('/')}/{day_col}={day.isoformat()}")
            fs.delete(p, True)
    write_day_partitions(rows, path, day_col)
    fs, p = _folder(spark, kept)
    fs.delete(p, True)
    return seen.get
