"""Forward as-of join: the first right-side event on or after each left row's day.

Semantics (the source's lateral top-1): for each left row with key ``by`` and
day ``day``, pick the right row with the same ``by`` whose day is >= ``day``
and which is first by ``order`` (ties broken by the later ``order`` columns);
no qualifying right row -> no match.

Plan, chosen so that the left side is read once, neither side's skew reaches
one task and no pairs are emitted:

1. the right side is reduced to one row per (by, day) -- the first event of
   that day -- with ``min(struct(order..., values...))``; this is a partial
   aggregation, so a hot key is combined before the shuffle. Only the day is
   compared, so the first event of the first qualifying day is the answer;
2. these rows become one row per ``by``: its days in order (``day_lists``). A
   list holds one entry per day with an event, so the calendar bounds it,
   however many events a key has;
3. one equi-join brings the list to each left row, which keeps the first entry
   on or after its day. A hot key is a many-to-one join, whose left side AQE
   splits. Rows without a key are dealt by a hash of the row: they match
   nothing and would otherwise all meet in one task.

``keep_lists`` and ``keep_left`` write both sides as tables bucketed by the key,
rows without a key apart; ``kept_asof`` joins them bucket by bucket, without a
shuffle.

Spark's own ``LATERAL (... ORDER BY ... LIMIT 1)`` is not used: with a
non-equi correlation it returned wrong rows on the test data (SURVEY H24).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HIT = "__asof_hit"
_DAYS = "__asof_days"
_SPREAD = "__asof_spread"
SPREAD = 4096  # groups over which rows without a key are dealt


def first_per_day(right: DataFrame, by: str, day: str, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per (by, day): the first event by ``order`` and its ``values``."""
    payload = F.struct(*[F.col(c) for c in list(order) + [v for v in values if v not in order]])
    return right.groupBy(by, day).agg(F.min(payload).alias(_HIT))


def day_lists(right: DataFrame, by: str, day: str, order: Sequence[str], values: Sequence[str], only: DataFrame | None = None) -> DataFrame:
    """One row per ``by``: the first event of each of its days, in order of days. Rows without a key or a day cannot match.
    With ``only`` (a table of keys) other keys get no list; a hot key has been combined to its days by then."""
    keyed = right.filter(F.col(by).isNotNull() & F.col(day).isNotNull())
    days = first_per_day(keyed, by, day, order, values)
    if only is not None:
        days = days.join(only.select(by), by, "left_semi")
    return days.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(F.col(day).alias("day"), F.col(_HIT).alias("hit")))).alias(_DAYS))


def _with_first(joined: DataFrame, left_columns: Sequence[str], left_day: str, order: Sequence[str], values: Sequence[str], how: str) -> DataFrame:
    """Left columns and the first entry of the list on or after the day."""
    hit = F.get(F.filter(_DAYS, lambda x: x["day"] >= F.col(left_day)), F.lit(0))
    out = joined.select(*left_columns, hit["hit"].alias(_HIT))
    if how == "inner":
        out = out.filter(F.col(_HIT).isNotNull())
    names = list(order) + [v for v in values if v not in order]
    return out.select(*left_columns, *[F.col(_HIT)[c].alias(c) for c in names])


def forward_asof(left: DataFrame, right: DataFrame, by: str, left_day: str, right_day: str,
                 order: Sequence[str], values: Sequence[str], how: str = "left", only: DataFrame | None = None) -> DataFrame:
    """Attach to every ``left`` row the first ``right`` row (by ``order``) with the
    same ``by`` and ``right_day >= left_day``; adds ``values`` (and ``order``)
    columns, null when nothing qualifies (``how='left'``) or drops the row
    (``how='inner'``). ``only``: a table that holds every key of ``left``, where it is known to be short."""
    lists = day_lists(right, by, right_day, order, values, only)
    if how == "inner":
        joined = left.filter(F.col(by).isNotNull()).join(lists, by, "inner")
    else:
        spread = F.when(F.col(by).isNull(), F.pmod(F.xxhash64(*left.columns), F.lit(SPREAD)).cast("int")).otherwise(F.lit(0))
        # 0, but no literal: as one it would leave the join keys, and with it the shuffle in which AQE splits a hot key.
        lists = lists.withColumn(_SPREAD, F.least(F.size(_DAYS), F.lit(0)))
        joined = left.withColumn(_SPREAD, spread).join(lists, [by, _SPREAD], "left")
    return _with_first(joined, left.columns, left_day, order, values, how)


# ------------------------------------------------------------ kept tables ---

def _save(df: DataFrame, name: str, path: str, by: str, buckets: int) -> None:
    # Each bucket is one range of tasks' output, so a kept table has few files a bucket.
    (df.repartition(buckets, by).write.mode("overwrite").option("path", path).bucketBy(buckets, by).sortBy(by).saveAsTable(name))


def keep_lists(right: DataFrame, name: str, path: str, by: str, right_day: str, order: Sequence[str], values: Sequence[str], buckets: int) -> None:
    """Write the right side as table ``name``: one row per key, bucketed by it."""
    _save(day_lists(right, by, right_day, order, values), name, path, by, buckets)


def keep_left(left: DataFrame, name: str, path: str, by: str, buckets: int) -> None:
    """Write the left side as table ``name``, bucketed by the key; rows without one go to ``name_unkeyed``."""
    _save(left.filter(F.col(by).isNotNull()), name, path, by, buckets)
    left.filter(F.col(by).isNull()).write.mode("overwrite").option("path", f"{path}_unkeyed").saveAsTable(f"{name}_unkeyed")


def kept_asof(spark: SparkSession, left_name: str, lists_name: str, by: str, left_day: str,
              order: Sequence[str], values: Sequence[str], how: str = "left", where=None) -> DataFrame:
    """``forward_asof`` on kept tables: buckets meet without a shuffle. ``where`` limits the left rows and reaches both scans."""
    lists = spark.table(lists_name)
    left, bare = spark.table(left_name), spark.table(f"{left_name}_unkeyed")
    if where is not None:
        left, bare = left.filter(where), bare.filter(where)
    # The buckets are joined as they lie; a broadcast of the lists would read them whole for each task.
    out = _with_first(left.join(lists.hint("merge"), by, how), left.columns, left_day, order, values, how)
    if how == "inner":
        return out
    fields = {f.name: f.dataType for f in out.schema.fields}
    return out.unionByName(bare.select(*bare.columns, *[F.lit(None).cast(t).alias(n) for n, t in fields.items() if n not in bare.columns]))
