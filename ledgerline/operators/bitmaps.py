"""Distinct counts that can be added up: bitmaps of ids.

A distinct count of a day cannot be added to that of the next day. A bitmap can: each (keys,
bucket) row holds one bit per id of its range of 32,768 ids, bitmaps of many days are joined by
``bitmap_or_agg``, and the bits are counted at the end, so a window's distinct ids come from the
kept rows of its days. Exact for whole-number ids (64 bits).

The bits of a range are aggregated before the shuffle, so a hot key sends one bitmap per task
and range, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

BUCKET, BITS = "id_bucket", "id_bits"


def id_bitmaps(rows: DataFrame, keys: Sequence[str | Column], id_col: str) -> DataFrame:
    """(keys, id_bucket, id_bits): the ids of each key group; null ids are in no bitmap."""
    if not isinstance(rows.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col}: bitmaps need whole-number ids; number the ids first")
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    n = F.col(id_col).cast("long")
    src = rows.filter(F.col(id_col).isNotNull()).select(*cols, F.bitmap_bucket_number(n).alias(BUCKET), F.bitmap_bit_position(n).alias("__bit"))
    return src.groupBy(*src.columns[:-1]).agg(F.bitmap_construct_agg("__bit").alias(BITS))


def union_of(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps over fewer keys: the ids that occur in any of the joined groups."""
    return bitmaps.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_ids(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Per ``keys`` the number of distinct ids in the bitmaps."""
    return union_of(bitmaps, keys).groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).alias(name))
