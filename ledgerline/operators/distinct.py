"""Filtered distinct counts without row expansion (A3, A4).

``COUNT(DISTINCT e) FILTER (WHERE c_i)`` for many predicates ``c_i`` is planned
by Spark as an ``Expand`` with one copy of every row per distinct aggregate.
Here the rows are first reduced to one per (keys, entity) with ``bool_or`` of
each predicate, then counted with ``count_if``: one shuffle of the entity rows
(skew-free: the entity is the form id) and one partial-aggregated shuffle of
tiny per-group counts, whatever the number of predicates.

A predicate that is null for every row of an entity stays null and is not
counted, as SQL ``FILTER`` drops nulls.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_counts(df: DataFrame, keys: Sequence[str | Column], entity: str,
                    flags: Mapping[str, Column], total: str | None = None) -> DataFrame:
    """Per ``keys``: number of distinct ``entity`` values (``total``) and, for
    each flag, the number of distinct entities with some row where it is true."""
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    staged = df.filter(F.col(entity).isNotNull()).select(
        *key_cols, F.col(entity), *[c.alias(n) for n, c in flags.items()])
    key_names = staged.columns[: len(key_cols)]
    per_entity = staged.groupBy(*key_names, entity).agg(*[F.bool_or(n).alias(n) for n in flags])
    aggs = []
    if total:
        aggs.append(F.count(F.lit(1)).alias(total))
    aggs += [F.count_if(F.col(n)).alias(n) for n in flags]
    return per_entity.groupBy(*key_names).agg(*aggs)
