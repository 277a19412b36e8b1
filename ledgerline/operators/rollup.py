"""Roll-up rows: an ``ALL`` group appended to a grouped result.

The roll-up is computed from the already aggregated (and already rounded)
rows, not from the detail rows: the source sums rounded per-group values, so
``ALL`` can differ by a unit from a rounding of the grand total (H2). The
input is one row per group, so this is a second, tiny aggregation.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes


def rollup_rows(df: DataFrame, label_col: str, keys: Iterable[str], measures: Iterable[str],
                label: str = codes.ALL, keep_labels: Iterable[str] | None = None) -> DataFrame:
    """Sum ``measures`` over ``label_col`` per ``keys``; the label becomes ``label``.

    ``keep_labels`` restricts which groups enter the sum (the funnel's ``ALL``
    adds the known channels only, H6).
    """
    keys, measures = list(keys), list(measures)
    src = df if keep_labels is None else df.filter(F.col(label_col).isin(list(keep_labels)))
    agg = [F.sum(m).alias(m) for m in measures]
    if keys:
        out = src.groupBy(*keys).agg(*agg)
    else:
        out = src.agg(*agg)
    return out.select(F.lit(label).alias(label_col), *keys, *[F.col(m).cast(df.schema[m].dataType).alias(m)
                                                              for m in measures])


def with_rollup(df: DataFrame, label_col: str, keys: Iterable[str], measures: Iterable[str],
                label: str = codes.ALL, keep_labels: Iterable[str] | None = None) -> DataFrame:
    """The grouped rows followed by their roll-up rows, in one pass.

    Grouping sets ``(label, keys)`` and ``(keys)`` over the grouped rows: the
    first set reproduces each row (one row per group), the second sums them.
    A ``union`` of the rows with an aggregate of the same rows would make
    Spark compute everything upstream twice; this does it once.
    """
    keys, measures = list(keys), list(measures)
    lab = F.col(label_col)
    src = df.select(label_col, *keys, *measures, F.lit(False).alias("__seed"))
    if not keys:
        # A grand total exists even over no rows (the reports show ALL = 0):
        # one constant seed row keeps the () grouping set non-empty.
        seed = df.sparkSession.range(1).select(
            F.lit(None).cast(df.schema[label_col].dataType).alias(label_col),
            *[F.lit(None).cast(df.schema[m].dataType).alias(m) for m in measures],
            F.lit(True).alias("__seed"))
        src = src.unionByName(seed)
    aggs = [F.grouping(label_col).alias("__g")]
    for m in measures:
        aggs.append(F.sum(m).alias(m))
        if keep_labels is not None:
            aggs.append(F.sum(F.when(lab.isin(list(keep_labels)), F.col(m))).alias(f"__k_{m}"))
    # The seed has a group of its own: a null label is a group like any other.
    g = src.groupingSets([[label_col, "__seed", *keys], keys], label_col, "__seed", *keys).agg(*aggs)
    g = g.filter((F.col("__g") == 1) | ~F.coalesce("__seed", F.lit(False)))
    out = [F.when(F.col("__g") == 1, F.lit(label)).otherwise(lab).alias(label_col), *keys]
    for m in measures:
        v = F.col(m) if keep_labels is None else F.when(F.col("__g") == 1, F.col(f"__k_{m}")).otherwise(F.col(m))
        if not keys:
            v = F.when(F.col("__g") == 1, F.coalesce(v, F.lit(0))).otherwise(v)
        out.append(v.cast(df.schema[m].dataType).alias(m))
    return g.select(*out)


def zero_nulls(df: DataFrame, measures: Iterable[str]) -> DataFrame:
    """``num(x)`` -- null measures become 0."""
    measures = set(measures)
    return df.select(*[F.coalesce(F.col(c), F.lit(0)).cast(df.schema[c].dataType).alias(c)
                       if c in measures else F.col(c) for c in df.columns])


def grand_total(df: DataFrame, label_col: str, measures: Iterable[str], label: str = codes.ALL) -> DataFrame:
    """Per-row table plus one ``ALL`` row summing every measure."""
    return with_rollup(df, label_col, [], measures, label)


def sum_of(cols: Iterable[str]) -> Column:
    cols = list(cols)
    out = F.col(cols[0])
    for c in cols[1:]:
        out = out + F.col(c)
    return out
