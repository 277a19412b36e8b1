"""Sinks: kept tables and export files (SK1-SK5).

The kept form of every output is a table (Parquet, partitioned by day where
rows are daily). JSON and CSV are export edges written by the executors, one
line per row -- a result is never packed into a single cell or passed
through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C


def write_tables(tables: Mapping[str, DataFrame], base: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """SK1: one table per snapshot section (``funnel``, ``leaderboard``, ``meta``...)."""
    for name, df in tables.items():
        if name.startswith("_"):
            continue
        df.write.mode(mode).format(fmt).save(f"{base.rstrip('/')}/{name}")


def positional_json(df: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """SK3/SK4 re-aimed: each row as a positional JSON array (the source's
    ``json_build_array`` row), one line per row; numbers stay numbers and
    nulls stay null (cells are cast to variant)."""
    arr = F.to_json(F.array(*[F.col(c).cast("variant") for c in df.columns]))
    src = df.orderBy(*order) if order else df
    return src.select(arr.alias("value"))


def raw_csv_frame(raw_with_pii: DataFrame) -> DataFrame:
    """SK5: the member-level rows decoded for a CSV download (8 columns)."""
    return raw_with_pii.select(
        F.date_format("d", "yyyy-MM-dd").alias("date"),
        F.col("agent").alias("account_manager"),
        F.coalesce("mobile", F.lit("")).alias("mobile"),
        F.coalesce("full_name", F.lit("")).alias("member"),
        F.coalesce(C.bucket_label_of_code("bucket_code"), F.lit("")).alias("touchpoint"),
        F.coalesce(C.outcome_label_of_code("outcome_code"), F.lit("")).alias("disposition"),
        F.when(F.coalesce(F.col("in_call"), F.lit(0)) != 0, F.lit("yes")).otherwise(F.lit("no")).alias("booked_on_call"),
        F.when(F.col("util_code") != 0, F.coalesce(C.utility_label_of_code("util_code"), F.lit("")))
        .otherwise(F.lit("")).alias("utility_booked"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SK5: header row, RFC 4180 quoting (fields with quote, comma or newline
    are quoted; quotes doubled)."""
    (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("nullValue", "").option("emptyValue", "").csv(path))


__all__ = ["write_tables", "positional_json", "raw_csv_frame", "write_csv"]
