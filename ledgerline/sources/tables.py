"""Readers for the input tables (Parquet, one folder or file per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# The declared columns of the tables that reports read on every refresh: a declared schema spares
# each read a look into a file's footer. Other tables are read by the schema in their files.
SCHEMAS = {
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def table_path(sf_dir: str, name: str) -> str:
    path = os.path.join(sf_dir, f"{name}.parquet")
    return path if "://" in sf_dir or os.path.exists(path) else os.path.join(sf_dir, name)


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read one table; selecting columns here makes the scan's ReadSchema narrow.

    Every call lists the files anew, so files that have landed since are read.
    """
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    df = reader.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
