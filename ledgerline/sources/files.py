"""File-edge readers: result dumps and kept snapshots (SC5-SC8).

The reports exchange small JSON documents between steps (a BI tool's row-map
result, positional row arrays). These readers turn them into typed
DataFrames with Spark's JSON functions; each file is one document, so each
is parsed by one task, and these files are bounded extracts (a day's or a
month's aggregate rows), not tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.errors import AnalysisException


def _is_missing(e: AnalysisException) -> bool:
    """Whether the path does not exist; any other fault is raised, as history would be lost silently."""
    return e.getCondition() == "PATH_NOT_FOUND"


def _read_documents(spark: SparkSession, path: str) -> DataFrame | None:
    """One row per file with its whole text, or None when nothing is there."""
    try:
        return spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if not _is_missing(e):
            raise
        return None


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_row_map(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """SC5: a ``{"0": {...}, "1": {...}}`` result (optionally wrapped in
    ``{"data": ...}``) as typed rows ordered by the integer key (``row_key``)."""
    docs = _read_documents(spark, path)
    if docs is None:
        return empty(spark, StructType([*schema.fields]).add("row_key", "int"))
    outer = F.from_json("value", "map<string,string>")
    unwrapped = F.when(outer.getItem("data").startswith("{"),
                       F.from_json(outer.getItem("data"), "map<string,string>")).otherwise(outer)
    rows = docs.select(F.explode(unwrapped).alias("k", "v"))
    return (rows.select(F.from_json("v", schema).alias("r"), F.col("k").cast("int").alias("row_key"))
            .select("r.*", "row_key").orderBy("row_key"))


def read_positional_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """SC6: a JSON list of positional rows (``[[d, ag, bk, ...], ...]``), typed by
    position. A missing file, bad JSON or a non-list document yields no rows."""
    docs = _read_documents(spark, path)
    if docs is None:
        return empty(spark, schema)
    rows = docs.select(F.explode(F.from_json("value", "array<string>")).alias("row"))
    cells = rows.select(F.from_json("row", "array<string>").alias("c")).filter(F.col("c").isNotNull())
    # a missing cell, or one that does not fit its column's type, reads as null
    return cells.select(*[F.try_element_at(F.col("c"), F.lit(i + 1)).try_cast(f.dataType).alias(f.name)
                          for i, f in enumerate(schema.fields)])


CORRUPT, SOURCE = "_corrupt_record", "_source"


def read_positional_quarantined(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """SC6 with quarantine: the rows of every document under ``path``, and what could not be read.

    A document that is no JSON, or no list, gives one row whose columns are null, with the whole
    text in ``_corrupt_record``; an element that is no list, or has a cell that does not fit its
    column's type, gives one with that element's JSON. Good rows have null there. ``_source`` is the
    file. Each document is parsed once, as a variant. A missing cell is null; an empty list and a
    file without a byte, which Spark does not list, give no row.
    """
    fields = StructType([*schema.fields]).add(CORRUPT, "string").add(SOURCE, "string")
    docs = _read_documents(spark, path)
    if docs is None:
        return empty(spark, fields)
    docs = docs.select(F.col("value").alias("__text"), F.col("_metadata.file_path").alias(SOURCE), F.try_parse_json("value").alias("__v"))
    # One element for a bad document, so that it leaves the explode as one row.
    listed = F.coalesce(F.schema_of_variant("__v").startswith("ARRAY"), F.lit(False))
    docs = docs.select("__text", SOURCE, listed.alias("__listed"), F.when(listed, F.col("__v")).otherwise(F.parse_json(F.lit("[null]"))).alias("__v"))
    rows = docs.lateralJoin(spark.tvf.variant_explode(F.col("__v").outer())).select("__text", SOURCE, "__listed", F.col("value").alias("__row"))
    cell = lambda i, kind: F.try_variant_get("__row", f"$[{i}]", kind)
    given = lambda i: cell(i, "variant").isNotNull() & ~F.is_variant_null(cell(i, "variant"))
    sound = F.col("__listed") & F.coalesce(F.schema_of_variant("__row").startswith("ARRAY"), F.lit(False))
    for i, f in enumerate(schema.fields):
        sound = sound & (cell(i, f.dataType.simpleString()).isNotNull() | ~given(i))
    rows = rows.withColumn("__sound", sound)
    return rows.select(*[F.when(F.col("__sound"), cell(i, f.dataType.simpleString())).alias(f.name) for i, f in enumerate(schema.fields)],
                       F.when(~F.col("__listed"), F.col("__text")).when(~F.col("__sound"), F.to_json("__row")).alias(CORRUPT), SOURCE)


def split_quarantine(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the two columns, quarantined records with their source)."""
    return rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, SOURCE), rows.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT, SOURCE)


def read_previous(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """SC7: the kept table, or an empty one with its schema on the first run."""
    try:
        return spark.read.format(fmt).schema(schema).load(path)
    except AnalysisException as e:
        if not _is_missing(e):
            raise
        return empty(spark, schema)


def read_range_sql(spark: SparkSession, sql: str, d1, d2) -> DataFrame:
    """SC8: a date-range query with bound parameters (``:d1``, ``:d2``)."""
    return spark.sql(sql, args={"d1": d1, "d2": d2})


def create_range_function(spark: SparkSession, name: str, view: str, columns: StructType, day_col: str = "d") -> None:
    """SC8 as a SQL table function: ``SELECT * FROM name(d1, d2)`` gives the rows of ``view`` with a day in
    [d1, d2]. The function is inlined, so both bounds reach the scan as filters."""
    listed = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(d1 DATE, d2 DATE) RETURNS TABLE ({listed}) "
              f"RETURN SELECT {', '.join(columns.names)} FROM {view} WHERE {view}.{day_col} >= {name}.d1 AND {view}.{day_col} <= {name}.d2")
