"""Substring search through an index of trigrams.

A full scan lower-cases and searches every row's text for each query. The index holds, for
every three characters that stand in a text, the keys of the texts that hold them
(``postings``), and how many keys each trigram has (``counts``). A query reads the counts of its
own trigrams, takes the rarest of them, and intersects their postings; the few keys left are
checked against the text itself by the caller or by ``search``, so the answer is exact.

Postings are partitioned by a hash of the trigram and sorted by it, so a query lists only its
trigrams' partitions and skips the other row groups in them; counts, a row per trigram, are sorted. A trigram that is in every text is
a long posting, but one that a query does not need to read. An index is written by as many tasks as
its postings need (``TASK_POSTINGS``): texts are dealt before they become postings, and postings by ranges
of (partition, trigram, key), so neither a large file nor a trigram of every text meets in one task. Queries under three characters have
no trigram; ``candidates`` gives None and the caller scans.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIZE = 3
PARTITIONS = 16   # of the postings; fixed for an index folder
RAREST = 3        # postings intersected for a query
TASK_POSTINGS = 1 << 20  # postings, repeats included, that a task of the writer takes


def normal(text: str | Column) -> Column:
    """The form in which texts and queries are compared."""
    return F.lower(F.col(text) if isinstance(text, str) else text)


def grams_of(query: str) -> list[str]:
    return sorted({query[i:i + SIZE] for i in range(len(query) - SIZE + 1)})


def _texts(rows: DataFrame, key: str, text: Column) -> DataFrame:
    """(key, t): the texts that have a trigram."""
    return rows.select(F.col(key).alias("key"), normal(text).alias("t")).filter(F.col("key").isNotNull() & (F.length("t") >= SIZE))


def _postings(texts: DataFrame) -> DataFrame:
    """(gram, key, p), each once, in ranges of (p, gram, key) and sorted within them."""
    n = texts.agg(F.sum(F.length("t") - (SIZE - 1))).first()[0] or 0
    tasks = max(1, -(-n // TASK_POSTINGS))
    gram = F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("t") - (SIZE - 1)), lambda i: F.substring(F.col("t"), i, F.lit(SIZE)))))
    posted = (texts.repartition(tasks, "key", "t").distinct().select(gram.alias("gram"), "key")
              .withColumn("p", F.pmod(F.crc32(F.col("gram").cast("binary")), F.lit(PARTITIONS)).cast("int")))
    # Equal postings lie in one range: they are made distinct there, where a reading task would first hold all of its own.
    return posted.repartitionByRange(tasks, "p", "gram", "key").distinct().sortWithinPartitions("p", "gram", "key")


def write_index(rows: DataFrame, key: str, text: Column, path: str) -> None:
    """Write ``postings`` and ``counts`` of ``text`` under ``path``; null keys and texts are in no posting."""
    base = path.rstrip("/")
    posted = _postings(_texts(rows, key, text))
    posted.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("p").parquet(f"{base}/postings")
    kept = rows.sparkSession.read.schema(posted.schema).parquet(f"{base}/postings")
    kept.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{base}/counts")


def _of_grams(spark: SparkSession, path: str, schema: str, grams: list[str]) -> DataFrame:
    parts = sorted({zlib.crc32(g.encode()) % PARTITIONS for g in grams})
    return spark.read.schema(schema).parquet(path).filter(F.col("p").isin(parts) & F.col("gram").isin(grams))


def candidates(spark: SparkSession, path: str, query: str, key_type: str = "bigint") -> DataFrame | None:
    """(key): a superset of the keys whose text holds ``query``, from the postings alone; None where the query is too short for the index."""
    base = path.rstrip("/")
    grams = grams_of(query)
    if not grams:
        return None
    # As many rows as the query has trigrams, at most.
    counts = spark.read.schema("gram string, n long").parquet(f"{base}/counts").filter(F.col("gram").isin(grams))
    found = {r.gram: r.n for r in counts.collect()}
    if len(found) < len(grams):
        return spark.createDataFrame([], f"key {key_type}")
    rare = sorted(grams, key=lambda g: (found[g], g))[:RAREST]
    posted = _of_grams(spark, f"{base}/postings", f"gram string, key {key_type}, p int", rare)
    if len(rare) == 1:
        return posted.select("key")
    return posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(rare)).select("key")


def search(rows: DataFrame, key: str, text: Column, path: str, query: str) -> DataFrame:
    """The rows whose text holds ``query`` (any case, outer blanks ignored), exact."""
    q = query.strip().lower()
    if not q:
        return rows
    keys = candidates(rows.sparkSession, path, q, rows.schema[key].dataType.simpleString())
    if keys is not None:
        rows = rows.join(keys.select(F.col("key").alias(key)), key, "left_semi")
    return rows.filter(F.instr(normal(text), q) > 0)
