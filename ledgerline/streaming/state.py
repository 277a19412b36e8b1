"""Keyed state of the form stream: current forms, and signed deltas onto the touched days (ST1, ST2).

Three tables carry the stream from batch to batch; none of them is the log, which no batch reads:

* **forms**: for each form its latest delivery and what it counts for (``contributions``), as it
  was counted. Rows are appended under a hash bucket of the uid; a batch reads only the buckets
  of its own forms. A bucket with ``FOLD`` batches is written whole by the next batch that has a
  form of it; parts before a whole one are dropped a batch later.
* **days**: for each day with a contribution the sums by (agent, touchpoint), and the number of
  forms by (agent, touchpoint, account), which makes distinct accounts subtractable. A batch
  reads the touched days, adds what the new versions count for, subtracts what the old ones
  did, and writes these days anew.
* **activity_day** (and the member-level rows): the reports' table, its touched days replaced
  from the sums.

Every table is partitioned by the batch that wrote a part, and a batch reads only parts of
earlier batches, so a batch that failed half-way and is run again overwrites its own parts with
the same rows and adds nothing twice. The last parts before the current batch are kept until
the batch after, when Spark can no longer repeat it.

The driver holds the numbers of touched buckets and days, which the bucket count and the
calendar bound; forms never reach it. A form without a uid has no state and is not counted.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codes
from ..functions import columns as C
from ..operators.merge import replace_days
from ..plans import activity as A
from ..sources.files import read_previous

BUCKETS = 256  # of the forms table; must stay the same for a state folder
FOLD = 8       # batches in a bucket before it is written whole

CREATED = ["forms", "pending"]
SUBMITTED = ["calls", "in_call", *[m for m in codes.UTIL_MEASURES if m != "u_ipd"], *codes.DISPOSITION_COLUMNS]
MEASURES = [*CREATED, *SUBMITTED]


def contribution_type(account: T.DataType) -> T.StructType:
    """What a form counts for: on a day, for an agent and a touchpoint, measures; or (``account`` set) one account."""
    fields = [("d", T.DateType()), ("ag", T.StringType()), ("bk", T.StringType()), ("account", account), *[(m, T.LongType()) for m in MEASURES]]
    return T.StructType([T.StructField(*f) for f in fields])


def contributions(forms: DataFrame, member: DataFrame, services: DataFrame, tz: str = "UTC") -> DataFrame:
    """(uid, d, ag, bk, account, measures) of every form of ``forms``, one version each; the rules are those of the batch plans."""
    account = member.schema["account_uid"].dataType
    zero = {m: F.lit(0).cast("bigint").alias(m) for m in MEASURES}
    no_account = F.lit(None).cast(account).alias("account")

    base = A.form_base(forms, tz).filter((F.col("bk") != codes.OTHER_LABEL) & F.col("cd").isNotNull())
    created = base.select("form_uid", F.col("cd").alias("d"), "ag", "bk", "is_draft", "parent_doc_id")
    as_form = created.select("form_uid", "d", "ag", "bk", no_account,
                             *[{**zero, "forms": F.lit(1).cast("bigint").alias("forms"),
                                "pending": F.coalesce(F.col("is_draft").cast("bigint"), F.lit(0)).cast("bigint").alias("pending")}[m] for m in MEASURES])
    as_account = (A.with_member(created, member).filter(F.col("account_uid").isNotNull()).select("form_uid", "d", "ag", "bk", "account_uid").distinct()
                  .select("form_uid", "d", "ag", "bk", F.col("account_uid").alias("account"), *zero.values()))

    bs = A.with_member(A.submitted_forms(forms, None, None, tz).filter(F.col("sd").isNotNull()), member)
    matched = A.first_service_after(bs, services, tz, how="left")
    flags = {"in_call": F.col("in_call"), **C.utility_flags("claim_type", "service_id"), **C.disposition_flags("outcome")}
    flags = {m: flags[m] for m in SUBMITTED if m != "calls"}
    per_form = matched.groupBy("form_uid", F.col("sd").alias("d"), "ag", "bk").agg(*[F.bool_or(c).alias(m) for m, c in flags.items()])
    as_call = per_form.select("form_uid", "d", "ag", "bk", no_account,
                              *[{**zero, "calls": F.lit(1).cast("bigint").alias("calls"),
                                 **{m: F.coalesce(F.col(m).cast("bigint"), F.lit(0)).cast("bigint").alias(m) for m in flags}}[m] for m in MEASURES])
    return as_form.unionByName(as_account).unionByName(as_call).withColumnRenamed("form_uid", "uid")


def content_digest(columns: Sequence[str]) -> Column:
    """The content of a version; equal for equal rows only, but for collisions of 128 bits."""
    packed = F.to_json(F.struct(*columns))
    return F.concat(F.hex(F.xxhash64(packed)), F.hex(F.xxhash64(F.lit("form"), packed)))


def versions(deliveries: DataFrame) -> DataFrame:
    """One row per uid: the latest delivery by (landing time, file, content), its order ``o`` and its content's ``digest``.

    ``deliveries`` carries ``__t`` and ``__f``. Partial aggregation combines copies of a hot form before the shuffle.
    """
    cols = [c for c in deliveries.columns if c not in ("__t", "__f")]
    r = deliveries.filter(F.col("uid").isNotNull()).withColumn("digest", content_digest(cols))
    r = r.select("uid", F.struct("__t", "__f", "digest").alias("o"), F.struct(*cols).alias("r"))
    return r.groupBy("uid").agg(F.max_by(F.struct("o", "r"), "o").alias("x")).select("uid", "x.o", "x.r")


class FormState:
    """The state tables under ``path`` and the reports' tables, moved on by one batch at a time."""

    def __init__(self, spark: SparkSession, path: str, member: DataFrame, services: DataFrame, out_path: str,
                 tz: str = "UTC", raw_path: str | None = None, uid: T.DataType | None = None, buckets: int = BUCKETS):
        self.spark, self.path, self.member, self.services = spark, path.rstrip("/"), member, services
        self.out_path, self.raw_path, self.tz, self.buckets = out_path, raw_path, tz, buckets
        uid = uid or T.LongType()
        one = contribution_type(member.schema["account_uid"].dataType)
        order = T.StructType([T.StructField("__t", T.TimestampType()), T.StructField("__f", T.StringType()), T.StructField("digest", T.StringType())])
        self.forms_schema = T.StructType([T.StructField("uid", uid), T.StructField("o", order), T.StructField("counted", T.ArrayType(one)),
                                          T.StructField("h", T.IntegerType()), T.StructField("b", T.LongType()), T.StructField("whole", T.IntegerType())])
        self.days_schema = T.StructType([f for f in one.fields if f.name != "d"] + [T.StructField("n", T.LongType()), T.StructField("d", T.DateType()), T.StructField("b", T.LongType())])

    # -- parts by batch -----------------------------------------------------

    def _parts(self, table: str, keys: list[str]) -> dict[tuple[str, ...], list[str]]:
        """Partition folders two levels deep: {(first, second...): ...} for the given first-level names."""
        jvm = self.spark.sparkContext._jvm
        out: dict = {}
        for key in keys:
            p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}/{key}")
            fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            out[key] = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []
        return out

    def _drop(self, table: str, key: str, part: str) -> None:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}/{key}/{part}")
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def _read(self, table: str, schema: T.StructType, wanted: list[tuple]) -> DataFrame:
        """Rows of the wanted partitions alone; the filter reaches the listing of partitions."""
        rows = read_previous(self.spark, f"{self.path}/{table}", schema)
        if not wanted:
            return rows.limit(0)
        first = schema.fields[-3 if table == "forms" else -2].name
        by_part: dict[tuple, list] = {}
        for key, *part in wanted:
            by_part.setdefault(tuple(part), []).append(key)
        names = ["b", "whole"] if table == "forms" else ["b"]
        hit = [reduce(lambda x, y: x & y, [F.col(first).isin(keys), *[F.col(n) == v for n, v in zip(names, part, strict=True)]]) for part, keys in by_part.items()]
        return rows.filter(reduce(lambda x, y: x | y, hit))

    def _write(self, df: DataFrame, table: str, by: list[str]) -> None:
        (df.hint("rebalance", by[0]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{self.path}/{table}"))

    # -- forms ----------------------------------------------------------------

    def _forms_of(self, buckets: list[int], batch_id: int) -> tuple[DataFrame, list[int]]:
        """Kept rows of the buckets from batches before this one, and the buckets to write whole."""
        wanted, fold = [], []
        for key, parts in self._parts("forms", [f"h={h}" for h in buckets]).items():
            h = int(key[2:])
            found = sorted(int(p[2:]) for p in parts if p.startswith("b=") and int(p[2:]) < batch_id)
            whole = [b for b in found if f"whole={1}" in self._parts("forms", [f"{key}/b={b}"])[f"{key}/b={b}"]]
            start = whole[-1] if whole else -1
            for b in found:
                if b < start:
                    self._drop("forms", key, f"b={b}")
                else:
                    wanted.append((h, b, 1 if b == start else 0))
            if sum(b >= start for b in found) >= FOLD:
                fold.append(h)
        return self._read("forms", self.forms_schema, wanted), fold

    def apply(self, batch: DataFrame, batch_id: int) -> list[dt.date]:
        """Move the state on by a batch of deliveries (``__t``, ``__f`` beside the form); the touched days."""
        bucket = F.pmod(F.xxhash64("uid"), F.lit(self.buckets)).cast("int")
        scratch = f"{self.path}/work"
        fresh = self._kept_once(versions(batch).withColumn("h", bucket), f"{scratch}/versions")
        buckets = sorted(r.h for r in fresh.select("h").distinct().collect())
        if not buckets:
            return []
        kept, fold = self._forms_of(buckets, batch_id)
        old = kept.groupBy("uid", "h").agg(F.max_by(F.struct("o", "counted"), "o").alias("k")).select("uid", "h", "k.o", "k.counted")
        # A version that is older than the kept one changes nothing, nor does one with the same content.
        met = (fresh.alias("n").join(old.alias("k"), ["uid", "h"], "left")
               .filter(F.col("k.o").isNull() | (F.col("n.o") > F.col("k.o"))))
        met = self._kept_once(met.select("uid", "h", F.col("n.o").alias("o"), F.col("n.r").alias("r"), F.col("k.counted").alias("before"),
                                         F.coalesce(F.col("k.o.digest") == F.col("n.o.digest"), F.lit(False)).alias("same")), f"{scratch}/met")
        changed = met.filter(~F.col("same"))
        now = contributions(changed.select("r.*"), self.member, self.services, self.tz)
        fields = [f.name for f in contribution_type(self.member.schema["account_uid"].dataType).fields]
        now = now.groupBy("uid").agg(F.collect_list(F.struct(*fields)).alias("after"))  # one form: a few rows
        none = F.array().cast(self.forms_schema["counted"].dataType)
        new = self._kept_once(
            met.drop("r").join(now, "uid", "left")
            .select("uid", "h", "o", "same", F.coalesce("before", none).alias("before"),
                    F.when(F.col("same"), F.coalesce("before", none)).otherwise(F.coalesce("after", none)).alias("after")), f"{scratch}/new")
        days = self._apply_days(new.filter(~F.col("same")), fields, batch_id)
        rows = new.select("uid", "o", F.col("after").alias("counted"), "h", F.lit(batch_id).alias("b"), F.when(F.col("h").isin(fold), 1).otherwise(0).alias("whole") if fold else F.lit(0).alias("whole"))
        if fold:
            rest = old.filter(F.col("h").isin(fold)).join(new.select("uid"), "uid", "left_anti")
            rows = rows.unionByName(rest.select("uid", "o", "counted", "h", F.lit(batch_id).alias("b"), F.lit(1).alias("whole")))
        self._write(rows, "forms", ["h", "b", "whole"])
        if self.raw_path is not None:
            self._apply_raw(changed, new.filter(~F.col("same")))
        return days

    def _kept_once(self, df: DataFrame, path: str) -> DataFrame:
        """Written and read again, so later steps of the batch see one result; each batch overwrites the last one's."""
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # -- days -------------------------------------------------------------------

    def _apply_days(self, changed: DataFrame, fields: list[str], batch_id: int) -> list[dt.date]:
        one = lambda column, sign: changed.select(F.explode(column).alias("c")).select("c.*", F.lit(sign).cast("bigint").alias("sign"))
        signed = one("after", 1).unionByName(one("before", -1))
        keys = ["d", "ag", "bk", "account"]
        delta = signed.groupBy(*keys).agg(*[F.sum(F.col(m) * F.col("sign")).alias(m) for m in MEASURES],
                                          F.sum(F.when(F.col("account").isNotNull(), F.col("sign")).otherwise(0)).alias("n"))
        moved = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in [*MEASURES, "n"]])
        delta = self._kept_once(delta.filter(moved), f"{self.path}/work/delta")
        days = sorted(r.d for r in delta.select("d").distinct().collect())
        if not days:
            return []
        wanted = []
        for key, parts in self._parts("days", [f"d={d.isoformat()}" for d in days]).items():
            found = sorted(int(p[2:]) for p in parts if p.startswith("b=") and int(p[2:]) < batch_id)
            wanted += [(dt.date.fromisoformat(key[2:]), b) for b in found[-1:]]
            for b in found[:-1]:
                self._drop("days", key, f"b={b}")
        before = self._read("days", self.days_schema, wanted).drop("b")
        total = before.unionByName(delta).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in [*MEASURES, "n"]]).filter(moved)
        # A day whose last form has left keeps a row of zeros, so that its older part is not read again.
        mark = self.spark.createDataFrame([(d,) for d in days], "d date")
        for f in self.days_schema.fields[:-2]:
            mark = mark.withColumn(f.name, F.lit(0 if f.dataType == T.LongType() and f.name != "account" else None).cast(f.dataType))
        self._write(total.unionByName(mark.select(*total.columns)).withColumn("b", F.lit(batch_id).cast("bigint")), "days", ["d", "b"])
        sums = self._read("days", self.days_schema, [(d, batch_id) for d in days])
        replace_days(activity_rows(sums), self.out_path, days)
        return days

    def _apply_raw(self, changed: DataFrame, new: DataFrame) -> None:
        """Member-level rows: those of changed forms leave, their new ones come, on all days of both."""
        of = lambda column: new.select(F.explode(column).alias("c")).filter(F.col("c.calls") > 0).select("c.d")
        days = sorted(r.d for r in of("before").union(of("after")).distinct().collect())
        if not days:
            return
        fresh = A.reachout_raw(changed.select("r.*"), self.member, self.services, None, None, self.tz)
        kept = read_previous(self.spark, self.raw_path, fresh.schema).filter(F.col("d").isin(days))
        rows = kept.join(new.select(F.col("uid").alias("form_uid")), "form_uid", "left_anti").select(*fresh.columns).unionByName(fresh.filter(F.col("d").isin(days)))
        replace_days(rows, self.raw_path, days)


def activity_rows(sums: DataFrame) -> DataFrame:
    """The 25-column rows from a day's sums."""
    g = sums.groupBy("d", "ag", "bk").agg(F.count_if(F.col("account").isNotNull() & (F.col("n") > 0)).alias("accts"), *[F.sum(m).alias(m) for m in MEASURES])
    g = g.filter((F.col("forms") > 0) | (F.col("calls") > 0))
    named = {"bookings": F.col("in_call"), "u_ipd": F.lit(0)}
    return g.select(*codes.ACTIVITY_KEYS, *[named.get(m, F.col(m) if m in g.columns else None).cast("bigint").alias(m) for m in codes.ACTIVITY_MEASURES])
