"""Activity from kept, co-partitioned tables: forms and services bucketed by account.

A refresh that recomputes utilisation every half hour would shuffle the service log each time.
Here both sides are written once, bucketed by account: the forms with their account, agent,
touchpoint and flags, and one row per account with its service days. Every later question joins
bucket to bucket; forms without an account, which can have no service, lie in a table of their
own and never meet the join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import asof
from . import activity as A

BUCKETS = 64  # grows with the tables: a bucket should fit a task


def keep_activity_sides(forms: DataFrame, member: DataFrame, services: DataFrame, name: str, base_path: str,
                        tz: str = "UTC", buckets: int = BUCKETS) -> None:
    """Write ``name_forms`` (and ``name_forms_unkeyed``) and ``name_services`` under ``base_path``."""
    base = base_path.rstrip("/")
    bs = A.with_member(A.submitted_forms(forms, None, None, tz), member)
    asof.keep_left(bs, f"{name}_forms", f"{base}/{name}_forms", "account_uid", buckets)
    asof.keep_lists(A.qualifying_services(services, tz), f"{name}_services", f"{base}/{name}_services", right_day="service_day", buckets=buckets, **A.FIRST_SERVICE)


def kept_matches(spark: SparkSession, name: str, d1: dt.date | None = None, d2: dt.date | None = None) -> DataFrame:
    """Each kept form submitted in [d1, d2] with its first service."""
    where = F.lit(True)
    if d1 is not None:
        where = where & (F.col("sd") >= F.lit(d1))
    if d2 is not None:
        where = where & (F.col("sd") <= F.lit(d2))
    return asof.kept_asof(spark, f"{name}_forms", f"{name}_services", left_day="sd", where=where, **A.FIRST_SERVICE)


def kept_utilisation(spark: SparkSession, name: str, d1: dt.date, d2: dt.date | None) -> DataFrame:
    """A11 from the kept tables."""
    return A.utilisation_counts(kept_matches(spark, name, d1, d2))


def drop_kept(spark: SparkSession, name: str) -> None:
    """Forget the tables (their files stay where they were written)."""
    for t in (f"{name}_forms", f"{name}_forms_unkeyed", f"{name}_services"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
