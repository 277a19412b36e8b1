"""Logical source tables, derived by Spark from the driver's Parquet tables.

The reports read five operational tables (renewal retention, reach-out forms,
members, services, agent-day metrics). Their stand-ins are column derivations
over whole driver tables -- no row subsets -- so every job's work grows with
the data. The same definitions, in DuckDB SQL, are in ``ledgerline.oracle``.

Anchor dates: retention ``as_of = 1998-06-01``; activity ``as_of = 2024-01-15``
(events run 2024-01-01 .. 2024-01-30).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.columns import MONEY
from .tables import read_table

RETENTION_AS_OF = dt.date(1998, 6, 1)
ACTIVITY_AS_OF = dt.date(2024, 1, 15)
ACTIVITY_FIRST_DAY = dt.date(2024, 1, 1)
ACTIVITY_LAST_DAY = dt.date(2024, 1, 31)
LEGACY_BEFORE = dt.date(1997, 1, 1)


def _case(key, pairs, default=None):
    chain = None
    for k, v in pairs:
        chain = F.when(key == k, F.lit(v)) if chain is None else chain.when(key == k, F.lit(v))
    return chain.otherwise(F.lit(default)) if default is not None else chain


def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policy retention rows: one per order (account x policy year)."""
    o = read_table(spark, sf_dir, "orders",
                   ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    k = F.col("o_orderkey")
    pri = F.col("o_orderpriority")
    price = F.col("o_totalprice").cast(MONEY)
    renewed_flag = pri.isin("1-URGENT", "2-HIGH")
    return (o.join(c, o.o_custkey == c.c_custkey, "inner")
            .select(
                _case(F.col("o_orderstatus"), [("F", "CLINIC"), ("O", "OFFLINE"), ("P", "ONLINE")]).alias("channel"),
                # old policies of one desk: neither renewed nor in a window
                F.when((k % 10 == 1) & ~renewed_flag & (F.to_date("o_orderdate") < F.lit(LEGACY_BEFORE)), F.lit("Legacy desk"))
                 .when(k % 7 == 0, F.lit("")).when(k % 11 == 0, F.lit(None).cast("string"))
                 .otherwise(F.col("c_mktsegment")).alias("renewal_deal_owner"),
                F.when(pri == "4-NOT SPECIFIED", F.lit(None).cast("boolean")).otherwise(renewed_flag).alias("is_renewed"),
                (F.lit(1) + k % 5).cast("int").alias("year"),
                F.when(k % 17 == 0, F.lit(None).cast("date")).otherwise(F.to_date("o_orderdate")).alias("current_policy_end"),
                F.when(k % 13 == 0, F.lit(None).cast(MONEY)).otherwise(price).alias("current_policy_amount"),
                F.when(renewed_flag, (price - (k % 97)).cast(MONEY)).alias("renewed_amount"),
                k.cast("string").alias("account_uid"),
                F.when(k % 3 == 0, F.lit("")).otherwise(pri).alias("reason_for_not_renewing"),
            ))


def reachout_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reach-out forms: every signup event is a form."""
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "props"])
    eid = F.col("event_id")
    uid = F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("int")
    reasons = [(0, "DAY_FIFTEEN"), (1, "DAY_SEVENTY_FIVE"), (2, "DAY_ONE_HUNDRED_FIFTY"),
               (3, "DAY_TWO_HUNDRED_TEN"), (4, "DAY_TWO_HUNDRED_SEVENTY"), (5, "OVERDUE_OPD_CLAIM"),
               (6, "BAD_CSAT_X"), (7, "ENGMT_INACTIVE_ACCOUNT"), (8, "MISC")]
    outcomes = [(0, "INTERESTED"), (1, "INTERESTED_NSA"), (2, "DNP"), (3, "DNP_REALLOCATE"),
                (4, "RESCHEDULED"), (5, "DND"), (6, "IGNORED"), (7, "WAIT_AND_WATCH"),
                (8, "LANGUAGE_BARRIER"), (9, "OPEN_ND"), (10, "OPEN_REIMBURSEMENT"), (11, "SOMETHING_NEW")]
    day15 = [(0, '{"booked_during_call":true}'),
             (1, '{"booking_id":"b1","hcu_booking":"NOT_BOOKED"}'),
             (2, '{"booking_id":"","hcu_booking":"NOT_BOOKED"}'),
             (3, '{"hcu_booking":"BOOK_ON_CALL"}'),
             (4, '{"booked_during_call":null,"hcu_booking":"NOT_BOOKED"}'),
             (5, '{"booked_during_call":false,"hcu_booking":"NOT_BOOKED"}'),
             (7, "{}"), (8, '{"hcu_booking":"NOT_BOOKED"}'), (9, '{"hcu_booking":"NOT_BOOKED"}')]
    null_s = F.lit(None).cast("string")
    return (e.filter(F.col("event_type") == "signup")
            .select(
                eid.alias("uid"),
                uid.alias("parent_doc_id"),
                F.when(eid % 37 == 0, F.lit("ONBOARDING_CALL")).otherwise(F.lit(codes.FORM_TYPE)).alias("form_type"),
                F.when(eid % 31 != 0, eid % 4 == 0).alias("is_draft"),
                F.col("ts").alias("created_at"),
                F.when(eid % 4 != 0, F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("submitted_at"),
                F.when(eid % 29 == 0, null_s)
                 .otherwise(F.concat(F.lit("am."), (uid % 6).cast("string"), F.lit("@x.io"))).alias("assigned_to"),
                _case(k % 10, reasons).alias("reason"),
                _case(eid % 13, outcomes).alias("outcome"),
                (eid % 9 == 0).alias("day75_booked"),
                null_s.alias("day75_booking_id"),
                F.when(eid % 5 == 0, null_s).otherwise(F.lit("NOT_BOOKED")).alias("day75_hcu"),
                F.lit(None).cast("boolean").alias("day150_booked"),
                F.when(eid % 11 == 0, F.lit("b150")).when(eid % 11 == 1, F.lit("")).alias("day150_booking_id"),
                F.lit("NOT_BOOKED").alias("day150_hcu"),
                _case(eid % 10, day15).alias("day15_info"),
                F.when(eid % 5 == 1, null_s).otherwise(F.lit('{"hcu_booking":"NOT_BOOKED"}')).alias("day210_info"),
                F.lit('{"hcu_booking":"NOT_BOOKED","booking_id":null}').alias("day270_info"),
            ))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member dimension: one row per customer; one key in ten has no account."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    key = F.col("c_custkey")
    return c.select(
        key.alias("individual_uid"),
        F.when(key % 10 == 9, F.lit(None).cast("bigint")).otherwise(key).alias("account_uid"),
        F.concat(F.lit("9"), F.lpad(key.cast("string"), 9, "0")).alias("mobile"),
        F.col("c_name").alias("full_name"),
    )


def services(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service (claim) log: every non-signup event is a claim."""
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    eid = F.col("event_id")
    claims = [(0, "IN_HOUSE_CONSULT"), (1, "SCANNER"), (2, "HOME_COLLECTION"), (3, "NETWORK_VISIT"),
              (4, "OPD_VISIT"), (5, "REIMBURSEMENT"), (6, "MEDICINE_HOME_DELIVERY"), (7, "DENTAL")]
    return (e.filter(F.col("event_type") != "signup")
            .select(
                eid.alias("service_id"),
                F.col("user_id").alias("account_uid"),
                F.when(F.col("event_type") == "error", F.lit("CANCELLED")).otherwise(F.lit("ACTIVE")).alias("status"),
                F.when(eid % 5 == 0, F.lit("IPD")).otherwise(F.lit("OPD")).alias("visit_type"),
                _case(eid % 9, claims).alias("claim_type"),
                F.when(eid % 23 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("ts")).alias("claim_creation_time"),
            ))


def agent_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support-agent metrics per day: events grouped by day and user bucket."""
    e = read_table(spark, sf_dir, "events", ["ts", "user_id", "event_type", "value"])
    a = F.col("user_id") % 8
    et = F.col("event_type")
    v = F.col("value")
    grouped = (e.select(F.to_date("ts").alias("d"), a.alias("a"), et.alias("et"), v.alias("v"))
               .groupBy("d", "a")
               .agg(F.count(F.lit(1)).alias("total_bucket"),
                    F.count_if(F.col("et") == "error").alias("open_bucket"),
                    F.count_if(F.col("et") == "purchase").alias("resolved_cum"),
                    F.avg(F.when(F.col("et") == "view", F.col("v"))).alias("first_response_secs"),
                    (F.lit(2) * F.avg(F.when(F.col("et") == "click", F.col("v")))).alias("every_chat_response_secs"),
                    F.avg(F.when(F.col("et") == "error", F.col("v"))).alias("resolution_time_secs"),
                    F.avg(F.when(F.col("et") == "purchase", F.col("v"))).alias("_p")))
    return grouped.select(
        "d",
        F.concat(F.lit("agent"), F.col("a").cast("string")).alias("name"),
        _case(F.col("a") % 3, [(0, codes.PODS[0]), (1, codes.PODS[1])], codes.PODS[2]).alias("pod"),
        # one agent is off on every sixth day of a month
        F.when((F.col("a") == 4) & (F.dayofmonth("d") % 6 == 0), F.lit(0).cast("bigint")).otherwise(F.col("total_bucket"))
         .alias("total_bucket"),
        "open_bucket", "resolved_cum",
        "first_response_secs", "every_chat_response_secs", "resolution_time_secs",
        F.when(F.col("a") == 7, F.lit(None).cast("double"))
         .otherwise(F.lit(3.5) + F.col("_p") / F.lit(60.0)).alias("csat"),
        F.when(F.col("a") == 7, F.lit(0).cast("bigint")).otherwise(F.col("resolved_cum")).alias("csat_n"),
    )
