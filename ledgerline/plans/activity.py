"""Account-manager reach-out activity.

Inputs: reach-out forms, the member dimension, the service (claim) log.
Outputs: created / call / utilisation activity per (day, agent, touchpoint),
the 25-column ``activity_day`` rows, the open backlog snapshot, and the
member-level dump.

Every job takes a day range ``[d1, d2]`` (``d2=None`` = open-ended, the
month-to-date form) and a zone ``tz`` for day boundaries. One code path serves
one day (the "today" refresh), a month, or a back-fill. Day filters are written
on the raw timestamp (half-open UTC bounds) so they reach the Parquet scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import columns as C
from ..operators import bitmaps as B
from ..operators import textindex as X
from ..operators.asof import forward_asof
from ..operators.distinct import distinct_counts

KEYS = codes.ACTIVITY_KEYS
# What the as-of join of forms and services goes by.
FIRST_SERVICE = {"by": "account_uid", "order": ["claim_creation_time", "service_id"], "values": ["claim_type"]}


def in_call_expr(tolerant: bool = False, parsed: bool = False) -> F.Column:
    flat = {g: {"booked": f"{g}_booked", "booking_id": f"{g}_booking_id", "hcu": f"{g}_hcu"}
            for g in codes.FLAT_GROUPS}
    docs = {g: f"{g}_info" for g in codes.JSON_GROUPS}
    return C.in_call(flat, docs, tolerant, parsed)


def form_base(forms: DataFrame, tz: str = "UTC") -> DataFrame:
    """SC2 + P7-P9, P12: kept forms with agent, touchpoint, local days, in-call flag.

    The form-info documents are parsed in a projection of their own. Spark keeps it apart, as
    each parse is read three times, so a document is parsed once.
    """
    return (forms
            .filter((F.col("form_type") == codes.FORM_TYPE) & F.col("assigned_to").isNotNull())
            .withColumns({f"{g}_info": C.form_info(f"{g}_info") for g in codes.JSON_GROUPS})
            .select(F.col("uid").alias("form_uid"), "parent_doc_id", "is_draft", "created_at", "submitted_at",
                    C.agent_of("assigned_to").alias("ag"),
                    C.local_date("created_at", tz).alias("cd"),
                    C.local_date("submitted_at", tz).alias("sd"),
                    "outcome",
                    in_call_expr(parsed=True).alias("in_call"),
                    C.bucket_label("reason").alias("bk"),
                    C.bucket_code("reason").alias("bk_code")))


def with_member(base: DataFrame, member: DataFrame, cols=("account_uid",), how: str = "left") -> DataFrame:
    """Left join to the member dimension (a form keeps its row when unmatched)."""
    m = member.select(F.col("individual_uid").alias("parent_doc_id"), *cols)
    return base.join(m, "parent_doc_id", how)


def unique_members(member: DataFrame, on_repeat: str = "first") -> DataFrame:
    """One row per member key, so that no join on it repeats a form.

    ``first`` keeps the row with the smallest account (a row with an account before one without),
    then the smallest mobile and name. ``error`` lets the query fail with the name of the repeated
    key, checked inside the plan. Rows without a key match no form and are left out.
    """
    rest = [c for c in member.columns if c != "individual_uid"]
    order = F.struct(*[x for c in sorted(rest, key=lambda c: (c != "account_uid", c)) for x in (F.col(c).isNull(), F.col(c))])
    g = member.filter(F.col("individual_uid").isNotNull()).groupBy("individual_uid")
    g = g.agg(F.min_by(F.struct(*rest), order).alias("r"), F.count(F.lit(1)).alias("n"))
    if on_repeat == "error":
        named = F.concat(F.lit("REPEATED_MEMBER_KEY: "), F.col("individual_uid").cast("string"))
        g = g.withColumn("r", F.when(F.col("n") == 1, F.col("r")).otherwise(F.raise_error(named).cast(g.schema["r"].dataType)))
    elif on_repeat != "first":
        raise ValueError(f"on_repeat: {on_repeat!r}")
    return g.select("individual_uid", *[F.col("r")[c].alias(c) for c in rest]).select(*member.columns)


def submitted_forms(forms: DataFrame, d1: dt.date | None, d2: dt.date | None, tz: str) -> DataFrame:
    """Submitted (non-draft) forms in the submitted-day range, touchpoint known."""
    f = forms.filter(F.col("is_draft") == F.lit(False))
    if d1 is not None:
        f = f.filter(C.in_local_days("submitted_at", d1, d2, tz))
    return form_base(f, tz).filter(F.col("bk") != codes.OTHER_LABEL)


def qualifying_services(services: DataFrame, tz: str = "UTC", d1: dt.date | None = None) -> DataFrame:
    """SC4: services that can count as utilisation (time known, OPD, not home
    medicine delivery, one of the kept statuses), with their local day. With ``d1``
    only services from that day on: an earlier one cannot follow a form of ``d1`` or later."""
    statuses = ", ".join(f"'{v}'" for v in codes.SERVICE_STATUSES)
    if d1 is not None:
        services = services.filter(C.in_local_days("claim_creation_time", d1, None, tz))
    return (services
            .filter(F.expr(f"claim_creation_time IS NOT NULL AND visit_type = '{codes.SERVICE_VISIT_TYPE}' "
                           f"AND claim_type <> '{codes.SERVICE_EXCLUDED_CLAIM}' AND status IN ({statuses})"))
            .select("account_uid", "service_id", "claim_type", "claim_creation_time",
                    C.local_date("claim_creation_time", tz).alias("service_day")))


def first_service_after(forms_with_account: DataFrame, services: DataFrame, tz: str = "UTC",
                        how: str = "left", d1: dt.date | None = None, accounts: DataFrame | None = None) -> DataFrame:
    """J2 (+ J3 with ``how='left'``): each form's first qualifying service whose
    day is on or after the form's submitted day; ties at the same instant go
    to the lower ``service_id``. ``d1``: the lowest submitted day, if known; ``accounts``: the forms' accounts, if known."""
    return forward_asof(forms_with_account, qualifying_services(services, tz, d1), left_day="sd", right_day="service_day", how=how, only=accounts, **FIRST_SERVICE)


# ----------------------------------------------------------- aggregates ---

def created_activity(forms: DataFrame, member: DataFrame, d1: dt.date, d2: dt.date | None,
                     tz: str = "UTC") -> DataFrame:
    """Per created day, agent, touchpoint -- distinct accounts, pending
    (draft) forms and forms. Drafts and submitted forms both count (H22).

    Two entities are counted distinctly (accounts and forms). Each row is
    tagged once as a form and once as an account (two rows, where Spark's own
    rewrite of three distinct aggregates would make three), reduced to one
    row per (keys, tag, id), then counted; null ids are not counted, as
    ``COUNT(DISTINCT ...)`` ignores them.
    """
    f = forms.filter(C.in_local_days("created_at", d1, d2, tz))
    base = with_member(form_base(f, tz).filter(F.col("bk") != codes.OTHER_LABEL), member)
    types = {base.schema["form_uid"].dataType, base.schema["account_uid"].dataType}
    id_type = types.pop() if len(types) == 1 else "string"
    tags = F.array(
        F.struct(F.lit(0).alias("tag"), F.col("form_uid").cast(id_type).alias("id"), F.col("is_draft").alias("draft")),
        F.struct(F.lit(1).alias("tag"), F.col("account_uid").cast(id_type).alias("id"),
                 F.lit(None).cast("boolean").alias("draft")))
    tagged = (base.select(F.col("cd").alias("d"), "ag", "bk", F.explode(tags).alias("t"))
              .select("d", "ag", "bk", "t.tag", "t.id", "t.draft")
              .filter(F.col("id").isNotNull()))
    per_id = tagged.groupBy("d", "ag", "bk", "tag", "id").agg(F.bool_or("draft").alias("draft"))
    return per_id.groupBy("d", "ag", "bk").agg(
        F.count_if(F.col("tag") == 1).alias("accts"),
        F.count_if((F.col("tag") == 0) & F.col("draft")).alias("pending"),
        F.count_if(F.col("tag") == 0).alias("forms"))


def account_bitmaps(forms: DataFrame, member: DataFrame, d1: dt.date, d2: dt.date | None, tz: str = "UTC") -> DataFrame:
    """Per created day, agent and touchpoint the accounts themselves, as bitmaps. Kept beside
    ``activity_day``, they give a window's distinct accounts, where its ``accts`` only add up."""
    f = forms.filter(C.in_local_days("created_at", d1, d2, tz))
    base = with_member(form_base(f, tz).filter(F.col("bk") != codes.OTHER_LABEL), member)
    return B.id_bitmaps(base, [F.col("cd").alias("d"), "ag", "bk"], "account_uid")


def call_activity(forms: DataFrame, d1: dt.date, d2: dt.date | None, tz: str = "UTC") -> DataFrame:
    """A10: per submitted day, agent, touchpoint -- calls, in-call bookings and
    the nine dispositions, each a distinct count of forms."""
    base = submitted_forms(forms, d1, d2, tz)
    flags = {"bookings": F.col("in_call"), **C.disposition_flags("outcome")}
    return distinct_counts(base, [F.col("sd").alias("d"), "ag", "bk"], "form_uid", flags, total="calls")


def utilisation_activity(forms: DataFrame, member: DataFrame, services: DataFrame, d1: dt.date,
                         d2: dt.date | None, tz: str = "UTC") -> DataFrame:
    """Per submitted day, agent, touchpoint -- calls, in-call, utilisation
    by the first service on/after the call (J2, J3) and the dispositions."""
    bs = with_member(submitted_forms(forms, d1, d2, tz), member)
    return utilisation_counts(first_service_after(bs, services, tz, how="left", d1=d1))


def utilisation_counts(matched: DataFrame) -> DataFrame:
    """A11 over submitted forms that carry their first service."""
    u = C.utility_flags("claim_type", "service_id")
    flags = {"in_call": F.col("in_call"),
             "u_tele": u["u_tele"], "u_scan": u["u_scan"], "u_tests": u["u_tests"], "u_visit": u["u_visit"],
             "u_opd": u["u_opd"], "u_other": u["u_other"], "u_any": u["u_any"],
             **C.disposition_flags("outcome")}
    return distinct_counts(matched, [F.col("sd").alias("d"), "ag", "bk"], "form_uid", flags, total="calls")


def activity_day(forms: DataFrame, member: DataFrame, services: DataFrame, d1: dt.date,
                 d2: dt.date | None, tz: str = "UTC") -> DataFrame:
    """Created measures (by created day) full-outer-joined with call and
    utilisation measures (by submitted day) on (day, agent, touchpoint); the
    25-column ``activity_day`` row, missing measures 0, IPD constant 0 (H20)."""
    c = created_activity(forms, member, d1, d2, tz)
    s = utilisation_activity(forms, member, services, d1, d2, tz)
    j = c.join(s, KEYS, "full")
    out = [F.col(k) for k in KEYS]
    for m in codes.ACTIVITY_MEASURES:
        if m == "bookings":
            out.append(F.coalesce(F.col("in_call"), F.lit(0)).cast("bigint").alias("bookings"))
        elif m == "u_ipd":
            out.append(F.lit(0).cast("bigint").alias("u_ipd"))
        else:
            out.append(F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias(m))
    return j.select(*out)


def open_backlog(forms: DataFrame, as_of: dt.date, tz: str = "UTC") -> DataFrame:
    """Drafts per agent and touchpoint -- created on ``as_of`` vs earlier.
    A point-in-time snapshot: every draft is read, whatever its day."""
    base = form_base(forms.filter(F.col("is_draft") == F.lit(True)), tz).filter(F.col("bk") != codes.OTHER_LABEL)
    return (base.groupBy("ag", "bk")
            .agg(F.count_if(F.col("cd") == F.lit(as_of)).alias("created_today_open"),
                 F.count_if(F.col("cd") < F.lit(as_of)).alias("overdue_open")))


# ------------------------------------------------------ member-level dump ---

def reachout_raw(forms: DataFrame, member: DataFrame, services: DataFrame, d1: dt.date,
                 d2: dt.date | None, tz: str = "UTC", include_pii: bool = False,
                 agent: str = "ALL", bucket: str = "ALL", query: str = "", member_index: str | None = None) -> DataFrame:
    """Member-level rows for forms submitted in [d1, d2]: day, agent, touchpoint,
    outcome, in-call and utility codes (P9-P11, P13, P15).

    The source dump carries mobile and name; they stay out unless asked for
    (H29). The day is a full date (the source keeps only MM-DD, H15/H16).
    Agent, touchpoint and text filters (F9, F10) are applied before the as-of join. With
    ``member_index`` (``index_members``) the members that hold ``query`` come from its postings,
    and only their forms go on.
    """
    f = forms.filter(F.col("is_draft") == F.lit(False))
    if d1 is not None:
        f = f.filter(C.in_local_days("submitted_at", d1, d2, tz))
    bs = form_base(f, tz).filter(F.col("bk_code") != codes.OTHER_CODE)
    member_cols = ("account_uid", "mobile", "full_name")
    accounts = None
    if member_index is not None and query.strip():
        found = X.search(member, "individual_uid", member_text(), member_index, query)
        bs = matching(with_member(bs, found, member_cols, "inner"), "ag", "bk_code", agent, bucket, "")
    else:
        bs = matching(with_member(bs, member, member_cols), "ag", "bk_code", agent, bucket, query)
        if query.strip():
            accounts = matching(member, "", "", "ALL", "ALL", query)
    matched = first_service_after(bs, services, tz, how="left", d1=d1, accounts=accounts)
    cols = [F.col("form_uid"), F.col("sd").alias("d"), C.month_day_string("sd").alias("mmdd"),
            F.col("ag").alias("agent")]
    if include_pii:
        cols += [F.col("mobile"), F.col("full_name")]
    cols += [F.col("bk_code").alias("bucket_code"),
             C.outcome_code("outcome").alias("outcome_code"),
             F.col("in_call").cast("int").alias("in_call"),
             C.utility_code("claim_type").alias("util_code")]
    return matched.select(*cols)


def member_text() -> F.Column:
    """What a member search looks in."""
    return F.concat(F.coalesce("mobile", F.lit("")), F.lit(" "), F.coalesce("full_name", F.lit("")))


def index_members(member: DataFrame, path: str) -> None:
    """write the trigram index of the members' mobile and name."""
    X.write_index(member, "individual_uid", member_text(), path)


def matching(df: DataFrame, agent_col: str, code_col: str, agent: str, bucket: str, query: str) -> DataFrame:
    """rows of an agent and a touchpoint whose mobile and name hold ``query``."""
    if agent != "ALL":
        df = df.filter(F.col(agent_col) == agent)
    if bucket != "ALL":
        df = df.filter(C.bucket_label_of_code(code_col) == bucket)
    q = query.strip().lower()
    if q:
        df = df.filter(F.instr(X.normal(member_text()), q) > 0)
    return df


def raw_page(searched: DataFrame, cap: int = codes.RAW_DISPLAY_CAP) -> tuple[DataFrame, DataFrame]:
    """The first ``cap`` rows for display and the uncapped count (the CSV
    export takes the uncapped rows)."""
    return searched.limit(cap), searched.agg(F.count(F.lit(1)).alias("n_rows"))


def raw_search(raw_with_pii: DataFrame, d1: dt.date | None = None, d2: dt.date | None = None,
               agent: str = "ALL", bucket: str = "ALL", query: str = "", booked_only: bool = False) -> DataFrame:
    """F9-F11 + P19: filter the member-level rows and decode them for display.

    ``query`` is trimmed and lower-cased and matched as a substring of
    ``mobile + ' ' + name``; ``booked_only`` keeps rows with a utility.
    Output is ordered date desc, agent asc (T8); the mobile is masked and the
    name left out.
    """
    r = raw_with_pii
    if d1 is not None:
        r = r.filter(F.col("d") >= F.lit(d1))
    if d2 is not None:
        r = r.filter(F.col("d") <= F.lit(d2))
    r = matching(r, "agent", "bucket_code", agent, bucket, query)
    if booked_only:
        r = r.filter(F.col("util_code") != 0)
    return (r.select("form_uid", "d", "agent",
                     C.pretty_agent("agent").alias("agent_name"),
                     C.mask_id("mobile").alias("mobile_masked"),
                     C.bucket_label_of_code("bucket_code").alias("touchpoint"),
                     C.outcome_label_of_code("outcome_code").alias("disposition"),
                     F.when(F.coalesce(F.col("in_call"), F.lit(0)) != 0, F.lit("yes")).otherwise(F.lit("no"))
                     .alias("booked_on_call"),
                     F.when(F.col("util_code") != 0, C.utility_label_of_code("util_code")).otherwise(F.lit(""))
                     .alias("utility_booked"))
            .orderBy(F.col("d").desc(), F.col("agent").asc(), F.col("form_uid").asc()))
