"""Column-returning helpers: every per-row rule of the reports.

All helpers build Catalyst expressions, so they stay inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import codes

MONEY = "decimal(18,2)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ref(c: str) -> str:
    """SQL reference to a (possibly nested) column name."""
    return ".".join(f"`{p}`" for p in c.split("."))


def _lit(v) -> str:
    return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v)


def _in(ref: str, values) -> str:
    return f"{ref} IN ({', '.join(_lit(v) for v in values)})"

# The fixed code maps below are emitted as one SQL expression each when the
# input is a column name: the JVM parses it in one call, where the builder
# form costs a round trip per node. Both forms are the same Catalyst tree.


# ---------------------------------------------------------------- dates ---

def ntz_literal(value: dt.datetime | dt.date) -> Column:
    """A timezone-free timestamp literal (folds to a constant, pushes down)."""
    if isinstance(value, dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    else:
        text = value.strftime("%Y-%m-%d 00:00:00")
    return F.lit(text).cast("timestamp_ntz")


def local_date(ts: str | Column, tz: str = "UTC") -> Column:
    """Calendar day of a UTC wall-clock timestamp seen from zone ``tz``."""
    c = col(ts).cast("timestamp_ntz")
    if tz == "UTC":
        return F.to_date(c)
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), c))


def utc_bounds(d1: dt.date, d2: dt.date, tz: str = "UTC") -> tuple[dt.datetime, dt.datetime]:
    """Half-open UTC range [lo, hi) of the local days d1..d2 (inclusive).

    Filtering ``ts >= lo AND ts < hi`` instead of ``to_date(ts) BETWEEN`` keeps
    the predicate on the raw column, so it reaches the Parquet scan.
    """
    from zoneinfo import ZoneInfo

    zone = ZoneInfo(tz)
    lo = dt.datetime.combine(d1, dt.time(), zone).astimezone(dt.timezone.utc).replace(tzinfo=None)
    hi = dt.datetime.combine(d2 + dt.timedelta(days=1), dt.time(), zone)
    return lo, hi.astimezone(dt.timezone.utc).replace(tzinfo=None)


def in_local_days(ts: str | Column, d1: dt.date, d2: dt.date | None, tz: str = "UTC") -> Column:
    """Pushdown-friendly ``local_date(ts) BETWEEN d1 AND d2`` (d2 None = open)."""
    lo, hi = utc_bounds(d1, d2 or d1, tz)
    c = col(ts)
    cond = c >= ntz_literal(lo)
    if d2 is not None:
        cond = cond & (c < ntz_literal(hi))
    return cond


def days_to(end: str | Column, as_of: dt.date) -> Column:
    """``end::date - as_of`` in whole days (null end -> null)."""
    return F.datediff(F.to_date(col(end)), F.lit(as_of))


def days_since(end: str | Column, as_of: dt.date) -> Column:
    """``as_of - end::date`` in whole days."""
    return F.datediff(F.lit(as_of), F.to_date(col(end)))


def day_string(d: str | Column) -> Column:
    """``to_char(d, 'YYYY-MM-DD')``."""
    return F.date_format(col(d), "yyyy-MM-dd")


def month_day_string(d: str | Column) -> Column:
    """``to_char(d, 'MM-DD')``."""
    return F.date_format(col(d), "MM-dd")


def month_start(as_of: dt.date) -> dt.date:
    """``date_trunc('month', as_of)``."""
    return as_of.replace(day=1)


# -------------------------------------------------------------- strings ---

def owner_or_unassigned(owner: str | Column) -> Column:
    """Null or '' -> 'Unassigned' (no trim)."""
    o = col(owner)
    return F.when(F.coalesce(o, F.lit("")) == "", F.lit(codes.UNASSIGNED)).otherwise(o)


def money_or_zero(x: str | Column) -> Column:
    """``COALESCE(x, 0)::numeric`` as an exact decimal."""
    return F.coalesce(col(x).cast(MONEY), F.lit(0).cast(MONEY))


def empty_to_null(x: str | Column) -> Column:
    """P5: ``NULLIF(x, '')``."""
    return F.nullif(col(x), F.lit(""))


def agent_of(address: str | Column) -> Column:
    """``split_part(address, '@', 1)``; no '@' keeps the whole string."""
    return F.split_part(col(address), F.lit("@"), F.lit(1))


def pretty_agent(agent: str | Column) -> Column:
    """P20: split on '.'/'_', upper-case each word's first letter, join by ' '."""
    words = F.split(col(agent), "[._]", -1)
    cap = F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30)))
    return F.array_join(cap, " ")


def mask_id(uid: str | Column) -> Column:
    """First 4 + '…' + last 3; '-' when empty."""
    u = col(uid)
    return F.when(F.coalesce(u, F.lit("")) == "", F.lit("-")).otherwise(
        F.concat(F.left(u, F.lit(4)), F.lit("…"), F.right(u, F.lit(3))))


# ------------------------------------------------------------- rounding ---

def round_whole(x: str | Column) -> Column:
    """``ROUND(numeric)`` half away from zero, as a whole number."""
    return F.round(col(x), 0).cast("bigint")


def exact_scaled(x: Column, places: int, ties: str) -> Column:
    """``x * 10**places`` rounded to a whole number on the exact value of the double.

    ``x`` is not negative. Its fraction is a whole number of 2**-62 (smaller bits lie under
    any tie), so the comparison with one half is exact. Rounding the shortest decimal text of
    the double instead would call values ties that are not. ``ties``: ``even`` or ``up``.
    """
    x = x.cast("double")
    whole = F.floor(x).cast("bigint")
    unit = F.lit(1 << 62).cast("decimal(38,0)")
    part = ((x - whole) * F.lit(float(1 << 62))).cast("bigint").cast("decimal(20,0)") * F.lit(2 * 10 ** places).cast("decimal(6,0)")
    low = F.floor(part / (unit * 2)).cast("bigint")
    # Decimal division rounds; step back where it rounded up to a whole number.
    low = F.when(low.cast("decimal(6,0)") * unit * 2 > part, low - 1).otherwise(low)
    rest = part - low.cast("decimal(6,0)") * unit * 2
    odd = (whole * F.lit(10 ** places) + low) % 2 == 1
    up = (rest > unit) | ((rest == unit) & (odd if ties == "even" else F.lit(True)))
    return whole * F.lit(10 ** places) + low + up.cast("bigint")


def fixed_text(x: Column, places: int) -> Column:
    """``toFixed(places)``: the nearest decimal to the double's exact value, the larger of two equally near."""
    q = exact_scaled(x, places, "up")
    if places == 0:
        return q.cast("string")
    return F.concat(F.floor(q / F.lit(10 ** places)).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((q % F.lit(10 ** places)).cast("string"), places, "0"))


def pct_half_even(n: str | Column, d: str | Column) -> Column:
    """``round(100.0*n/d, 1) if d else 0``; Python rounds the exact value of the double, halves to even."""
    n, d = col(n), col(d)
    x = F.lit(100.0) * n / d
    size = exact_scaled(F.abs(x), 1, "even") / F.lit(10.0)
    return F.when(d != 0, F.when(x < 0, -size).otherwise(size)).otherwise(F.lit(0.0))


def pct_half_up(a: str | Column, b: str | Column) -> Column:
    """``Math.round(1000*a/b)/10``; null (shown as a dash) when b is 0."""
    a, b = col(a), col(b)
    return F.when(b != 0, F.floor(F.lit(1000.0) * a / b + F.lit(0.5)) / F.lit(10.0))


def pct_class(p: str | Column) -> Column:
    """>=50 good, >=30 warn, else bad."""
    p = col(p)
    return (F.when(p >= codes.PCT_GOOD, F.lit("good"))
            .when(p >= codes.PCT_WARN, F.lit("warn")).otherwise(F.lit("bad")))


def _scaled(n: Column, unit: int, places: int) -> Column:
    """n/unit as a double, to ``places`` decimals as text (``toFixed``)."""
    return fixed_text(n.cast("double") / F.lit(float(unit)), places)


def money_label(n: str | Column) -> Column:
    """P22: '-', '₹x.xxCr' (>=1e7), '₹x.xL' (>=1e5), '₹xk' (>=1e3), else '₹n'.

    Whole-rupee inputs; the quotient is a double and rounds as ``fixed_text`` does.
    """
    n = col(n).cast("bigint")
    return (F.when(n.isNull(), F.lit("-"))
            .when(n >= 10_000_000, F.concat(F.lit("₹"), _scaled(n, 10_000_000, 2), F.lit("Cr")))
            .when(n >= 100_000, F.concat(F.lit("₹"), _scaled(n, 100_000, 1), F.lit("L")))
            .when(n >= 1_000, F.concat(F.lit("₹"), _scaled(n, 1_000, 0), F.lit("k")))
            .otherwise(F.concat(F.lit("₹"), n.cast("string"))))


def duration_label(secs: str | Column) -> Column:
    """P23: '-', 'Ns' under a minute, else 'Nm' or 'Nm Ns' (zero seconds dropped)."""
    v = F.floor(col(secs) + F.lit(0.5)).cast("bigint")
    m = F.floor(v / F.lit(60)).cast("bigint")
    s = v % F.lit(60)
    return (F.when(col(secs).isNull(), F.lit("-"))
            .when(v < 60, F.concat(v.cast("string"), F.lit("s")))
            .otherwise(F.concat(m.cast("string"), F.lit("m"),
                                F.when(s != 0, F.concat(F.lit(" "), s.cast("string"), F.lit("s")))
                                .otherwise(F.lit("")))))


def minutes_since(generated: str | Column, now: str | Column) -> Column:
    """P25: ``max(0, round((now - generated) / 60 s))``."""
    secs = F.unix_timestamp(col(now).cast("timestamp")) - F.unix_timestamp(col(generated).cast("timestamp"))
    return F.greatest(F.lit(0), F.floor(secs / F.lit(60.0) + F.lit(0.5)).cast("bigint"))


# ------------------------------------------------------------ touchpoints ---

def bucket_label(reason: str | Column) -> Column:
    """Reason code -> touchpoint label; unknown or null -> 'Other'."""
    if isinstance(reason, str):
        r = _ref(reason)
        arms = [f"WHEN {r} = {_lit(code)} THEN {_lit(label)}" for code, label, _ in codes.REASONS]
        arms.append(f"WHEN {r} LIKE {_lit(codes.BAD_CSAT_PATTERN)} THEN {_lit(codes.BAD_CSAT_LABEL)}")
        arms.append(f"WHEN {r} = {_lit(codes.ENGAGEMENT_REASON)} THEN {_lit(codes.ENGAGEMENT_LABEL)}")
        return F.expr(f"CASE {' '.join(arms)} ELSE {_lit(codes.OTHER_LABEL)} END")
    r = col(reason)
    chain = None
    for code, label, _ in codes.REASONS:
        chain = (F.when(r == code, F.lit(label)) if chain is None else chain.when(r == code, F.lit(label)))
    return (chain.when(r.like(codes.BAD_CSAT_PATTERN), F.lit(codes.BAD_CSAT_LABEL))
            .when(r == codes.ENGAGEMENT_REASON, F.lit(codes.ENGAGEMENT_LABEL))
            .otherwise(F.lit(codes.OTHER_LABEL)))


def bucket_code(reason: str | Column) -> Column:
    """Reason code -> 0..5, 7, BAD_CSAT% -> 6, else 9."""
    if isinstance(reason, str):
        r = _ref(reason)
        arms = [f"WHEN {r} = {_lit(code)} THEN {num}" for code, _, num in codes.REASONS]
        arms.append(f"WHEN {r} = {_lit(codes.ENGAGEMENT_REASON)} THEN {codes.ENGAGEMENT_CODE}")
        arms.append(f"WHEN {r} LIKE {_lit(codes.BAD_CSAT_PATTERN)} THEN {codes.BAD_CSAT_CODE}")
        return F.expr(f"CASE {' '.join(arms)} ELSE {codes.OTHER_CODE} END")
    r = col(reason)
    chain = None
    for code, _, num in codes.REASONS:
        chain = (F.when(r == code, F.lit(num)) if chain is None else chain.when(r == code, F.lit(num)))
    return (chain.when(r == codes.ENGAGEMENT_REASON, F.lit(codes.ENGAGEMENT_CODE))
            .when(r.like(codes.BAD_CSAT_PATTERN), F.lit(codes.BAD_CSAT_CODE))
            .otherwise(F.lit(codes.OTHER_CODE)))


def bucket_label_of_code(code: str | Column) -> Column:
    """Touchpoint code -> label (unknown -> null)."""
    return F.try_element_at(F.array(*[F.lit(b) for b in codes.BUCKETS]), F.try_add(col(code), F.lit(1)))


def outcome_code(outcome: str) -> Column:
    """P10: outcome -> 0..7; anything else, null included, -> 8."""
    arms = [f"WHEN {_in(_ref(outcome), values)} THEN {num}" for _, values, num, _ in codes.DISPOSITIONS]
    return F.expr(f"CASE {' '.join(arms)} ELSE {codes.NO_OUTCOME_CODE} END")


def outcome_label_of_code(code: str | Column) -> Column:
    """Outcome code -> disposition label."""
    return F.try_element_at(F.array(*[F.lit(x) for x in codes.DISPOSITION_LABELS]), F.try_add(col(code), F.lit(1)))


def disposition_flags(outcome: str) -> dict[str, Column]:
    """The nine disposition predicates (``dno`` = outcome IS NULL only)."""
    r = _ref(outcome)
    flags = {name: F.expr(_in(r, values)) for name, values, _, _ in codes.DISPOSITIONS}
    flags["dno"] = F.expr(f"{r} IS NULL")
    return flags


def utility_code(claim_type: str) -> Column:
    """Null -> 0, five groups -> 1..5, anything else -> 6."""
    r = _ref(claim_type)
    arms = [f"WHEN {r} IS NULL THEN {codes.UTIL_NONE_CODE}"]
    arms += [f"WHEN {_in(r, values)} THEN {num}" for _, values, num, _ in codes.UTILITIES]
    return F.expr(f"CASE {' '.join(arms)} ELSE {codes.UTIL_OTHER_CODE} END")


def utility_label_of_code(code: str | Column) -> Column:
    return F.try_element_at(F.array(*[F.lit(x) for x in codes.UTIL_CODE_LABELS]), F.try_add(col(code), F.lit(1)))


def utility_flags(claim_type: str, matched: str) -> dict[str, Column]:
    """Utilisation predicates over the as-of service claim type.

    ``u_other`` is ``claim_type NOT IN (...)``: a null claim is in no group.
    ``u_any`` is "a service was found". IPD is a constant 0 in the source.
    """
    r = _ref(claim_type)
    flags = {name: F.expr(_in(r, values)) for name, values, _, _ in codes.UTILITIES}
    known = [v for _, values, _, _ in codes.UTILITIES for v in values]
    flags["u_other"] = F.expr(f"NOT ({_in(r, known)})")
    flags["u_any"] = F.expr(f"{_ref(matched)} IS NOT NULL")
    return flags


# -------------------------------------------------------------- in-call ---

# A form-info document's three keys, as text (like the source's ``->>``).
FORM_INFO = "struct<booked_during_call:string,booking_id:string,hcu_booking:string>"


def form_info(doc: str) -> Column:
    """A form-info document parsed into its three keys."""
    return F.expr(f"from_json({_ref(doc)}, '{FORM_INFO}')")


def in_call(flat: dict[str, dict[str, str]], docs: dict[str, str], tolerant: bool = False, parsed: bool = False) -> Column:
    """Booked during the call, OR of 15 terms with SQL null semantics.

    ``flat[group] = {"booked": col, "booking_id": col, "hcu": col}`` for the
    flattened groups, ``docs[group] = json column`` for the JSON groups. The
    ``booked`` and ``booking_id`` terms are never null; the ``hcu`` terms are
    null when the key is missing, so the result is true, false or null
    (``false OR null`` is null). A ``booked_during_call`` text that is not a
    boolean raises, as in the source; ``tolerant=True`` reads it as null.
    ``parsed=True``: the document columns are ``form_info`` columns of an earlier
    projection, so that each document is parsed once and not once per key.
    """
    def js(doc: str, key: str) -> str:
        return f"{_ref(doc)}.{key}" if parsed else f"from_json({_ref(doc)}, '{FORM_INFO}').{key}"

    cast = "TRY_CAST" if tolerant else "CAST"
    terms = [f"coalesce({cast}({_ref(flat[g]['booked'])} AS BOOLEAN), false)" for g in codes.FLAT_GROUPS]
    terms += [f"coalesce({cast}({js(docs[g], 'booked_during_call')} AS BOOLEAN), false)" for g in codes.JSON_GROUPS]
    terms += [f"(nullif({_ref(flat[g]['booking_id'])}, '') IS NOT NULL)" for g in codes.FLAT_GROUPS]
    terms += [f"(nullif({js(docs[g], 'booking_id')}, '') IS NOT NULL)" for g in codes.JSON_GROUPS]
    terms += [f"({_ref(flat[g]['hcu'])} = {_lit(codes.BOOK_ON_CALL)})" for g in codes.FLAT_GROUPS]
    terms += [f"({js(docs[g], 'hcu_booking')} = {_lit(codes.BOOK_ON_CALL)})" for g in codes.JSON_GROUPS]
    return F.expr(" OR ".join(terms))


def connected(cols: dict[str, Column] | None = None) -> Column:
    """connected = di + dre + ddnd + dww + dlb + dop."""
    return reduce(lambda a, b: a + b, [(cols or {}).get(c, F.col(c)) for c in codes.CONNECTED_COLUMNS])
