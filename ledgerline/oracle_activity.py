"""DuckDB oracle SQL for the reach-out activity queries.

Codes are decoded by joining the fixed tables of ``oracle_values``. Each submitted form
names the measures it counts in (one row per form and measure), and a pivot counts the
distinct forms of each; the first service is the ordered first row among all that follow.
"""

from __future__ import annotations

from . import oracle_values as V
from .oracle import ACT_AS_OF, ACT_D1, ACT_D2, _q, with_ctes


def _in_call() -> str:
    """Booked in the call by any of the five groups; else unknown if some group's health check-up is null."""
    flat, docs = ["day75", "day150"], ["day15_info", "day210_info", "day270_info"]
    read = lambda column, key: "[" + ", ".join([f"{g}_{column}" for g in flat] + [f"json_extract_string({d}, '$.{key}')" for d in docs]) + "]"
    flags = "[" + ", ".join([f"{g}_booked" for g in flat] + [f"CAST(json_extract_string({d}, '$.booked_during_call') AS BOOLEAN)" for d in docs]) + "]"
    return (f"CASE WHEN list_contains({flags}, true) OR len(list_filter({read('booking_id', 'booking_id')}, lambda x: x <> '')) > 0 "
            f"OR list_contains({read('hcu', 'hcu_booking')}, 'BOOK_ON_CALL') THEN true "
            f"WHEN len(list_filter({read('hcu', 'hcu_booking')}, lambda x: x IS NULL)) > 0 THEN NULL ELSE false END")


def form_base(name: str = "fb", src: str = "forms") -> str:
    return f"""
{name} AS (
 SELECT uid AS form_uid, parent_doc_id, is_draft, created_at, submitted_at,
  split_part(assigned_to, '@', 1) AS ag, CAST(created_at AS DATE) AS cd, CAST(submitted_at AS DATE) AS sd,
  {_in_call()} AS in_call, COALESCE(r.bk, 'Other') AS bk, COALESCE(r.bk_code, 9) AS bk_code,
  COALESCE(o.outcome_code, 8) AS outcome_code, o.measure AS disposition
 FROM {src} f
  LEFT JOIN reasons r ON CASE WHEN r.by_pattern THEN f.reason LIKE r.reason ELSE f.reason = r.reason END
  LEFT JOIN outcomes o ON o.outcome IS NOT DISTINCT FROM f.outcome
 WHERE form_type = 'POSTSALES_REACHOUT' AND assigned_to IS NOT NULL)"""


# The services that can follow a contact, with what they count as.
USABLE = """
usable AS (
 SELECT account_uid, claim_creation_time, service_id, claim_type, COALESCE(claims.util_code, 6) AS util_code,
  COALESCE(claims.measure, 'u_other') AS measure
 FROM service LEFT JOIN claims USING (claim_type)
 WHERE status IN (FROM counted_statuses) AND visit_type = 'OPD' AND claim_type <> 'MEDICINE_HOME_DELIVERY'
  AND claim_creation_time IS NOT NULL)"""

FORM_BASE = V.CODE_TABLES.strip() + "," + USABLE + "," + form_base()


def submitted(name: str, where: str, src: str = "fb") -> str:
    return f"""
{name} AS (
 SELECT b.*, m.account_uid, m.mobile, m.full_name
 FROM {src} b LEFT JOIN member m ON m.individual_uid = b.parent_doc_id WHERE NOT is_draft AND {where})"""


def first_service(name: str, src: str) -> str:
    return f"""
{name} AS (
 SELECT form_uid, unnest(hit) FROM (
  SELECT b.form_uid, first(u ORDER BY u.claim_creation_time, u.service_id) AS hit
  FROM {src} b JOIN usable u ON u.account_uid = b.account_uid AND u.claim_creation_time >= b.sd
  GROUP BY b.form_uid))"""


def created(name: str, src: str, where: str) -> str:
    return f"""
{name} AS (
 SELECT cd AS d, ag, bk, len(list_distinct(list(m.account_uid))) AS accts,
  len(list_distinct(list(IF(is_draft, form_uid, NULL)))) AS pending, len(list_distinct(list(form_uid))) AS forms
 FROM {src} LEFT JOIN member m ON m.individual_uid = parent_doc_id
 WHERE {where} AND bk <> 'Other' GROUP BY ALL)"""


def measured(name: str, src: str, services: str | None = None) -> str:
    """Distinct forms per (d, ag, bk) and measure."""
    tags = ["'calls'", "IF(f.in_call, 'bookings', NULL)", "f.disposition"]
    if services:
        tags += ["h.measure", "IF(h.form_uid IS NULL, NULL, 'u_any')"]
    columns = V.CALLS + V.DISPOSITIONS + ([*V.UTILITIES, "u_any"] if services else [])
    joined = f"LEFT JOIN {services} h ON h.form_uid = f.form_uid" if services else ""
    return f"""
{name}_tags AS (SELECT f.sd AS d, f.ag, f.bk, f.form_uid, unnest([{", ".join(tags)}]) AS tag FROM {src} f {joined}),
{name} AS (PIVOT {name}_tags ON tag IN ({_q(columns)}) USING count(DISTINCT form_uid) GROUP BY d, ag, bk)"""


def rows_ctes(p: str, fb: str, d1: str, d2: str) -> str:
    """CTEs ending in ``{p}_rows``: the 25-column activity rows for days d1..d2 from form base ``fb``."""
    measures = ", ".join(f"CAST(COALESCE({m}, 0) AS BIGINT) AS {m}" for m in V.MEASURES)
    rows = f"""
{p}_rows AS (SELECT d, ag, bk, {measures} FROM {p}_c FULL OUTER JOIN {p}_s USING (d, ag, bk))"""
    return ",".join(x.strip() for x in [
        submitted(f"{p}_bs", f"sd BETWEEN {d1} AND {d2} AND bk <> 'Other'", fb), first_service(f"{p}_fs", f"{p}_bs"),
        measured(f"{p}_s", f"{p}_bs", f"{p}_fs"), created(f"{p}_c", fb, f"cd BETWEEN {d1} AND {d2}"), rows])


def raw_ctes(p: str, fb: str, d1: str, d2: str, pii: bool = False) -> str:
    """CTEs ending in ``{p}_raw``: member-level rows for days d1..d2."""
    raw = f"""
{p}_raw AS (
 SELECT b.form_uid, b.sd AS d, strftime(b.sd, '%m-%d') AS mmdd, b.ag AS agent, {"b.mobile, b.full_name, " if pii else ""}
  b.bk_code AS bucket_code, b.outcome_code, CAST(b.in_call AS INTEGER) AS in_call, COALESCE(h.util_code, 0) AS util_code
 FROM {p}_bs b LEFT JOIN {p}_fs h ON h.form_uid = b.form_uid)"""
    return ",".join(x.strip() for x in [submitted(f"{p}_bs", f"sd BETWEEN {d1} AND {d2} AND bk_code <> 9", fb),
                                        first_service(f"{p}_fs", f"{p}_bs"), raw])


def _labels(values: list[str]) -> str:
    return f"[{_q(values)}]"


def activity_sql() -> dict[str, str]:
    pre = with_ctes(["forms", "member", "service"], FORM_BASE)
    utilities = ", ".join(u for u in [*V.UTILITIES, "u_any"] if u != "u_ipd")
    dispositions = ", ".join(V.DISPOSITIONS)
    out = {}
    out["activity_created"] = pre + "," + created("c", "fb", f"cd >= {ACT_D1}").strip() + "\nFROM c"
    out["activity_call"] = (pre + "," + submitted("bs", f"sd >= {ACT_D1} AND bk <> 'Other'").strip() + ","
                            + measured("s", "bs").strip() + f"\nSELECT d, ag, bk, calls, bookings, {dispositions} FROM s")
    rows = pre + "," + rows_ctes("t", "fb", ACT_D1, ACT_D2)
    out["activity_utilisation"] = rows + f"\nSELECT d, ag, bk, calls, bookings AS in_call, {utilities}, {dispositions} FROM t_s"
    out["activity_today"] = rows + "\nFROM t_rows"
    out["open_backlog"] = (pre + f"""
SELECT ag, bk, COUNT(*) FILTER (WHERE cd = {ACT_AS_OF}) AS created_today_open,
 COUNT(*) FILTER (WHERE cd < {ACT_AS_OF}) AS overdue_open
FROM fb WHERE is_draft = true AND bk <> 'Other' GROUP BY ag, bk""")
    out["first_service_after"] = (pre + "," + submitted("bs", "true").strip() + "," + first_service("fs", "bs").strip() + """
SELECT bs.form_uid, bs.account_uid, bs.sd, fs.claim_creation_time, fs.service_id, fs.claim_type
FROM bs JOIN fs USING (form_uid)""")
    raw = pre + "," + raw_ctes("r", "fb", ACT_D1, ACT_D2, pii=True)
    out["reachout_raw"] = raw + "\nSELECT * EXCLUDE (mobile, full_name) FROM r_raw"
    out["raw_search"] = raw + f"""
SELECT form_uid, d, agent,
 array_to_string(list_transform(string_split_regex(agent, '[._]'), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') AS agent_name,
 CASE WHEN COALESCE(mobile, '') = '' THEN '-' ELSE left(mobile, 4) || '…' || right(mobile, 3) END AS mobile_masked,
 {_labels(V.TOUCHPOINTS)}[bucket_code + 1] AS touchpoint, {_labels(V.OUTCOME_LABELS)}[outcome_code + 1] AS disposition,
 CASE WHEN COALESCE(in_call, 0) <> 0 THEN 'yes' ELSE 'no' END AS booked_on_call,
 CASE WHEN util_code <> 0 THEN {_labels(V.UTILITY_LABELS)}[util_code + 1] ELSE '' END AS utility_booked
FROM r_raw
WHERE position('{RAW_QUERY}' IN lower(COALESCE(mobile, '') || ' ' || COALESCE(full_name, ''))) > 0"""
    out["raw_search_indexed"] = out["raw_search"]
    out["created_since_mid_month"] = pre + "," + created("c", "fb", "cd >= DATE '2024-01-10'").strip() + "\nFROM c"
    out["calls_in_range"] = pre + """
SELECT ag, bk, count(DISTINCT form_uid) AS calls, min(sd) AS first_day, max(sd) AS last_day
FROM fb WHERE NOT is_draft AND bk <> 'Other' AND sd BETWEEN DATE '2024-01-08' AND DATE '2024-01-20' GROUP BY ag, bk"""
    decoded = f"""
decoded AS (
 SELECT *, {_labels(V.TOUCHPOINTS)}[bucket_code + 1] AS touchpoint, {_labels(V.OUTCOME_LABELS)}[outcome_code + 1] AS disposition,
  IF(in_call = 1, 'yes', 'no') AS booked_on_call, IF(util_code = 0, '', {_labels(V.UTILITY_LABELS)}[util_code + 1]) AS utility_booked
 FROM r_raw)"""
    out["raw_csv_rows"] = raw + "," + decoded.strip() + """
SELECT strftime(d, '%Y-%m-%d') AS date, agent AS account_manager, COALESCE(mobile, '') AS mobile, COALESCE(full_name, '') AS member,
 touchpoint, disposition, booked_on_call, utility_booked
FROM decoded"""
    out["raw_page_booked"] = raw + "," + decoded.strip() + """
SELECT form_uid, d, agent, touchpoint, disposition, booked_on_call, utility_booked,
 row_number() OVER (ORDER BY d DESC, agent, form_uid) AS pos
FROM decoded WHERE d BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' AND agent = 'am.3' AND utility_booked <> ''
QUALIFY pos <= 3000"""
    out["raw_page_counted"] = raw + "," + decoded.strip() + """
SELECT form_uid, d, agent, touchpoint, disposition, booked_on_call, utility_booked,
 row_number() OVER (ORDER BY d DESC, agent, form_uid) AS pos, count(*) OVER () AS n_rows
FROM decoded QUALIFY pos <= 3000"""
    out["activity_positional_rows"] = rows + f"""
SELECT CAST(json_array(strftime(d, '%Y-%m-%d'), ag, bk, {', '.join(V.MEASURES)}) AS VARCHAR) AS value FROM t_rows"""
    return out


# The registered search: a name fragment shared by a handful of members.
RAW_QUERY = "#00000012"
