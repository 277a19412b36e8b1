"""DuckDB oracle SQL for merges, snapshot metadata and the per-agent tables."""

from __future__ import annotations

from . import oracle_values as V
from .oracle import ACT_AS_OF, ACT_D1, ACT_D2, with_ctes
from .oracle_activity import FORM_BASE, created, form_base, measured, raw_ctes, rows_ctes, submitted

CUTOFF = "TIMESTAMP '2024-01-15 12:00:00'"
RUN_TS = "TIMESTAMP '2024-01-15 18:30:00'"
NOW_TS = "TIMESTAMP '2024-01-15 18:37:40'"
MEASURES = V.MEASURES
CONN = V.CONNECTED


def _slug(label: str) -> str:
    import re

    return re.sub(r"[^a-z0-9]+", "_", label.lower()).strip("_")


def _pre(*extra: str) -> str:
    stale = "forms_stale AS (SELECT * FROM forms WHERE created_at < " + CUTOFF + ")"
    return with_ctes(["forms", "member", "service"], FORM_BASE, stale, form_base("fbs", "forms_stale"), *extra)


def _backlog() -> str:
    return f"""
bl AS (
 SELECT ag, bk, COUNT(*) FILTER (WHERE cd = {ACT_AS_OF}) AS created_today_open,
  COUNT(*) FILTER (WHERE cd < {ACT_AS_OF}) AS overdue_open
 FROM fb WHERE is_draft = true AND bk <> 'Other' GROUP BY ag, bk)"""


def _with_all(cols: list[str]) -> str:
    sums = ", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in cols)
    return f"SELECT * FROM t UNION ALL SELECT 'ALL' AS agent, {sums} FROM t"


def tables_sql() -> dict[str, str]:
    cur = rows_ctes("cur", "fb", ACT_D1, ACT_D2)
    old = rows_ctes("old", "fbs", ACT_D1, ACT_AS_OF)
    new = rows_ctes("new", "fb", ACT_AS_OF, ACT_AS_OF)
    out = {}
    out["merge_day_slice"] = _pre(old, new) + """
SELECT * FROM old_rows WHERE d NOT IN (SELECT d FROM new_rows)
UNION ALL SELECT * FROM new_rows"""

    mtd = ",".join(x.strip() for x in [created("mc", "fb", f"cd >= {ACT_D1}"), submitted("mb", f"sd >= {ACT_D1} AND bk <> 'Other'"), measured("mk", "mb")])
    sel = []
    for m in MEASURES:
        if m in [*V.UTILITIES, "u_any"]:
            sel.append(f"CAST(COALESCE(o.{m}, 0) AS BIGINT) AS {m}")
        elif m in V.CREATED:
            sel.append(f"CAST(COALESCE(mc.{m}, 0) AS BIGINT) AS {m}")
        else:
            sel.append(f"CAST(COALESCE(mk.{m}, 0) AS BIGINT) AS {m}")
    out["merge_carry_forward"] = _pre(old, mtd) + f"""
SELECT k.d, k.ag, k.bk, {', '.join(sel)}
FROM (SELECT d, ag, bk FROM mc UNION SELECT d, ag, bk FROM mk) k
 LEFT JOIN mc ON mc.d = k.d AND mc.ag = k.ag AND mc.bk = k.bk
 LEFT JOIN mk ON mk.d = k.d AND mk.ag = k.ag AND mk.bk = k.bk
 LEFT JOIN old_rows o ON o.d = k.d AND o.ag = k.ag AND o.bk = k.bk"""

    oldr = raw_ctes("oldr", "fbs", ACT_D1, ACT_D2)
    newr = raw_ctes("newr", "fb", ACT_AS_OF, ACT_AS_OF)
    out["rolling_three_months"] = _pre(oldr, newr) + f"""
, kept AS (
 SELECT * REPLACE (strftime(d, '%m-%d') AS mmdd)
 FROM (SELECT * REPLACE (IF(form_uid % 5 = 0, CAST(d - INTERVAL 4 MONTH AS DATE), d) AS d) FROM oldr_raw))
SELECT * FROM (
 SELECT * FROM kept WHERE d IS DISTINCT FROM {ACT_AS_OF}
 UNION ALL SELECT * FROM newr_raw) u
WHERE d >= DATE '2023-11-01' AND d < DATE '2024-02-01'"""

    out["snapshot_meta"] = _pre(cur, _backlog()) + f"""
SELECT MIN(d) AS min_date, MAX(d) AS max_date, COUNT(*) AS n_rows,
 (SELECT COUNT(*) FROM bl) AS open_buckets,
 strftime({RUN_TS} + INTERVAL 330 MINUTE, '%d %b %Y, %I:%M %p') || ' IST' AS refreshed_at,
 CAST(greatest(0, floor(epoch({NOW_TS} - {RUN_TS}) / 60.0 + 0.5)) AS BIGINT) AS minutes_since
FROM cur_rows"""

    out["merge_kept_table"] = out["merge_day_slice"]
    out["retained_three_months"] = out["rolling_three_months"]
    out["written_snapshot_meta"] = out["snapshot_meta"]
    out["backlog_after_bad_extract"] = _pre(_backlog()) + "\nFROM bl"
    out["quarantined_backlog"] = _pre(_backlog()) + """
SELECT ag, bk, created_today_open, overdue_open, false AS quarantined, ag AS source_agent FROM bl WHERE ag NOT IN ('am.1', 'am.2')
UNION ALL SELECT DISTINCT NULL, NULL, NULL, NULL, true, ag FROM bl WHERE ag IN ('am.1', 'am.2')"""
    out["window_accounts"] = _pre() + """
, seen AS (
 SELECT cd, ag, bk, m.account_uid FROM fb LEFT JOIN member m ON m.individual_uid = parent_doc_id
 WHERE bk <> 'Other' AND cd BETWEEN DATE '2024-01-08' AND DATE '2024-01-20'),
daily AS (SELECT ag, count(DISTINCT account_uid) AS n FROM seen GROUP BY cd, ag, bk)
SELECT ag AS agent, CAST(sum(n) AS BIGINT) AS accts_sum, (SELECT count(DISTINCT account_uid) FROM seen WHERE seen.ag = daily.ag) AS accts_distinct FROM daily GROUP BY ag
UNION ALL SELECT 'ALL', CAST(sum(n) AS BIGINT), (SELECT count(DISTINCT account_uid) FROM seen) FROM daily"""

    sums = ", ".join(f"SUM({m}) AS {m}" for m in MEASURES)
    by_agent = f"ba AS (SELECT ag AS agent, {sums} FROM cur_rows GROUP BY ag)"
    conn = " + ".join(f"COALESCE({c}, 0)" for c in CONN)
    fcols = ["open_today", "overdue", "open_total", "forms_filled", "connected", "booked"]
    def funnel(rows: str, backlog: str) -> str:
        return f"""
ba AS (SELECT ag AS agent, {sums} FROM {rows} GROUP BY ag),
ob AS (SELECT ag AS agent, SUM(created_today_open) AS ct, SUM(overdue_open) AS od FROM {backlog} GROUP BY ag),
t AS (
 SELECT COALESCE(ba.agent, ob.agent) AS agent, CAST(COALESCE(ct, 0) AS BIGINT) AS open_today,
  CAST(COALESCE(od, 0) AS BIGINT) AS overdue, CAST(COALESCE(ct, 0) + COALESCE(od, 0) AS BIGINT) AS open_total,
  CAST(COALESCE(calls, 0) AS BIGINT) AS forms_filled, CAST({conn} AS BIGINT) AS connected,
  CAST(COALESCE(u_any, 0) AS BIGINT) AS booked
 FROM ba FULL OUTER JOIN ob ON ba.agent = ob.agent)"""

    out["agent_funnel"] = _pre(cur, _backlog(), funnel("cur_rows", "bl")) + _with_all(fcols)
    window = """
win AS (SELECT * FROM cur_rows WHERE d BETWEEN DATE '2024-01-08' AND DATE '2024-01-20' AND bk = 'Day 15'),
win_bl AS (SELECT * FROM bl WHERE bk = 'Day 15')"""
    out["agent_funnel_window"] = (_pre(cur, _backlog(), window, funnel("win", "win_bl"))
                                  + f"SELECT *, row_number() OVER (ORDER BY agent = 'ALL', booked DESC, agent) AS pos FROM ({_with_all(fcols)})")

    acc = [f"CAST(COALESCE(SUM(accts) FILTER (WHERE bk = '{b}'), 0) AS BIGINT) AS accts_{_slug(b)}" for b in V.TOUCHPOINTS]
    bkd = [f"CAST(COALESCE(SUM(u_any) FILTER (WHERE bk = '{b}'), 0) AS BIGINT) AS booked_{_slug(b)}" for b in V.TOUCHPOINTS]
    acc_names = [f"accts_{_slug(b)}" for b in V.TOUCHPOINTS]
    bkd_names = [f"booked_{_slug(b)}" for b in V.TOUCHPOINTS]
    out["touchpoint_pivot"] = _pre(cur) + f""",
p AS (SELECT ag AS agent, {', '.join(acc + bkd)} FROM cur_rows GROUP BY ag),
t AS (SELECT agent, CAST({' + '.join(acc_names)} AS BIGINT) AS accts_total, {', '.join(acc_names)},
  CAST({' + '.join(bkd_names)} AS BIGINT) AS booked_total, {', '.join(bkd_names)} FROM p)
""" + _with_all(["accts_total"] + acc_names + ["booked_total"] + bkd_names)

    ucols = V.UTILITIES
    out["utility_breakdown"] = _pre(cur, by_agent) + f""",
t AS (SELECT agent, CAST(u_any AS BIGINT) AS booked, {', '.join(f'CAST({u} AS BIGINT) AS {u}' for u in ucols)} FROM ba)
""" + _with_all(["booked"] + ucols)

    dcols = V.DISPOSITIONS
    out["disposition_breakdown"] = _pre(cur, by_agent) + f""",
t AS (SELECT agent, CAST({' + '.join(CONN)} AS BIGINT) AS connected,
  {', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in dcols)} FROM ba)
""" + _with_all(["connected"] + dcols)

    out["activity_kpis"] = _pre(cur) + f""",
g AS (SELECT CAST(COALESCE(SUM(accts), 0) AS BIGINT) AS accounts, CAST(COALESCE(SUM(u_any), 0) AS BIGINT) AS booked,
  CAST(COALESCE(SUM({' + '.join(CONN)}), 0) AS BIGINT) AS connected FROM cur_rows)
SELECT accounts, booked, connected,
 CASE WHEN accounts <> 0 THEN floor(1000.0 * connected / accounts + 0.5) / 10.0 END AS connected_pct,
 CASE WHEN connected <> 0 THEN floor(1000.0 * booked / connected + 0.5) / 10.0 END AS booked_pct
FROM g"""

    out["date_presets"] = _pre(cur) + """,
r AS (SELECT d, row_number() OVER (ORDER BY d DESC) AS rn FROM (SELECT DISTINCT d FROM cur_rows) x),
g AS (SELECT max(d) AS max_d, COALESCE(max(d) FILTER (WHERE rn = 2), min(d)) AS prev_d,
  COALESCE(max(d) FILTER (WHERE rn = 7), min(d)) AS seventh_d FROM r)
SELECT 'today' AS preset, max_d AS d_from, max_d AS d_to FROM g
UNION ALL SELECT 'mtd', CAST(date_trunc('month', max_d) AS DATE), max_d FROM g
UNION ALL SELECT 'yest', prev_d, prev_d FROM g
UNION ALL SELECT 'last7', seventh_d, max_d FROM g"""
    pods = str(V.PODS)
    buckets = "[" + ", ".join(f"'{b}'" for b in V.TOUCHPOINTS) + "]"
    out["selector_values"] = with_ctes(["forms", "member", "service", "agent_day"], FORM_BASE,
                                       cur, _backlog()) + f""",
v AS (
 SELECT DISTINCT * FROM (
  SELECT 'day' AS kind, strftime(d, '%Y-%m-%d') AS value FROM cur_rows
  UNION ALL SELECT 'agent', ag FROM cur_rows UNION ALL SELECT 'agent', ag FROM bl
  UNION ALL SELECT 'touchpoint', bk FROM cur_rows WHERE bk IN {tuple(V.TOUCHPOINTS)}
  UNION ALL SELECT 'touchpoint', bk FROM bl WHERE bk IN {tuple(V.TOUCHPOINTS)}
  UNION ALL SELECT 'pod', pod FROM agent_day WHERE list_position({pods}, pod) IS NOT NULL AND list_position({pods}, pod) > 0) x)
SELECT kind, value, row_number() OVER (PARTITION BY kind ORDER BY
  CASE WHEN kind = 'touchpoint' THEN list_position({buckets}, value) WHEN kind = 'pod' THEN list_position({pods}, value) END NULLS LAST, value) AS pos
FROM v"""
    return out
