"""Independent DuckDB SQL for every registered query (the correctness oracle).

Renewals: every policy gets its status band once, by joining the band table; accounts and
premiums are counted once per (channel, owner, cycle, band), and each report reads those
counts. It runs over the same stand-in views as ``ledgerline.sources.standins`` and takes
its fixed values from ``oracle_values``, so it shares nothing with the Spark plans.
Views ``orders customer events`` are registered by the caller.
"""

from __future__ import annotations

from . import oracle_values as V

RET_AS_OF = "DATE '1998-06-01'"
ACT_AS_OF = "DATE '2024-01-15'"
ACT_D1 = "DATE '2024-01-01'"
ACT_D2 = "DATE '2024-01-31'"


def _q(values):
    return ",".join("'" + v.replace("'", "''") + "'" for v in values)


STANDINS = {
    "retention": """
retention AS (
 SELECT CASE o_orderstatus WHEN 'F' THEN 'CLINIC' WHEN 'O' THEN 'OFFLINE' WHEN 'P' THEN 'ONLINE' END AS channel,
  CASE WHEN o_orderkey % 10 = 1 AND o_orderpriority NOT IN ('1-URGENT','2-HIGH') AND CAST(o_orderdate AS DATE) < DATE '1997-01-01' THEN 'Legacy desk'
   WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS renewal_deal_owner,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority IN ('1-URGENT','2-HIGH') END AS is_renewed,
  CAST(1 + o_orderkey % 5 AS INTEGER) AS year,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS current_policy_end,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS current_policy_amount,
  CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH')
       THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) - (o_orderkey % 97) AS DECIMAL(18,2)) END AS renewed_amount,
  CAST(o_orderkey AS VARCHAR) AS account_uid,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END AS reason_for_not_renewing
 FROM orders JOIN customer ON c_custkey = o_custkey)""",
    "forms": """
forms AS (
 SELECT event_id AS uid, user_id AS parent_doc_id, IF(event_id % 37 = 0, 'ONBOARDING_CALL', 'POSTSALES_REACHOUT') AS form_type,
  IF(event_id % 31 = 0, NULL, event_id % 4 = 0) AS is_draft, ts AS created_at,
  CASE WHEN event_id % 4 <> 0 THEN ts + INTERVAL 1 DAY END AS submitted_at,
  CASE WHEN event_id % 29 = 0 THEN NULL ELSE 'am.' || CAST(user_id % 6 AS VARCHAR) || '@x.io' END AS assigned_to,
  CASE CAST(props->>'k' AS INTEGER) % 10 WHEN 0 THEN 'DAY_FIFTEEN' WHEN 1 THEN 'DAY_SEVENTY_FIVE'
   WHEN 2 THEN 'DAY_ONE_HUNDRED_FIFTY' WHEN 3 THEN 'DAY_TWO_HUNDRED_TEN' WHEN 4 THEN 'DAY_TWO_HUNDRED_SEVENTY'
   WHEN 5 THEN 'OVERDUE_OPD_CLAIM' WHEN 6 THEN 'BAD_CSAT_X' WHEN 7 THEN 'ENGMT_INACTIVE_ACCOUNT' WHEN 8 THEN 'MISC' END AS reason,
  CASE event_id % 13 WHEN 0 THEN 'INTERESTED' WHEN 1 THEN 'INTERESTED_NSA' WHEN 2 THEN 'DNP' WHEN 3 THEN 'DNP_REALLOCATE'
   WHEN 4 THEN 'RESCHEDULED' WHEN 5 THEN 'DND' WHEN 6 THEN 'IGNORED' WHEN 7 THEN 'WAIT_AND_WATCH'
   WHEN 8 THEN 'LANGUAGE_BARRIER' WHEN 9 THEN 'OPEN_ND' WHEN 10 THEN 'OPEN_REIMBURSEMENT' WHEN 11 THEN 'SOMETHING_NEW' END AS outcome,
  (event_id % 9 = 0) AS day75_booked,
  CAST(NULL AS VARCHAR) AS day75_booking_id,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'NOT_BOOKED' END AS day75_hcu,
  CAST(NULL AS BOOLEAN) AS day150_booked,
  CASE WHEN event_id % 11 = 0 THEN 'b150' WHEN event_id % 11 = 1 THEN '' END AS day150_booking_id,
  'NOT_BOOKED' AS day150_hcu,
  CASE event_id % 10 WHEN 0 THEN '{"booked_during_call":true}'
   WHEN 1 THEN '{"booking_id":"b1","hcu_booking":"NOT_BOOKED"}'
   WHEN 2 THEN '{"booking_id":"","hcu_booking":"NOT_BOOKED"}'
   WHEN 3 THEN '{"hcu_booking":"BOOK_ON_CALL"}'
   WHEN 4 THEN '{"booked_during_call":null,"hcu_booking":"NOT_BOOKED"}'
   WHEN 5 THEN '{"booked_during_call":false,"hcu_booking":"NOT_BOOKED"}'
   WHEN 7 THEN '{}' WHEN 8 THEN '{"hcu_booking":"NOT_BOOKED"}' WHEN 9 THEN '{"hcu_booking":"NOT_BOOKED"}' END AS day15_info,
  CASE WHEN event_id % 5 = 1 THEN NULL ELSE '{"hcu_booking":"NOT_BOOKED"}' END AS day210_info,
  '{"hcu_booking":"NOT_BOOKED","booking_id":null}' AS day270_info
 FROM events WHERE event_type = 'signup')""",
    "member": """
member AS (
 SELECT c_custkey AS individual_uid, CASE WHEN c_custkey % 10 = 9 THEN NULL ELSE c_custkey END AS account_uid,
  '9' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS mobile, c_name AS full_name
 FROM customer)""",
    "service": """
service AS (
 SELECT event_id AS service_id, user_id AS account_uid,
  CASE WHEN event_type = 'error' THEN 'CANCELLED' ELSE 'ACTIVE' END AS status,
  CASE WHEN event_id % 5 = 0 THEN 'IPD' ELSE 'OPD' END AS visit_type,
  CASE event_id % 9 WHEN 0 THEN 'IN_HOUSE_CONSULT' WHEN 1 THEN 'SCANNER' WHEN 2 THEN 'HOME_COLLECTION'
   WHEN 3 THEN 'NETWORK_VISIT' WHEN 4 THEN 'OPD_VISIT' WHEN 5 THEN 'REIMBURSEMENT'
   WHEN 6 THEN 'MEDICINE_HOME_DELIVERY' WHEN 7 THEN 'DENTAL' END AS claim_type,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE ts END AS claim_creation_time
 FROM events WHERE event_type <> 'signup')""",
    "agent_day": """
agent_day AS (
 SELECT CAST(ts AS DATE) AS d, 'agent' || CAST(user_id % 8 AS VARCHAR) AS name,
  CASE user_id % 8 % 3 WHEN 0 THEN 'B2C Postsales' WHEN 1 THEN 'Postsales - Hindi' ELSE 'Hospital PS' END AS pod,
  IF(user_id % 8 = 4 AND day(CAST(ts AS DATE)) % 6 = 0, 0, count(*)) AS total_bucket,
  count(*) FILTER (WHERE event_type = 'error') AS open_bucket,
  count(*) FILTER (WHERE event_type = 'purchase') AS resolved_cum,
  avg(value) FILTER (WHERE event_type = 'view') AS first_response_secs,
  2 * avg(value) FILTER (WHERE event_type = 'click') AS every_chat_response_secs,
  avg(value) FILTER (WHERE event_type = 'error') AS resolution_time_secs,
  CASE WHEN user_id % 8 = 7 THEN NULL ELSE 3.5 + (avg(value) FILTER (WHERE event_type = 'purchase')) / 60.0 END AS csat,
  CASE WHEN user_id % 8 = 7 THEN 0 ELSE count(*) FILTER (WHERE event_type = 'purchase') END AS csat_n
 FROM events GROUP BY CAST(ts AS DATE), user_id % 8)""",
}

RENEWAL_BASE = V.STATUS_BANDS.strip() + f""",
policies AS (
 SELECT channel, COALESCE(NULLIF(renewal_deal_owner, ''), 'Unassigned') AS owner, year AS cycle, account_uid,
  NULLIF(reason_for_not_renewing, '') AS reason, date_diff('day', current_policy_end, {RET_AS_OF}) AS days_overdue,
  IF(is_renewed, 'renewed', band) AS status,
  COALESCE(current_policy_amount, 0.00::DECIMAL(18,2)) AS due, COALESCE(renewed_amount, 0.00::DECIMAL(18,2)) AS paid
 FROM retention LEFT JOIN status_bands
  ON is_renewed = false AND date_diff('day', {RET_AS_OF}, current_policy_end) BETWEEN from_day AND to_day
 WHERE list_contains([{_q(V.RENEWAL_CHANNELS)}], channel) AND list_contains([1, 2, 3, 4], year)),
tally AS (
 SELECT channel, owner, cycle, COALESCE(status, 'none') AS status, count(*) AS n, sum(due) AS due, sum(paid) AS paid
 FROM policies GROUP BY ALL)"""


def with_ctes(names: list[str], *extra: str) -> str:
    parts = [STANDINS[n] for n in names] + list(extra)
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


_STATUSES = ["not_in_window", "outreach", "grace_early", "grace_late", "overdue", "renewed", "none"]
_WINDOW = ["outreach", "grace_early", "grace_late"]


def by_status(name: str, keys: str) -> str:
    """One row per key: accounts of each status, and whole rupees (null where no account has the status)."""
    count = lambda group: "CAST(" + " + ".join(f"COALESCE({x}_n, 0)" for x in group) + " AS BIGINT)"
    rupees = lambda group, what: "CAST(round(list_sum([" + ", ".join(f"{x}_{what}" for x in group) + "])) AS BIGINT)"
    return f"""
{name}_wide AS (
 PIVOT tally ON status IN ({_q(_STATUSES)}) USING sum(n) AS n, sum(due) AS due, sum(paid) AS paid GROUP BY {keys}),
{name}_counts AS (
 SELECT {keys}, {", ".join(f"{count([x])} AS {x}" for x in _STATUSES[:-1])}, {count(_STATUSES)} AS total,
  {count(_WINDOW)} AS in_window, {count(_WINDOW[1:])} AS grace, {rupees(_WINDOW, "due")} AS rupees_in_window,
  {rupees(["overdue"], "due")} AS rupees_overdue, {rupees(["renewed"], "paid")} AS rupees_renewed
 FROM {name}_wide)"""


FUNNEL_SQL = by_status("channel", "channel") + f""",
funnel AS (SELECT channel, {", ".join(V.FUNNEL_COLUMNS)} FROM channel_counts)"""

LEADER_SQL = by_status("owner", "channel, owner") + f""",
leader AS (
 SELECT channel, owner, {", ".join(V.LEADER_COLUMNS)} FROM (SELECT *, total AS total_accts FROM owner_counts)
 WHERE greatest(in_window, renewed) >= 1)"""

CYCLE_SQL = """
cyc AS (
 SELECT channel, cycle, CAST(sum(n) AS BIGINT) AS total, CAST(sum(IF(status = 'renewed', n, 0)) AS BIGINT) AS renewed,
  CAST(round(sum(due)) AS BIGINT) AS old_premium, CAST(round(sum(paid)) AS BIGINT) AS renewed_amt
 FROM tally GROUP BY channel, cycle)"""

WATCH_SQL = f"""
watch AS (
 SELECT channel, owner, account_uid, cycle, CAST(days_overdue AS INTEGER) AS days_overdue, CAST(round(due) AS BIGINT) AS old_premium, reason
 FROM policies WHERE status = 'overdue'
 QUALIFY row_number() OVER (ORDER BY old_premium DESC, account_uid) <= {V.WATCHLIST_ROWS})"""

_FK, _LK = V.FUNNEL_COLUMNS, V.LEADER_COLUMNS

FUNNEL_ALL_SQL = """
fz AS (SELECT channel, """ + ", ".join(f"CAST(COALESCE({k}, 0) AS BIGINT) AS {k}" for k in _FK) + """ FROM funnel),
fall AS (SELECT * FROM fz UNION ALL
 SELECT 'ALL', """ + ", ".join(f"CAST(SUM({k}) AS BIGINT)" for k in _FK) + """ FROM fz
 WHERE channel IN ('ONLINE','CLINIC','OFFLINE'))"""


def _pct(n, d):
    # printf rounds the double's exact value, halves to even.
    return f"CASE WHEN {d} <> 0 THEN CAST(printf('%.1f', CAST(100.0 AS DOUBLE) * {n} / {d}) AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"


def _class(p):
    return f"CASE WHEN {p} >= 50 THEN 'good' WHEN {p} >= 30 THEN 'warn' ELSE 'bad' END AS {p}_class"


def fixed_text(x: str, places: int) -> str:
    """Nearest decimal text. A tie is a whole number of halves of the last place, hence of 1/8 or 1/4 or 1/2: there the larger one."""
    parts, scale = 2 ** (places + 1), 10 ** places
    half_up = f"printf('%.{places}f', floor({x} * {scale} + 0.5) / {scale})"
    return f"CASE WHEN {x} * {parts} = floor({x} * {parts}) THEN {half_up} ELSE printf('%.{places}f', {x}) END"


def money_label(a: str) -> str:
    """P22 in SQL: the quotient as a double, to two, one or no decimals."""
    x = f"CAST({a} AS DOUBLE)"
    return (f"CASE WHEN {a} IS NULL THEN '-' WHEN {a} >= 10000000 THEN '₹' || ({fixed_text(f'({x} / 1e7)', 2)}) || 'Cr' "
            f"WHEN {a} >= 100000 THEN '₹' || ({fixed_text(f'({x} / 1e5)', 1)}) || 'L' "
            f"WHEN {a} >= 1000 THEN '₹' || ({fixed_text(f'({x} / 1e3)', 0)}) || 'k' ELSE '₹' || CAST({a} AS VARCHAR) END")


def renewal_sql() -> dict[str, str]:
    pre = with_ctes(["retention"], RENEWAL_BASE)
    lz = ", ".join(f"CAST(COALESCE({k}, 0) AS BIGINT) AS {k}" for k in _LK)
    lsum = ", ".join(f"CAST(SUM({k}) AS BIGINT) AS {k}" for k in _LK)
    lb_all = (pre + "," + LEADER_SQL.strip() + f""",
lz AS (SELECT channel, owner, {lz} FROM leader),
u AS (SELECT * FROM lz UNION ALL SELECT 'ALL' AS channel, owner, {lsum} FROM lz GROUP BY owner)
SELECT *, {_pct('renewed', 'total_accts')} AS renewal_pct FROM u""")
    cy_all = (pre + "," + CYCLE_SQL.strip() + """,
cz AS (SELECT channel, cycle, CAST(COALESCE(total,0) AS BIGINT) AS total, CAST(COALESCE(renewed,0) AS BIGINT) AS renewed,
  CAST(COALESCE(old_premium,0) AS BIGINT) AS old_premium, CAST(COALESCE(renewed_amt,0) AS BIGINT) AS renewed_amt FROM cyc),
u AS (SELECT * FROM cz UNION ALL SELECT 'ALL', cycle, CAST(SUM(total) AS BIGINT), CAST(SUM(renewed) AS BIGINT),
  CAST(SUM(old_premium) AS BIGINT), CAST(SUM(renewed_amt) AS BIGINT) FROM cz GROUP BY cycle)
SELECT *, """ + _pct("renewed", "total") + " AS acct_ret_pct, " + _pct("renewed_amt", "old_premium")
             + " AS rev_ret_pct FROM u")
    wl_views = (pre + "," + WATCH_SQL.strip() + """,
v AS (SELECT channel AS view, * FROM watch UNION ALL SELECT 'ALL' AS view, * FROM watch)
SELECT view, owner, account_uid, channel, cycle, COALESCE(days_overdue, 0) AS days_overdue,
  COALESCE(old_premium, 0) AS old_premium, COALESCE(reason, '') AS reason,
  row_number() OVER (PARTITION BY view ORDER BY old_premium DESC, account_uid) AS pos
FROM v""")
    cards = (pre + "," + FUNNEL_SQL.strip() + "," + FUNNEL_ALL_SQL.strip() + """,
c AS (
 SELECT channel, 0 AS card_order, 'total_book' AS card, total AS value, CAST(NULL AS BIGINT) AS amount FROM fall
 UNION ALL SELECT channel, 1, 'renewed', renewed, rupees_renewed FROM fall
 UNION ALL SELECT channel, 2, 'outreach', outreach, NULL FROM fall
 UNION ALL SELECT channel, 3, 'in_grace', grace_early + grace_late, rupees_in_window FROM fall
 UNION ALL SELECT channel, 4, 'overdue', overdue, rupees_overdue FROM fall
 UNION ALL SELECT channel, 5, 'not_in_window', not_in_window, NULL FROM fall)
SELECT channel, card_order, card, value, amount, """ + money_label("amount") + " AS amount_label FROM c")
    return {
        "funnel_by_channel": pre + "," + FUNNEL_SQL.strip() + "," + FUNNEL_ALL_SQL.strip() + """
SELECT *, row_number() OVER (ORDER BY channel) AS pos FROM fall""",
        "leaderboard_online": f"SELECT *, row_number() OVER (ORDER BY renewal_pct DESC, owner) AS pos FROM ({lb_all}) WHERE channel = 'ONLINE'",
        "cycle_clinic": f"SELECT *, row_number() OVER (ORDER BY cycle) AS pos FROM ({cy_all}) WHERE channel = 'CLINIC'",
        "renewals_meta": f"SELECT channel, count(*) AS owners, '2024-01-15 18:30 UTC' AS generated FROM ({lb_all}) GROUP BY channel",
        "retention_funnel": pre + "," + FUNNEL_SQL.strip() + "\nSELECT * FROM funnel",
        "retention_funnel_all": pre + "," + FUNNEL_SQL.strip() + "," + FUNNEL_ALL_SQL.strip() + "\nSELECT * FROM fall",
        "owner_leaderboard": pre + "," + LEADER_SQL.strip() + "\nSELECT * FROM leader",
        "owner_leaderboard_all": lb_all,
        "cycle_retention": pre + "," + CYCLE_SQL.strip() + "\nSELECT * FROM cyc",
        "cycle_retention_all": cy_all,
        "cycle_retention_classes": f"SELECT *, {_class('acct_ret_pct')}, {_class('rev_ret_pct')} FROM ({cy_all})",
        "overdue_watchlist": pre + "," + WATCH_SQL.strip() + "\nSELECT * FROM watch",
        "watchlist_by_channel": wl_views,
        "pipeline_cards": cards,
    }


def all_sql() -> dict[str, str]:
    from .oracle_activity import activity_sql
    from .oracle_ranking import ranking_sql
    from .oracle_tables import tables_sql

    return renewal_sql() | activity_sql() | tables_sql() | ranking_sql()
