"""DuckDB oracle SQL for the agent ranking queries."""

from __future__ import annotations

from . import oracle_values as V
from .oracle import fixed_text, with_ctes


def _band(v, edges, op, null_as="NULL"):
    arms = " ".join(f"WHEN {v} {op} {e} THEN {r}" for e, r in edges)
    return f"CASE WHEN {v} IS NULL THEN {null_as} {arms} ELSE 1 END"


def _score(prefix=""):
    keys = ["frt", "art", "res", "csat", "vol"]
    num = " + ".join(f"COALESCE(CAST({V.WEIGHTS[k]} AS DOUBLE) * {prefix}r_{k}, CAST(0 AS DOUBLE))" for k in keys)
    den = " + ".join(f"(CASE WHEN {prefix}r_{k} IS NOT NULL THEN CAST({V.WEIGHTS[k]} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)"
                     for k in keys)
    return f"CASE WHEN ({den}) > 0 THEN ({num}) / ({den}) END"


def _rated(src: str, name: str) -> str:
    return f"""
{name}_r AS (
 SELECT *, {_band('first_response_secs', V.FRT_EDGES, '<=')} AS r_frt,
  {_band('every_chat_response_secs', V.ART_EDGES, '<=')} AS r_art,
  CAST(NULL AS INTEGER) AS r_res,
  {_band('csat', V.CSAT_EDGES, '>=', '0')} AS r_csat,
  {_band('total_bucket', V.VOL_EDGES, '>=')} AS r_vol
 FROM {src}),
{name} AS (SELECT *, {_score()} AS score FROM {name}_r)"""


def _dur(v):
    r = f"CAST(floor({v} + 0.5) AS BIGINT)"
    return (f"CASE WHEN {v} IS NULL THEN '-' WHEN {r} < 60 THEN CAST({r} AS VARCHAR) || 's' "
            f"ELSE CAST({r} // 60 AS VARCHAR) || 'm' || CASE WHEN {r} % 60 <> 0 THEN ' ' || CAST({r} % 60 AS VARCHAR) || 's' "
            f"ELSE '' END END")


def _fixed2(v):
    return f"({fixed_text(f'CAST({v} AS DOUBLE)', 2)})"


R6 = "round({0}, 6) AS {0}"


def ranking_sql() -> dict[str, str]:
    pre = with_ctes(["agent_day"], _rated("agent_day", "sc"))
    out = {}
    metric_cols = ", ".join(R6.format(c) for c in ["first_response_secs", "every_chat_response_secs",
                                                  "resolution_time_secs", "csat"])
    out["agent_ratings"] = pre + f"""
SELECT d, name, pod, total_bucket, open_bucket, resolved_cum, {metric_cols}, csat_n,
 r_frt, r_art, r_res, r_csat, r_vol, round(score, 6) AS score FROM sc"""
    rank = """
rk AS (SELECT *, CASE WHEN score IS NOT NULL THEN
  row_number() OVER (PARTITION BY d ORDER BY score DESC NULLS LAST, name) END AS rank FROM sc)"""
    out["agent_ranks_of_pod"] = pre + """
SELECT d, name, pod, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC NULLS LAST, name) AS rank,
 row_number() OVER (ORDER BY COALESCE(csat, -1e9) DESC, name) AS pos
FROM sc WHERE d = DATE '2024-01-12' AND pod = 'Postsales - Hindi' AND total_bucket > 0"""
    out["agent_scores_ranked"] = pre + "," + rank.strip() + f"""
SELECT d, name, pod, round(score, 6) AS score, rank,
 {_dur('first_response_secs')} AS first_response_label,
 {_dur('every_chat_response_secs')} AS every_chat_label,
 CASE WHEN csat IS NULL THEN '-' ELSE {_fixed2('csat')} END AS csat_label
FROM rk"""
    cum_src = """
cum AS (
 SELECT name, max(pod) AS pod, count(*) AS days, avg(total_bucket) AS total_bucket, avg(open_bucket) AS open_bucket,
  avg(resolved_cum) AS resolved_cum,
  sum(first_response_secs * total_bucket) / sum(CASE WHEN first_response_secs IS NOT NULL THEN total_bucket END) AS first_response_secs,
  sum(every_chat_response_secs * total_bucket) / sum(CASE WHEN every_chat_response_secs IS NOT NULL THEN total_bucket END) AS every_chat_response_secs,
  sum(resolution_time_secs * total_bucket) / sum(CASE WHEN resolution_time_secs IS NOT NULL THEN total_bucket END) AS resolution_time_secs,
  sum(csat * csat_n) / sum(CASE WHEN csat IS NOT NULL THEN csat_n END) AS csat,
  sum(csat_n) AS csat_n
 FROM agent_day GROUP BY name)"""
    cum_metrics = ", ".join(R6.format(c) for c in ["total_bucket", "open_bucket", "resolved_cum", "first_response_secs",
                                                  "every_chat_response_secs", "resolution_time_secs", "csat"])
    out["agent_cumulative"] = with_ctes(["agent_day"], cum_src, _rated("cum", "cs")) + f"""
SELECT name, pod, days, {cum_metrics}, CAST(csat_n AS BIGINT) AS csat_n,
 r_frt, r_art, r_res, r_csat, r_vol, round(score, 6) AS score FROM cs"""
    act = "COALESCE(total_bucket, 0) > 0"
    out["ranking_cards"] = pre + "," + rank.strip() + f""",
g AS (
 SELECT d, COUNT(rank) AS agents,
  string_agg(CAST(rank AS VARCHAR) || '. ' || name || ' (' || {_fixed2('score')} || ')', '; ' ORDER BY rank)
   FILTER (WHERE rank <= 3) AS top3,
  avg(first_response_secs) FILTER (WHERE {act}) AS afr, avg(every_chat_response_secs) FILTER (WHERE {act}) AS aart,
  avg(csat) FILTER (WHERE {act}) AS acsat, median(csat) FILTER (WHERE {act}) AS mcsat,
  CAST(COALESCE(SUM(total_bucket) FILTER (WHERE {act}), 0) AS BIGINT) AS total_chats,
  CAST(COALESCE(SUM(COALESCE(open_bucket, 0)) FILTER (WHERE {act}), 0) AS BIGINT) AS open_chats,
  CAST(COALESCE(SUM(COALESCE(resolved_cum, 0)) FILTER (WHERE {act}), 0) AS BIGINT) AS resolved,
  avg(score) FILTER (WHERE rank IS NOT NULL) AS ascore
 FROM rk GROUP BY d)
SELECT d, agents, top3, round(afr, 6) AS avg_first_response, {_dur('floor(afr + 0.5)')} AS avg_first_response_label,
 round(aart, 6) AS avg_every_chat, {_dur('floor(aart + 0.5)')} AS avg_every_chat_label,
 round(acsat, 6) AS avg_csat, round(mcsat, 6) AS median_csat, total_chats, open_chats, resolved,
 round(ascore, 6) AS avg_score, d = (SELECT max(d) FROM g) AS is_default_day
FROM g"""
    return out
