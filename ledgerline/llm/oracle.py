"""DuckDB SQL for the text operators that SQL can express, by the plainest way:
all pairs that share a shingle, all windows, all places of template words."""

from __future__ import annotations

from ledgerline.llm.license_scan import templates

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"'[^\x20\x09-\x0D]+'"

JACCARD_JOIN = rf"""
WITH RECURSIVE worded AS (
 SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), '{UPPER}', '{LOWER}'), {WORDS}) AS w FROM documents),
shingled AS (
 SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM worded),
sets AS (SELECT min(doc_id) AS rep, s, len(s) AS n FROM shingled WHERE len(s) > 0 GROUP BY s),
listed AS MATERIALIZED (SELECT rep, n, unnest(s) AS said FROM sets),
shared AS (SELECT said, row_number() OVER () AS x FROM listed GROUP BY said HAVING count(*) > 1),
items AS MATERIALIZED (SELECT rep, n, x FROM listed JOIN shared USING (said)),
links AS MATERIALIZED (
 SELECT a.rep AS a, b.rep AS b FROM items a JOIN items b ON a.x = b.x AND a.rep <> b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
 GROUP BY a.rep, b.rep HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reached(a, b) AS (SELECT rep, rep FROM sets UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
smallest AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, COALESCE(component_id, d.doc_id) AS component_id
FROM shingled d LEFT JOIN sets ON sets.s = d.s LEFT JOIN smallest ON smallest.a = sets.rep"""

SUBSTRING_DEDUP = rf"""
WITH worded AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), {WORDS}) AS w FROM documents),
windows AS MATERIALIZED (
 SELECT doc_id, unnest(range(1, len(w) - 11)) AS pos,
  unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS said
 FROM worded WHERE len(w) >= 13),
earliest AS (SELECT said, min(doc_id) AS first_id FROM windows GROUP BY said),
gone AS (
 SELECT DISTINCT doc_id, unnest(range(pos, pos + 13)) AS pos FROM windows JOIN earliest USING (said) WHERE first_id < doc_id),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM worded),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS said, count(*) AS n FROM placed ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - COALESCE(n, 0) AS BIGINT) AS n_removed, sha256(COALESCE(said, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (doc_id)"""


def license_scan() -> str:
    rows = ",\n ".join("({id}, '{label}', {base}, {ordered}, {words}, {least})".format(**t) for t in templates())
    return rf"""
WITH kinds(id, label, base, in_order, said, least) AS (VALUES
 {rows}),
worded AS (
 SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
places AS MATERIALIZED (
 SELECT * FROM (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS at FROM worded) WHERE word IN (SELECT unnest(said) FROM kinds)),
wanted AS (SELECT id, unnest(said) AS word, unnest(range(len(said))) AS at FROM kinds),
phrases AS (
 SELECT doc_id, id, p.at - t.at AS start, 1.0::DOUBLE AS share
 FROM places p JOIN wanted t ON t.word = p.word JOIN kinds USING (id) WHERE in_order
 GROUP BY doc_id, id, p.at - t.at HAVING count(*) = any_value(len(said))),
held AS (SELECT p.doc_id, p.at, p.word, id, len(said) AS span, least, len(list_distinct(said)) AS m FROM places p JOIN kinds ON NOT in_order AND list_contains(said, p.word)),
blocks AS (
 SELECT a.doc_id, a.id, a.at AS start, count(DISTINCT b.word)::DOUBLE / any_value(a.m) AS share
 FROM held a JOIN held b ON b.doc_id = a.doc_id AND b.id = a.id AND b.at BETWEEN a.at AND a.at + a.span - 1
 GROUP BY a.doc_id, a.id, a.at HAVING count(DISTINCT b.word) >= any_value(a.least)),
found AS (SELECT * FROM phrases UNION ALL FROM blocks),
summed AS (
 SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word, max(start) FILTER (WHERE base) AS last_word,
  array_to_string(list_sort(list_distinct(list(IF(base, label, NULL)))), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(share) AS score
 FROM found JOIN kinds USING (id) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_base, 0) AS n_base, first_word, last_word,
 COALESCE(base_labels, '') AS base_labels, COALESCE(labels, '') AS labels, COALESCE(score, 0.0) AS score
FROM worded LEFT JOIN summed USING (doc_id)"""


def va_clustering(k: int = 8, rounds: int = 10, size: int = 64) -> str:
    """Plain rounds over all vectors: every distance, then floors of exact means."""
    steps = [f"""kept AS MATERIALIZED (
 SELECT row_number() OVER (ORDER BY sha256('3:' || COALESCE(CAST(vec_id AS VARCHAR), 'null')), v) AS r, vec_id, v FROM (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size})),
c0 AS MATERIALIZED (SELECT CAST(r - 1 AS INTEGER) AS c, v FROM kept WHERE r <= {k})"""]
    for t in range(rounds + 1):
        steps.append(f"""a{t} AS MATERIALIZED (
 SELECT r, min(s).c AS c, min(s).d AS d FROM (
  SELECT r, {{'d': list_sum(list_transform(range(1, {size + 1}), lambda i: (kept.v[i] - c{t}.v[i]) * (kept.v[i] - c{t}.v[i]))), 'c': c}} AS s FROM kept, c{t}) GROUP BY r)""")
        if t < rounds:
            steps.append(f"""c{t + 1} AS MATERIALIZED (
 SELECT c, COALESCE(m.v, c{t}.v) AS v FROM c{t} LEFT JOIN (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
   SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(kept.v) AS x, unnest(range(1, {size + 1})) AS i FROM a{t} JOIN kept USING (r)) GROUP BY c, i)
  GROUP BY c) m USING (c))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, a.c AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
 sha256(array_to_string(z.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept USING (r) JOIN c{rounds} z ON z.c = a.c"""


def all_sql() -> dict[str, str]:
    return {"op4_jaccard_join": JACCARD_JOIN, "op6_license_scan": license_scan(), "op7_substring_dedup": SUBSTRING_DEDUP,
            "op13_va_clustering": va_clustering()}
