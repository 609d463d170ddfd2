"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

OP5_CTES = rf"""
d AS (SELECT row_number() OVER () AS rid, * FROM documents),
w AS (SELECT rid, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w, string_split(coalesce(text, ''), chr(10)) AS ls FROM d),
l AS (SELECT rid, list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w),
win AS (SELECT rid, unnest(range(1, len(w) - 3)) AS i, w FROM w WHERE len(w) >= 5),
key AS (SELECT rid, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] AS k FROM win),
rep AS (SELECT rid, i FROM key QUALIFY count(*) OVER (PARTITION BY rid, k) > 1),
gap AS (SELECT rid, least(5, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 5)) AS g FROM rep),
cov AS (SELECT rid, sum(g) AS n FROM gap GROUP BY rid),
base AS (
  SELECT d.rid, d.doc_id, d.lang, d.source, CAST(len(w.w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w.w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(coalesce(d.text, ''), '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(regexp_extract_all(coalesce(d.text, ''), '[!-/:-@\[-`{{-~]')) AS BIGINT) AS n_marks,
    CAST(len(l.l) - len(list_distinct(l.l)) AS BIGINT) AS n_dup_lines, CAST(len(l.l) AS BIGINT) AS n_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN w USING (rid) JOIN l USING (rid) LEFT JOIN cov USING (rid)),
s AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    CASE WHEN word_chars > 0 THEN n_marks * 1000 // word_chars ELSE 0 END AS m1,
    CASE WHEN n_words > 0 THEN word_chars * 100 // n_words ELSE 0 END AS m2,
    CASE WHEN n_dup_lines > 0 THEN n_dup_lines * 100 // n_lines END AS m3
  FROM base),
cell AS (
  SELECT lang, source, 1 AS m, m1 AS v FROM s WHERE NOT base_failed UNION ALL
  SELECT lang, source, 2, m2 FROM s WHERE NOT base_failed UNION ALL
  SELECT lang, source, 3, m3 FROM s WHERE NOT base_failed),
low AS (SELECT lang, source, m, CASE WHEN v < 256 THEN v ELSE (v >> (length(bin(v)) - 8)) << (length(bin(v)) - 8) END AS v FROM cell WHERE v IS NOT NULL),
own AS (SELECT lang, source, m, v, count(*) AS n FROM low GROUP BY ALL),
grp AS (SELECT lang, source, m FROM (SELECT DISTINCT lang, source FROM own), (SELECT unnest([1, 2, 3]) AS m)),
per AS (SELECT lang, m, v, sum(n) AS n FROM own GROUP BY ALL),
lng AS (SELECT lang, m, v, n * 25000000 // sum(n) OVER (PARTITION BY lang, m) AS n FROM per),
tot AS (SELECT m, v, sum(n) AS n FROM own GROUP BY ALL),
alt AS (SELECT m, v, n * 25000000 // sum(n) OVER (PARTITION BY m) AS n FROM tot),
mer AS (
  SELECT lang, source, m, v, sum(n) AS n FROM (
    SELECT lang, source, m, v, n * 1000000 AS n FROM own UNION ALL
    SELECT g.lang, g.source, g.m, l.v, l.n FROM grp g JOIN lng l ON g.m = l.m AND g.lang IS NOT DISTINCT FROM l.lang UNION ALL
    SELECT g.lang, g.source, g.m, a.v, a.n FROM grp g JOIN alt a ON g.m = a.m) GROUP BY ALL),
cum AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, m ORDER BY v) AS upto, sum(n) OVER (PARTITION BY lang, source, m) AS total FROM mer),
qua AS (
  SELECT lang, source, m, min(v) FILTER (WHERE upto * 4 >= total) AS q1, min(v) FILTER (WHERE upto * 4 >= total * 3) AS q3 FROM cum GROUP BY ALL),
used AS (
  SELECT lang, source, max(q3 + 5 * (q3 - q1)) FILTER (WHERE m = 1) AS f1, max(q3 + 5 * (q3 - q1)) FILTER (WHERE m = 2) AS f2,
    max(q3 + 5 * (q3 - q1)) FILTER (WHERE m = 3) AS f3 FROM qua GROUP BY ALL),
judged AS (
  SELECT s.*, NOT base_failed AND NOT coalesce(m1 > f1, FALSE) AND NOT coalesce(m2 > f2, FALSE) AND NOT coalesce(m3 > f3, FALSE) AS kept, f1, f2, f3
  FROM s LEFT JOIN used u ON s.lang IS NOT DISTINCT FROM u.lang AND s.source IS NOT DISTINCT FROM u.source)
"""

OP5 = f"""WITH {OP5_CTES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"""

OP7 = rf"""WITH
sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':mix') AS key FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
wei AS (SELECT *, [1, 2, 3][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS weight, source_size * 3 AS cap FROM src),
lev AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER t, 0) AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER t, 0) AS weights
  FROM wei WINDOW t AS (ORDER BY CAST(cap AS DOUBLE) / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lvl AS (SELECT *, CAST(rest AS DOUBLE) / weights AS own FROM lev),
one AS (SELECT first(own ORDER BY CAST(cap AS DOUBLE) / weight, own) AS level FROM lvl WHERE cap > own * weight),
tgt AS (
  SELECT source, source_size, CASE WHEN level IS NULL OR cap <= level * weight THEN CAST(cap AS DOUBLE) ELSE level * weight END AS target
  FROM lvl LEFT JOIN one ON TRUE),
cut AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS full_epochs FROM tgt),
run AS (
  SELECT s.*, c.source_size, c.target, c.full_epochs, c.target - c.full_epochs * c.source_size AS cut,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN cut c ON s.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (full_epochs + CASE WHEN cut > 0 AND start * 2 + size <= cut * 2 THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM run"""

OP2 = r"""WITH
d AS (SELECT row_number() OVER () AS rid, doc_id, text, n_chars FROM documents),
l AS (SELECT rid, doc_id, unnest(range(1, len(ls) + 1)) AS i, ls FROM (SELECT rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM d)),
t AS (SELECT rid, doc_id, i, ls[i] AS line, list_transform(regexp_extract_all(ls[i], '[^\x20\x09-\x0D]+'), lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS w FROM l),
k AS (
  SELECT rid, doc_id, i, len(w) AS n, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 8 THEN [array_to_string(w, ' ')] ELSE
    list_prepend(array_to_string(w, ' '), list_transform([0, 1, 2, 3], lambda p: CAST(p AS VARCHAR) || ' ' || CAST(len(w) AS VARCHAR) || ' ' ||
      array_to_string(w[1:3 + (len(w) - 3) * p // 4], ' ') || ' | ' || array_to_string(w[(len(w) - 3) * (p + 1) // 4 + 4:], ' '))) END AS keys
  FROM t),
e AS (SELECT rid, doc_id, i, key, CASE WHEN regexp_matches(key, '^[0-3] ') THEN 1 ELSE ceil(n / 10.0) END AS steps FROM (SELECT rid, doc_id, i, n, unnest(keys) AS key FROM k)),
o AS (SELECT key, min(doc_id) AS first_doc FROM (SELECT DISTINCT rid, doc_id, key, steps FROM e) GROUP BY key HAVING count(*) >= least(10, greatest(2, ceil(10.0 / any_value(steps))))),
x AS (SELECT DISTINCT rid, i FROM e JOIN o USING (key) WHERE e.doc_id IS DISTINCT FROM o.first_doc),
r AS (
  SELECT t.rid, count(*) FILTER (WHERE len(t.w) > 0) AS n_lines, count(x.i) AS n_dropped,
    coalesce(string_agg(t.line, chr(10) ORDER BY t.i) FILTER (WHERE x.i IS NULL), '') AS text
  FROM t LEFT JOIN x USING (rid, i) GROUP BY t.rid)
SELECT d.doc_id, r.n_lines, r.n_dropped, CASE WHEN d.text IS NULL THEN d.n_chars ELSE length(r.text) END AS n_chars, sha256(r.text) AS text_sha256
FROM d JOIN r USING (rid)"""

OP4 = r"""WITH
c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL
  SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\]', '', 'g'))
    + len(regexp_extract_all(text, '<s>|</s>|\[INST\]|\[/INST\]|\[ANS\]|<<SYS>>|<</SYS>>|\[ROLE\]|\[/ROLE\]'))
    + CASE role WHEN 'system' THEN 19 WHEN 'user' THEN 18 WHEN 'assistant' THEN 11 ELSE 16 + length(role) END AS chars FROM c),
g AS (SELECT *, row_number() OVER w AS rn, lag(role, 1, 'start') OVER w AS state FROM f WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
t AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY rn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, CAST(sum(chars) AS BIGINT) AS formatted_chars,
    min_by(CASE role WHEN '' THEN 'no role' ELSE role END || ' after ' || state || ' at turn ' || turn, rn)
      FILTER (WHERE state || ' ' || role NOT IN ('start system', 'start user', 'system user', 'user assistant', 'assistant user')) AS broken,
    max_by(CASE role WHEN '' THEN 'no role' ELSE role END, rn) AS last
  FROM g GROUP BY conv_id),
p AS (SELECT *, coalesce(broken, CASE WHEN last NOT IN ('user', 'assistant') THEN 'ends after ' || last END) AS problem FROM t)
SELECT conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, problem IS NULL AS valid, problem FROM p"""

ORACLES = {"op2_line_dedup": OP2, "op4_chat_formatting": OP4, "op5_quality_rules": OP5, "op7_mixing": OP7}
