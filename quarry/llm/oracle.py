"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

#: Documents without the lines whose key (stripped of ASCII white space, A-Z lower-cased, 20 code points or
#: more) stands in 3 documents or more, except in the largest doc_id that holds it.
_WS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_KEPT_LINES = f"""
WITH lines AS (
  SELECT doc_id, pos, arr[pos] AS line,
    translate(trim(arr[pos], {_WS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, arr, unnest(range(1, len(arr) + 1)) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS arr FROM documents))),
many AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT l.*, m.k IS NOT NULL AND l.doc_id <> m.keeper AS gone FROM lines l LEFT JOIN many m ON l.k = m.k),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
  FROM marked GROUP BY doc_id)
"""

_MIX = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5('42:' || doc_id) AS k FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sizes),
weighed AS (SELECT *, rank % 3 AS class, rank % 3 + 1 AS w, 3 * source_size AS stop FROM ranked),
shares AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(stop) OVER b, 0))::DOUBLE
            / (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::DOUBLE AS level,
    row_number() OVER (ORDER BY stop / w, rank) AS turn
  FROM weighed WINDOW b AS (ORDER BY stop / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stopped AS (SELECT *, min(CASE WHEN level * w >= stop THEN 1 ELSE 0 END) OVER (ORDER BY turn) AS stops FROM shares),
targets AS (
  SELECT *, CASE WHEN stops = 1 THEN stop::DOUBLE
    ELSE (SELECT min_by(level, turn) FROM stopped WHERE stops = 0) * w END AS target FROM stopped),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.class, round(t.target)::BIGINT AS goal,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first_word
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
took AS (
  SELECT *, CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS passes FROM placed),
done AS (
  SELECT *, passes * size + greatest(0, least(size, goal - passes * source_size - first_word)) AS taken,
    [1.5, 1.0, 0.5][class + 1]::DOUBLE AS a, [0.5, 1.0, 1.5][class + 1]::DOUBLE AS b, first_word / goal AS x FROM took)
SELECT doc_id, size, source_size, target, taken::BIGINT AS taken,
  CASE WHEN taken > 0 THEN 2.0::DOUBLE * x / (a + sqrt(a * a + 2.0::DOUBLE * (b - a) * x)) END AS position FROM done
"""

_DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
found AS (SELECT d, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM found GROUP BY ALL HAVING count(DISTINCT d) >= 3),
counts AS (SELECT f.lang, f.source, f.term, count(*) AS n FROM found f JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce(t.total, 0) AS total, coalesce(l.v, 0) AS v, coalesce(l.total, 0) AS lang_total
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN langs l ON g.lang = l.lang
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL) t ON g.lang = t.lang AND g.source = t.source),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + g.v) AS p,
    1 + (1000000000::HUGEINT * (k.lang_n + 1)) // (g.lang_total + g.v) AS lang_p
  FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::BIGINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every_pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(p.value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
terms AS (
  SELECT lang, source, term AS item, (((p - lang_p) * (p - lang_p)) // lang_p)::BIGINT AS value FROM shares WHERE n > 0 AND p > lang_p),
parts AS (SELECT *, 'pair' AS part FROM every_pair UNION ALL SELECT *, 'term' AS part FROM terms),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

SQL = {
    "op3_mix": _MIX,
    "op5_line_dedup": _KEPT_LINES + "SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM kept",
    "op11_divergence_audit": _DIVERGENCE,
}
