"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from .secret_scan import BASE, KINDS, OPAQUE

_WORD = r"'[^\x20\x09-\x0D]+'"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORD}) AS w FROM documents),
 s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE
   list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) END AS g FROM d),
 t AS (SELECT doc_id, len(g) AS n, unnest(g) AS gram FROM s),
 p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
   FROM t a JOIN t b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
 links AS (SELECT a, b FROM p WHERE 100 * c >= 90 * (na + nb - c)),
 reach AS (SELECT a AS doc_id, b AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a),
 least_ AS (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id),
 n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a),
 c AS (SELECT g, min(doc_id) AS class_id, count(*) AS n_copies FROM s WHERE len(g) > 0 GROUP BY g)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m, s.doc_id)) AS component_id,
  coalesce(class_id, s.doc_id) AS class_id, CAST(coalesce(n_copies, 1) AS BIGINT) AS n_copies,
  CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links
FROM s LEFT JOIN least_ ON s.doc_id = least_.doc_id LEFT JOIN c ON s.g = c.g LEFT JOIN n ON s.doc_id = n.a
"""

SUBSTRING = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
 u AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20),
 k AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 19], ' ')) AS h FROM u),
 f AS (SELECT h, min({{'d': doc_id, 'p': p}}) AS first FROM k GROUP BY h),
 x AS (SELECT doc_id, p FROM k JOIN f USING (h) WHERE {{'d': doc_id, 'p': p}} > first),
 gone AS (SELECT DISTINCT doc_id, p + o AS pos FROM x, range(0, 20) r(o)),
 words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
 kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id),
 n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""


def _count(text: str, chars: str) -> str:
    return f"(length({text}) - length(regexp_replace({text}, '{chars}', '', 'g')))"


QUALITY = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents),
 g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS p, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) AS gram FROM d WHERE len(w) > 2),
 twice AS (SELECT doc_id, gram FROM g GROUP BY ALL HAVING count(*) > 1),
 r AS (SELECT doc_id, count(DISTINCT p + o) AS n FROM g JOIN twice USING (doc_id, gram), range(0, 3) s(o) GROUP BY doc_id),
 l AS (SELECT doc_id, count(*) AS n_lines, count(DISTINCT line) AS n_distinct FROM
   (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
 f AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
   CAST({_count('t', '[#*$%&|<>]')} AS BIGINT) AS n_symbols, CAST(coalesce(n_lines - n_distinct, 0) AS BIGINT) AS n_dup_lines,
   CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
   {_count('t', '[A-Za-z]|[^\\x00-\\x7F]')} / CAST(greatest(1, {_count('t', '[^\\x20\\x09-\\x0D]')}) AS DOUBLE) AS letters,
   len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\\x00-\\x7F]'))) / CAST(greatest(1, len(w)) AS DOUBLE) AS letter_words,
   {_count('t', '[A-Z]')} / CAST(greatest(1, {_count('t', '[A-Za-z]')}) AS DOUBLE) AS upper_share,
   len(list_distinct(w)) / CAST(greatest(1, len(w)) AS DOUBLE) AS distinct_share
   FROM d LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (n_symbols > CAST(0.1 AS DOUBLE) * n_words)
  AND word_chars >= 2 * n_words AND word_chars <= 15 * n_words AND NOT (n_dup_lines > CAST(0.5 AS DOUBLE) * n_lines)
  AND letters >= 0.5 AND letter_words >= CAST(0.7 AS DOUBLE) AND upper_share <= 0.5 AND distinct_share >= CAST(0.1 AS DOUBLE) AS kept
FROM f
"""


def _kind(kind: str, pattern: str, group: int, least: int) -> str:
    p = "'" + pattern.replace("'", "''") + "'"
    return f"""SELECT doc_id, source, lang, '{kind}' AS kind, {KINDS.index(kind)} AS rank,
   unnest(string_split_regex(t, {p})[:len(regexp_extract_all(t, {p}))]) AS gap, unnest(regexp_extract_all(t, {p})) AS whole,
   unnest(regexp_extract_all(t, {p}, {group})) AS value, unnest(range(1, len(regexp_extract_all(t, {p})) + 1)) AS i, {least} AS least_
   FROM d WHERE regexp_matches(t, {p})"""


SECRETS = f"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents),
 m AS ({' UNION ALL '.join(_kind(*k) for k in (*BASE, OPAQUE))}),
 ends AS (SELECT *, sum(length(gap) + length(whole)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM m),
 s AS (SELECT doc_id, source, lang, kind, rank, value, CAST(stop - length(whole) AS INTEGER) AS start, CAST(stop AS INTEGER) AS stop FROM ends
   WHERE length(value) >= least_ AND (kind <> 'opaque' OR (regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')))),
 o AS (SELECT value, count(DISTINCT coalesce(source, chr(1))) AS owners, count(DISTINCT coalesce(source, chr(1)) || chr(2) || concat_ws('/', source, lang)) AS repositories,
   len(list_distinct(string_split(value, ''))) >= 8 AS random FROM s GROUP BY value),
 v AS (SELECT s.*, CASE WHEN owners >= 3 OR (owners >= 2 AND repositories >= 5) THEN 'example' WHEN owners >= 2 THEN 'shared' WHEN random THEN 'live' ELSE 'weak' END AS verdict,
   kind || ':' || start || ':' || stop AS item FROM s JOIN o USING (value)),
 r AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
   string_agg(item, ',' ORDER BY start, rank) FILTER (kind <> 'opaque') AS base, string_agg(item, ',' ORDER BY start, rank) AS spans,
   count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'example') AS n_examples
   FROM v WHERE kind <> 'opaque' OR verdict = 'live' GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_examples, 0) AS n_examples
FROM d LEFT JOIN r USING (doc_id)
"""

TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
 s AS (SELECT DISTINCT a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda x: x[1] * x[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
 m AS (SELECT query_id, vec_id, max(score) AS score FROM s GROUP BY ALL),
 r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM m)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
