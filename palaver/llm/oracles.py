"""SQL for DuckDB that gives the rows of the queries which SQL can express."""

from __future__ import annotations

from palaver.llm.secrets import RULES

#: Only A-Z change case, as in the contracts.
FOLD = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATE = f"""
WITH dw AS (SELECT doc_id, regexp_extract_all({FOLD.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
iw AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({FOLD.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (SELECT DISTINCT item, least(len(w), 13) AS size, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS win
  FROM iw, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS u(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT doc_id, size, i, array_to_string(list_slice(w, i, i + size - 1), ' ') AS win
  FROM dw, sizes, unnest(range(1, greatest(len(w) - size + 2, 1))) AS u(i)),
found AS (SELECT p.doc_id, p.i, p.size, f.item FROM places p JOIN windows f ON p.size = f.size AND p.win = f.win),
hits AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT DISTINCT doc_id, i, size FROM found) f, unnest(range(i, i + size)) AS u(pos) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS all_items FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(all_items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _spans(k: int, rule) -> str:
    """Places of one rule's matches: what lies between them and the matches themselves take turns."""
    whole = _quoted(rule.head + rule.body)
    body = f"regexp_extract(m[i], {_quoted(f'^(?:{rule.head})({rule.body})$')}, 1)" if rule.head else "m[i]"
    return f"""SELECT doc_id, {k} AS k, '{rule.kind}' AS kind, a AS first, a + length(m[i]) AS last FROM (
  SELECT doc_id, m, i, list_sum(list_transform(list_slice(p, 1, i), lambda x: length(x))) + coalesce(list_sum(list_transform(list_slice(m, 1, i - 1), lambda x: length(x))), 0) AS a
  FROM (SELECT doc_id, regexp_extract_all(t, {whole}) AS m, regexp_split_to_array(t, {whole}) AS p FROM texts), unnest(range(1, len(m) + 1)) AS u(i)) WHERE length({body}) >= {rule.least}"""


SECRETS = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({' UNION ALL '.join(_spans(k, rule) for k, rule in enumerate(RULES))}),
lines AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  string_agg(kind || ':' || CAST(first AS BIGINT) || ':' || CAST(last AS BIGINT), ',' ORDER BY first, k) FILTER (k < 3) AS base,
  string_agg(kind || ':' || CAST(first AS BIGINT) || ':' || CAST(last AS BIGINT), ',' ORDER BY first, k) AS spans FROM spans GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents LEFT JOIN lines USING (doc_id)"""

WARC = """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to FROM f"""

SETJOIN = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({FOLD.format('text')}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS shingle FROM w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT a, a FROM edges UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.other)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, doc_id) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS c FROM reach GROUP BY 1) r USING (doc_id)"""

NEGATIVES = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, e.vec_id AS other, a.label = e.label AS same, CAST(list_inner_product(a.q, e.q) AS BIGINT) AS score
  FROM e a JOIN e ON a.vec_id % 50 = 0 AND a.vec_id <> e.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""

PHRASES = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({FOLD.format('text')}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY 1),
g AS (SELECT lang, k AS words, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
  FROM w, unnest(range(1, 5)) AS s(k), unnest(range(1, greatest(len(w) - k + 2, 1))) AS u(i)),
f AS (SELECT lang, words, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
cuts AS (SELECT lang, phrase, f AS a, k, array_to_string(list_slice(string_split(phrase, ' '), 1, k), ' ') AS head,
  array_to_string(list_slice(string_split(phrase, ' '), k + 1, words), ' ') AS rest FROM f, unnest(range(1, words)) AS u(k)),
scored AS (SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * a // (x.f::HUGEINT + y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = head JOIN f y ON y.lang = c.lang AND y.phrase = rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ones AS (SELECT lang, f, array_to_string(list_slice(string_split(phrase, ' '), i, i + k - 1), ' ') AS phrase
  FROM f, unnest(range(2, words)) AS s(k), unnest(range(1, words - k + 2)) AS u(i)),
longer AS (SELECT lang, phrase, max(f) AS longest FROM inner_ones GROUP BY 1, 2),
kept AS (SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase) WHERE NOT coalesce(100::HUGEINT * longest >= 80::HUGEINT * a, false))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000"""

ORACLE: dict[str, str] = {"op1_decontaminate": DECONTAMINATE, "op5_secrets": SECRETS, "op7_warc": WARC, "op9_setjoin": SETJOIN, "op11_negatives": NEGATIVES, "op12_phrases": PHRASES}
