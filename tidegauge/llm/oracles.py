"""SQL of the text queries that SQL can express in full."""

from __future__ import annotations

#: CRC-32 of an id written in decimal, as no SQL function gives it: bit by bit over the characters.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, op: CASE WHEN op >= 0 THEN xor(c, op) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295)"""

MANIFEST_SQL = f"""WITH RECURSIVE low AS (
  SELECT doc_id, source, lang, n_chars, text,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered FROM documents),
said AS (
  SELECT doc_id, lang, text, lowered,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM low),
hashed AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-')) AS damaged FROM said),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM hashed),
grown AS (
  SELECT 0 AS level, lang, pos, n, leaf AS h FROM leaves
  UNION ALL
  SELECT level + 1, lang, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM grown WHERE n > 1 GROUP BY level, lang, pos // 8, n),
subroots AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM grown WHERE n = 1),
upper AS (
  SELECT 0 AS level, place AS pos, n, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM upper WHERE n > 1 GROUP BY level, pos // 8, n),
runs AS (
  SELECT level, lang, false AS top, pos // 8 AS above, list(h ORDER BY pos) AS hs FROM grown WHERE n > 1 GROUP BY level, lang, pos // 8
  UNION ALL
  SELECT level, NULL, true, pos // 8, list(h ORDER BY pos) FROM upper WHERE n > 1 GROUP BY level, pos // 8),
walk AS (
  SELECT lang, leaf AS start, pos AS place, 0 AS level, pos, n, false AS top, '' AS proof,
    CASE WHEN doc_id IS NOT NULL AND {CRC32} % 3 = 0 THEN damaged ELSE leaf END AS h, doc_id FROM leaves
  UNION ALL
  SELECT w.lang, w.start, w.place,
    CASE WHEN w.n > 1 THEN w.level + 1 ELSE 0 END, CASE WHEN w.n > 1 THEN w.pos // 8 ELSE s.place END,
    CASE WHEN w.n > 1 THEN (w.n + 7) // 8 ELSE s.n END, w.top OR w.n = 1,
    CASE WHEN w.n > 1 THEN w.proof || array_to_string(list_concat(r.hs[:w.pos % 8], r.hs[w.pos % 8 + 2:]), '') ELSE w.proof END,
    CASE WHEN w.n > 1 THEN sha256(array_to_string(r.hs[:w.pos % 8], '') || w.h || array_to_string(r.hs[w.pos % 8 + 2:], '')) ELSE w.h END, w.doc_id
  FROM walk w JOIN subroots s ON s.lang IS NOT DISTINCT FROM w.lang
  LEFT JOIN runs r ON w.n > 1 AND r.level = w.level AND r.above = w.pos // 8 AND r.top = w.top AND (w.top OR r.lang IS NOT DISTINCT FROM w.lang)
  WHERE w.n > 1 OR NOT w.top),
root AS (SELECT h AS root FROM upper WHERE n = 1)
SELECT w.doc_id, w.start AS leaf, s.subroot, root.root, sha256(w.proof) AS proof_sha256, w.h AS folded_root, w.h = root.root AS verified
FROM walk w JOIN subroots s ON s.lang IS NOT DISTINCT FROM w.lang, root WHERE w.top AND w.n = 1
"""

DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS (SELECT doc, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
vocabulary AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS lang_count FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
counted AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS c FROM words SEMI JOIN vocabulary USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(lang_count) AS n FROM vocabulary GROUP BY lang),
groups AS (SELECT g.lang, g.source, coalesce(sum(c), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN counted USING (lang, source) GROUP BY ALL),
ps AS (
  SELECT g.lang, g.source, w.term, coalesce(k.c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(k.c, 0) + 1)) // (CAST(g.n AS HUGEINT) + s.v) AS p,
    1 + (1000000000::HUGEINT * (w.lang_count + 1)) // (CAST(s.n AS HUGEINT) + s.v) AS q
  FROM groups g JOIN sizes s USING (lang) JOIN vocabulary w USING (lang) LEFT JOIN counted k ON k.lang = g.lang AND k.source = g.source AND k.term = w.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM ps a JOIN ps b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value FROM ps WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank FROM (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS place FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms)
WHERE part = 'pair' OR place <= 200
"""
