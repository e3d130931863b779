"""DuckDB SQL for the queries of the subpackage that SQL can express."""

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, t.pos, t.line, nullif(translate(trim(t.line, E' \t\n\x0b\x0c\r'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS key, d.rid
  FROM (SELECT row_number() OVER () AS rid, * FROM documents) d,
       LATERAL (SELECT unnest(string_split(coalesce(d.text, ''), E'\n')) AS line,
                       unnest(range(len(string_split(coalesce(d.text, ''), E'\n')))) AS pos) t),
shared AS (SELECT key FROM lines WHERE key IS NOT NULL GROUP BY key HAVING count(DISTINCT rid) >= 10),
marked AS (SELECT l.*, s.key IS NOT NULL AS gone FROM lines l LEFT JOIN shared s ON l.key = s.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, E'\n' ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid
"""

ORACLES = {"op2_line_dedup": LINE_DEDUP}

QUALITY_RULES = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
words AS (
  SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS pos
  FROM (SELECT rid, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS w FROM docs)),
counts AS (
  SELECT rid, count(*) AS n_words, sum(length(word)) AS word_chars,
         count(*) FILTER (WHERE regexp_matches(word, '[A-Za-z\x{80}-\x{10FFFF}]')) AS n_lettered
  FROM words GROUP BY rid),
windows AS (
  SELECT rid, pos, word, lead(word, 1) OVER w AS second, lead(word, 2) OVER w AS third
  FROM words WINDOW w AS (PARTITION BY rid ORDER BY pos)),
repeated AS (
  SELECT rid, pos, count(*) OVER (PARTITION BY rid, word, second, third) AS n FROM windows WHERE third IS NOT NULL),
covered AS (
  SELECT rid, count(DISTINCT pos + k) AS n_repeat_words
  FROM repeated CROSS JOIN (VALUES (0), (1), (2)) AS t(k) WHERE n > 1 GROUP BY rid),
lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(body, E'\n')) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
measures AS (
  SELECT rid, doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
         len(regexp_extract_all(body, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
         coalesce(n_lettered, 0) AS n_lettered, len(regexp_extract_all(body, '[A-Z]')) AS n_capitals,
         len(regexp_extract_all(body, '[a-z]')) AS n_small
  FROM docs LEFT JOIN counts USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN covered USING (rid)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words
            OR word_chars > 20 * n_words OR n_capitals > n_small OR 10 * n_lettered < 7 * n_words) AS kept
FROM based
"""

ORACLES["op10_quality_rules"] = QUALITY_RULES

SOURCE_DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
terms AS (SELECT rid, lang, source, unnest(regexp_extract_all(body, '[a-z\x{80}-\x{10FFFF}]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM terms GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
langs AS (SELECT d.lang, coalesce(any_value(k.v), 0) AS v, coalesce(any_value(k.total), 0) AS total
          FROM docs d LEFT JOIN (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY lang) k USING (lang) GROUP BY d.lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
dense AS (
  SELECT g.lang, g.source, k.term, k.lang_n, coalesce(c.n, 0) AS n, l.v, l.total AS lang_total,
         sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS p,
         1 + (1000000000::HUGEINT * (lang_n + 2)) // (lang_total + 2 * v) AS q FROM dense),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
results AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM results)
WHERE part = 'pair' OR rank <= 10
"""

ORACLES["op11_source_divergence"] = SOURCE_DIVERGENCE

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first FROM p)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN strlen(payload) >= 100 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(payload) >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""

ORACLES["op13_warc"] = WARC
