"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

OP9 = r"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT rid, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w,
         generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS i FROM base),
windows AS (
  SELECT rid, i, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM words
  WINDOW o AS (PARTITION BY rid ORDER BY i)),
marked AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, w, w2, w3) > 1 AS twice FROM windows WHERE w3 IS NOT NULL),
covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM marked WHERE twice) GROUP BY rid),
counted AS (
  SELECT rid, count(*) AS n_words, sum(length(w)) AS word_chars FROM words GROUP BY rid),
lines AS (
  SELECT rid, count(*) AS n, count(DISTINCT line) AS d
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM base)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
stats AS (
  SELECT b.rid, doc_id, source, coalesce(c.n_words, 0)::BIGINT AS n_words, coalesce(c.word_chars, 0)::BIGINT AS word_chars,
         (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         coalesce(l.n - l.d, 0)::BIGINT AS n_dup_lines, coalesce(v.n, 0)::BIGINT AS n_repeat_words, coalesce(l.n, 0) AS n_lines
  FROM base b LEFT JOIN counted c USING (rid) LEFT JOIN lines l USING (rid) LEFT JOIN covered v USING (rid)),
judged AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM stats),
failed AS (
  SELECT *, (base_failed OR 2 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
             OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS bad FROM judged),
hosts AS (
  SELECT source, count(*) AS n, sum(bad::INT) AS k FROM failed WHERE source IS NOT NULL GROUP BY source),
prior AS (
  SELECT m, CASE WHEN v <= 0 THEN 10000.0 ELSE least(greatest(m * (1 - m) / v - 1, 1.0), 10000.0) END AS s
  FROM (SELECT any_value(m) AS m, avg((k::DOUBLE / n - m) ** 2) AS v
        FROM hosts, (SELECT sum(k)::DOUBLE / sum(n) AS m FROM hosts))),
condemned AS (
  SELECT source FROM hosts, prior WHERE (k + m * s) / (n + s) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR (bad AND source IS NOT NULL AND source IN (SELECT source FROM condemned))) AS kept
FROM failed
"""

OP10 = r"""
WITH base AS (
  SELECT page_id, url, md5(coalesce(html, '')) AS m1, md5(coalesce(html, '') || '#2') AS m2,
         'day ' || (page_id // 10)::VARCHAR AS day FROM pages),
records AS (
  SELECT page_id * 2 AS record_id, url, page_id AS ts, 'response' AS kind, m1 AS etag, day AS modified,
         'text/html' AS ctype, 'no-cache' AS cache, NULL AS dated, m1 AS digest FROM base
  UNION ALL
  SELECT page_id * 2 + 1, url, page_id + 1000000, 'response', m2, NULL, 'text/html', NULL, NULL, m2
  FROM base WHERE page_id % 3 = 0
  UNION ALL
  SELECT page_id * 2 + 1, url, page_id + 1000000, 'revisit',
         CASE WHEN page_id % 7 NOT IN (1, 2) THEN CASE WHEN page_id % 5 = 1 THEN 'other' ELSE m1 END END,
         CASE WHEN page_id % 7 = 2 THEN day END,
         CASE WHEN page_id % 7 NOT IN (1, 2) THEN 'text/plain' END,
         CASE WHEN page_id % 7 NOT IN (1, 2) THEN 'max-age=60' END,
         CASE WHEN page_id % 7 IN (1, 2) THEN 'now' END, NULL
  FROM base WHERE page_id % 3 <> 0),
cut AS (
  SELECT *, regexp_replace(regexp_replace(trim(url), '(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?', ''), '#.*$', '') AS u
  FROM records),
named AS (
  SELECT * EXCLUDE (url, u), regexp_replace(lower(regexp_extract(u, '^[^/?]*')), ':(?:80|443)$', '') ||
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
      regexp_replace(u, '^[^/?]*', ''),
      '([?&])(?:utm_[a-z]+|ref|fbclid|gclid|sessionid)=[^&]*', '\1', 'g'),
      '&{2,}', '&', 'g'), '\?&', '?', 'g'), '[?&]+$', ''), '/(\?|$)', '\1', 'g') AS canonical
  FROM cut),
found AS (
  SELECT n.*, (SELECT max_by(r.record_id, (r.ts, r.record_id)) FROM named r
               WHERE r.kind = 'response' AND r.canonical = n.canonical AND r.ts < n.ts) AS prior_id FROM named n),
judged AS (
  SELECT f.*, r.record_id AS old_id, r.digest AS old_digest, r.modified AS old_modified, r.ctype AS old_ctype,
         r.cache AS old_cache, r.etag AS old_etag,
         CASE WHEN f.kind = 'response' THEN 'full' WHEN r.record_id IS NULL THEN 'missing'
              WHEN f.etag IS NOT NULL THEN CASE WHEN f.etag = r.etag THEN 'resolved' ELSE 'changed' END
              WHEN f.modified IS NOT NULL THEN CASE WHEN f.modified IS NOT DISTINCT FROM r.modified THEN 'resolved' ELSE 'changed' END
              ELSE 'unchecked' END AS outcome
  FROM found f LEFT JOIN named r ON r.record_id = f.prior_id)
SELECT record_id, canonical, kind, outcome,
       CASE outcome WHEN 'full' THEN record_id WHEN 'resolved' THEN old_id END AS payload_id,
       CASE outcome WHEN 'full' THEN digest WHEN 'resolved' THEN old_digest END AS digest,
       CASE WHEN outcome = 'resolved' THEN concat_ws(chr(10), 'cache-control: ' || coalesce(cache, old_cache),
              'content-type: ' || old_ctype, 'date: ' || dated, 'etag: ' || coalesce(etag, old_etag), 'last-modified: ' || old_modified)
            ELSE concat_ws(chr(10), 'cache-control: ' || cache, 'content-type: ' || ctype, 'date: ' || dated, 'etag: ' || etag,
              'last-modified: ' || modified) END AS headers
FROM judged
"""

OP11 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
n AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS r FROM v WHERE list_dot_product(e, e) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.r * b.r) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n_links, 0)::BIGINT AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON l.a = e.vec_id LEFT JOIN counted c ON c.a = e.vec_id
"""

OP12 = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
asked AS (SELECT item_id, term, count(*)::BIGINT AS times FROM q GROUP BY ALL),
held AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY ALL),
size AS (SELECT doc_id, count(*)::BIGINT AS n FROM d GROUP BY doc_id),
corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM size),
weight AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM held, corpus GROUP BY term, docs),
impact AS (
  SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words)) AS i
  FROM held JOIN size USING (doc_id), corpus),
scored AS (
  SELECT item_id, doc_id, sum(times * w * i)::BIGINT AS score FROM asked JOIN weight USING (term) JOIN impact USING (term)
  GROUP BY ALL HAVING sum(times * w * i) > 0)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""

ORACLE = {"op10_warc_revisits": OP10, "op11_near_vectors": OP11, "op12_lexical_search": OP12, "op9_quality_rules": OP9}
