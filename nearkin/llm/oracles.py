"""SQL for the queries of the llm operators, for DuckDB."""

from __future__ import annotations

SQL = {}

SQL["op1_quality_rules"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         string_split(coalesce(text, ''), chr(10)) AS all_lines
  FROM documents
), windows AS (
  SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (
    SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) >= 3)
), twice AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1
), covered AS (
  SELECT r, count(DISTINCT i + j) AS n FROM twice, range(3) g(j) GROUP BY r
), s AS (
  SELECT doc_id, text, len(all_lines) AS n_lines, len(w) AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(regexp_extract_all(text, '\p{Lu}')) AS capitals,
         len(list_filter(all_lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
           - len(list_distinct(list_filter(all_lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words
  FROM t LEFT JOIN covered USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_symbols * 10 > n_words
            OR capitals * 10 > word_chars * 4 OR word_chars < n_words * 2 OR word_chars > n_words * 15
            OR (n_dup_lines >= 4 AND n_dup_lines * 2 > n_lines)) AS kept
FROM s
"""

SQL["op2_substring_dedup"] = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM (
    SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM t WHERE len(w) >= 20)
), repeats AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1
), removed AS (
  SELECT DISTINCT doc_id, i + j AS p FROM repeats, range(20) g(j)
), places AS (
  SELECT doc_id, w[p] AS word, p FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM t)
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM places ANTI JOIN removed USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN (SELECT doc_id, count(*) AS n FROM removed GROUP BY doc_id) USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

SQL["op3_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS codes FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id,
         list_sum(list_transform(range(1, least(len(q.codes), len(d.codes)) + 1), lambda i: q.codes[i] * d.codes[i]))::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 10
"""


SQL["op9_ngram_jaccard"] = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM t WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), o AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM t UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, coalesce(l.n_links, 0) AS n_links
FROM t LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a) l USING (doc_id)
"""

SQL["op6_url_filter"] = r"""
WITH RECURSIVE rules(domain, start, action) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), p AS (
  SELECT page_id, url, split_part(url, '#', 1) AS node, regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) AS root,
         regexp_extract(url, '(?s)^(.*?://[^?#]*/)', 1) AS folder, html, row_number() OVER () AS r
  FROM pages
), raw AS (
  SELECT *, unnest([
    regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
    regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1)
  ]) AS escaped FROM p WHERE contains(url, '://')
), links AS (
  SELECT node AS a, split_part(CASE
      WHEN contains(link, '://') THEN link
      WHEN starts_with(link, '//') THEN split_part(url, '://', 1) || ':' || link
      WHEN starts_with(link, '/') THEN root || link
      WHEN folder = '' OR ends_with(folder, '://') THEN root || '/' || link
      ELSE folder || link END, '#', 1) AS b
  FROM (SELECT *, replace(escaped, '&amp;', '&') AS link FROM raw WHERE escaped <> '')
), edges AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach(a, b) AS (
  SELECT a, a FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a
), urls AS (
  SELECT url FROM p UNION SELECT b FROM reach
), parts AS (
  SELECT url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM urls
), best AS (
  SELECT url, host, path, domain || start AS rule, action
  FROM parts LEFT JOIN rules ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, start)
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY length(domain || start) DESC, action) = 1
), passed AS (
  SELECT r.a AS node, bool_or(action = 'allow') AS allowed, bool_or(action = 'block') AS blocked
  FROM reach r JOIN best ON best.url = r.b GROUP BY 1
)
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN allowed THEN 'allow' WHEN blocked THEN 'block' END, 'allow') AS verdict
FROM p JOIN best ON best.url IS NOT DISTINCT FROM p.url LEFT JOIN passed USING (node)
"""


def _urn(*parts: str) -> str:
    """SQL for a record id: the md5 of the parts, one a line, as a UUID."""
    x = "md5(" + " || chr(10) || ".join(parts) + ")"
    return f"'<urn:uuid:' || regexp_replace({x}, '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})', '\\1-\\2-\\3-\\4-') || '>'"


def _entities(text: str) -> str:
    for name, character in (
        ("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("apos", "''"), ("copy", "©"), ("middot", "·"),
        ("ndash", "–"), ("mdash", "—"), ("hellip", "…"), ("amp", "&"),
    ):
        text = f"replace({text}, '&{name};', '{character}')"
    return text


def _plain(html: str) -> str:
    for pattern in (r"(?s)<!--.*?-->", *(rf"(?is)<{t}\b[^>]*>.*?</{t}\s*>" for t in ("script", "style", "noscript", "head"))):
        html = f"regexp_replace({html}, '{pattern}', ' ', 'g')"
    blocks = (r"(?i)</?(?:p|div|br|hr|h[1-6]|li|ul|ol|dl|dt|dd|tr|table|article|section|aside|main|nav|header|footer"
              r"|blockquote|pre|form|body|html)\b[^>]*>")
    html = rf"regexp_replace(regexp_replace({html}, '[ \t\r\n\f]+', ' ', 'g'), '{blocks}', chr(10), 'g')"
    html = _entities(f"regexp_replace({html}, '<[^>]*>', '', 'g')")
    return rf"regexp_replace(regexp_replace({html}, ' *\n[ \n]*', chr(10), 'g'), '^[ \n]+|[ \n]+$', '', 'g')"


SQL["op7_warc_derivatives"] = rf"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS html, chr(13) || chr(10) AS eol FROM pages
), r AS (
  SELECT *, 'sha256:' || sha256(html) AS payload_digest,
         'HTTP/1.1 200 OK' || eol || 'Content-Type: text/html; charset=utf-8' || eol || 'Content-Length: ' || strlen(html) AS http
  FROM p
), s AS (
  SELECT *, {_urn("'response'", "coalesce(page_id::VARCHAR, '')", "target_uri", "payload_digest")} AS refers_to,
         trim({_entities(r"regexp_replace(regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title', 1), '[ \t\r\n\f]+', ' ', 'g')")}) AS title,
         regexp_extract(html, '(?is)<html\b[^>]*\blang\s*=\s*["'']?([A-Za-z0-9-]+)', 1) AS lang
  FROM r
), d AS (
  SELECT page_id, target_uri, payload_digest, refers_to, eol, 'conversion' AS warc_type, {_urn("'conversion'", "refers_to")} AS record_id,
         'text/plain; charset=utf-8' AS content_type, {_plain("html")} AS block
  FROM s
  UNION ALL
  SELECT page_id, target_uri, payload_digest, refers_to, eol, 'metadata', {_urn("'metadata'", "refers_to")}, 'application/warc-fields',
         'title: ' || title || eol || 'language: ' || lang || eol || 'conversion: ' || {_urn("'conversion'", "refers_to")} || eol
           || 'source-payload-digest: ' || payload_digest || eol || 'http-header: ' || replace(http, eol, eol || 'http-header: ') || eol
  FROM s
)
SELECT page_id, warc_type, record_id, refers_to, target_uri, '1970-01-01T00:00:00Z' AS date, payload_digest, content_type, block,
       'sha256:' || sha256(block) AS block_digest, strlen(block) AS content_length,
       'WARC/1.1' || eol || 'WARC-Type: ' || warc_type || eol || 'WARC-Record-ID: ' || record_id || eol
         || 'WARC-Date: 1970-01-01T00:00:00Z' || eol || 'WARC-Target-URI: ' || target_uri || eol || 'WARC-Refers-To: ' || refers_to || eol
         || 'WARC-Block-Digest: sha256:' || sha256(block) || eol || 'Content-Type: ' || content_type || eol
         || 'Content-Length: ' || strlen(block) || eol || eol AS header
FROM d
"""

SQL["op13_importance_resampling"] = r"""
WITH RECURSIVE steps(v, c, i) AS (
  SELECT v::BIGINT, v::BIGINT, 0 FROM range(256) g(v)
  UNION ALL SELECT v, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i + 1 FROM steps WHERE i < 8
), step AS (
  SELECT list(c ORDER BY v) AS crc FROM steps WHERE i = 8
), texts AS (
  SELECT 'd' AS side, row_number() OVER () AS r, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), text FROM benchmark
), cut AS (
  SELECT side, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), features AS (
  SELECT side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM cut
), counted AS (
  SELECT side, r, feature, count(*) AS n FROM features GROUP BY ALL
), bytes AS (
  SELECT feature, list_transform(range(0, strlen(feature)), lambda i: ('0x' || substr(hex(encode(feature)), 2 * i + 1, 2))::BIGINT) AS b
  FROM (SELECT DISTINCT feature FROM counted)
), keyed AS (
  SELECT feature, xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, step
), sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t
  FROM counted JOIN keyed USING (feature) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE)))::BIGINT AS gain
  FROM sums, (SELECT sum(s) AS all_s, sum(t) AS all_t FROM sums)
), weighed AS (
  SELECT r, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight
  FROM counted JOIN keyed USING (feature) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r
), scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM (SELECT row_number() OVER () AS r, doc_id FROM documents) JOIN (SELECT r, w FROM cut WHERE side = 'd') USING (r) LEFT JOIN weighed USING (r)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END AS rank FROM placed
"""

SQL["op12_phrase_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                     '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), cut AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), f AS (
  SELECT lang, words, phrase, count(*) AS f FROM (
    SELECT lang, k AS words, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM cut, range(1, 5) g(k) WHERE len(w) >= k)
  GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang
), candidates AS (
  SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words >= 2 AND f >= 30
), cuts AS (
  SELECT lang, phrase, k, array_to_string(w[1:k], ' ') AS front, array_to_string(w[k + 1:], ' ') AS rest, a
  FROM (SELECT *, unnest(range(1, words)) AS k FROM candidates)
), scored AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, 2000000::HUGEINT * c.a // (x.f + y.f) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.front JOIN f y ON y.lang = c.lang AND y.phrase = c.rest
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY 2000000::HUGEINT * c.a // (x.f + y.f), k) = 1
), inside AS (
  SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(a) AS longer
  FROM candidates, range(2, 4) g(m), range(1, 4) h(s) WHERE m < words AND s + m - 1 <= words GROUP BY 1, 2
), kept AS (
  SELECT s.* FROM scored s LEFT JOIN inside i USING (lang, phrase) WHERE NOT coalesce(100 * longer >= 80 * a, false)
), best AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept QUALIFY rank <= 2000
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM best JOIN totals USING (lang)
"""
