"""DuckDB SQL for the queries that SQL can express, over whole tables.

None for packing, passages, toxicity, licences and quality rules: learned or procedural
results are tested against brute force, round trips and held-out labels in tests/llm."""

_EXACT = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
                  AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY 1)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, n.text_sha256
FROM n JOIN g USING (text_sha256)
"""

_URL = r"""
WITH p AS (SELECT page_id, coalesce(lower(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's')), '') AS host,
                  coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
r(h, q, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
                      ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'),
                      ('com', '/de/', 'block')),
m AS (SELECT DISTINCT host, path, h || q AS rule, v, length(h) AS hl, length(q) AS ql
      FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q)),
b AS (SELECT host, path, arg_max(rule, hl * 100000 + ql) AS rule, arg_max(v, hl * 100000 + ql) AS v
      FROM m GROUP BY 1, 2)
SELECT page_id, p.host, p.path, b.rule, coalesce(b.v, 'allow') AS verdict
FROM p LEFT JOIN b ON p.host = b.host AND p.path = b.path
"""

_MIX = r"""
WITH d AS (SELECT doc_id, source,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
           FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS total,
             [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w
      FROM d GROUP BY 1),
k AS (SELECT DISTINCT 2 * total / w AS level FROM s),
b AS (SELECT 1.5 * sum(total) AS budget FROM s),
f AS (SELECT level, (SELECT sum(least(2 * total, level * w)) FROM s) AS used FROM k),
t AS (SELECT source, total, 2 * total / w <= coalesce(
             (SELECT max(level) FROM f, b WHERE used <= budget), -1) AS is_full, w FROM s),
u AS (SELECT source, total, CASE WHEN is_full THEN 2 * total ELSE
             ((SELECT budget FROM b) - coalesce((SELECT sum(2 * total) FROM t WHERE is_full), 0))
             * w / (SELECT sum(w) FROM t WHERE NOT is_full) END AS target FROM t),
r AS (SELECT source, total, target, floor(target / total) AS whole,
             target / total - floor(target / total) AS fraction FROM u WHERE total > 0),
h AS (SELECT r.source, i.k, abs(sum(CASE WHEN ('0x' || substr(md5(d.doc_id || ':' || i.k), 1, 13))::BIGINT
             / 4503599627370496.0 < fraction THEN size ELSE 0 END) - any_value(fraction) * any_value(total)) AS off
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source, (SELECT unnest(range(16)) AS k) i
      WHERE fraction > 0 AND size > 0 GROUP BY 1, 2),
c AS (SELECT source, arg_min(k, (off, k)) AS seed FROM h GROUP BY 1)
SELECT d.doc_id, d.size, u.total::BIGINT AS source_size, coalesce(u.target, 0) AS target,
       (coalesce(whole, 0) + CASE WHEN ('0x' || substr(md5(d.doc_id || ':' || coalesce(seed, 0)), 1, 13))::BIGINT
             / 4503599627370496.0 < fraction THEN 1 ELSE 0 END)::BIGINT * d.size AS taken,
       d.source, (coalesce(whole, 0) + CASE WHEN ('0x' || substr(md5(d.doc_id || ':' || coalesce(seed, 0)), 1, 13))::BIGINT
             / 4503599627370496.0 < fraction THEN 1 ELSE 0 END)::BIGINT AS copies
FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source
LEFT JOIN r ON d.source IS NOT DISTINCT FROM r.source
LEFT JOIN c ON d.source IS NOT DISTINCT FROM c.source
"""

_NEAR = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS a FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(a[i:i + 4], chr(10)) AS shingle
      FROM (SELECT doc_id, a, unnest(range(1, greatest(len(a) - 3, 2))) AS i FROM w WHERE len(a) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
x AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b USING (shingle)
      WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM x JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
      WHERE 100 * common >= 85 * (p.n + q.n - common)),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM documents
                     UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.reach = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY 1) c USING (doc_id)
"""

_LINES = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents),
t AS (SELECT doc_id, no, line, lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS k FROM l),
f AS (SELECT k, min((doc_id, no)) AS first, length(k) AS n FROM t WHERE k <> '' GROUP BY k),
h AS (SELECT k, first, n, m, 0 AS side, left(k, (m // 2)::INT) AS part
      FROM f, LATERAL (SELECT unnest([n, n - 1]) AS m) WHERE n >= 15
      UNION ALL SELECT k, first, n, m, 1, right(k, (m - m // 2 - 1)::INT)
      FROM f, LATERAL (SELECT unnest([n, n - 1]) AS m) WHERE n >= 15),
c AS (SELECT DISTINCT a.k AS x, b.k AS y FROM h a JOIN h b USING (m, side, part)
      WHERE b.first < a.first AND a.n >= 16 AND b.n >= 16 AND abs(a.n - b.n) <= 1),
z AS (SELECT DISTINCT x AS k FROM (
        SELECT x, y, unnest(range(1, greatest(length(x), length(y)) + 1)) AS i FROM c)
      WHERE CASE WHEN length(x) = length(y)
                 THEN left(x, (i - 1)::INT) = left(y, (i - 1)::INT) AND substr(x, i + 1) = substr(y, i + 1)
                 WHEN length(x) > length(y) THEN left(x, (i - 1)::INT) || substr(x, i + 1) = y
                 ELSE left(y, (i - 1)::INT) || substr(y, i + 1) = x END),
g AS (SELECT t.doc_id, t.no, t.line, t.k, z.k IS NOT NULL AS near,
             t.k <> '' AND z.k IS NULL AND (t.doc_id, t.no) > f.first AS again
      FROM t LEFT JOIN f USING (k) LEFT JOIN z USING (k))
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT near AND NOT again), '') AS text,
       count(*) FILTER (k <> '') AS n_lines, count(*) FILTER (again) AS n_exact,
       count(*) FILTER (near) AS n_near
FROM g GROUP BY doc_id
"""

_SEARCH = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS a FROM documents),
b AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark),
s AS (SELECT count(*) AS n_docs, sum(len(a))::BIGINT AS total FROM d WHERE len(a) > 0),
p AS (SELECT doc_id, term, count(*) AS tf, any_value(n) AS n
      FROM (SELECT doc_id, len(a)::BIGINT AS n, unnest(a) AS term FROM d) GROUP BY 1, 2),
f AS (SELECT term, count(*) AS df FROM p GROUP BY 1),
w AS (SELECT b.item_id, b.term,
             floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM b JOIN f USING (term), s),
x AS (SELECT item_id, doc_id,
             sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // total))))::BIGINT AS score
      FROM w JOIN p USING (term), s GROUP BY 1, 2),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank,
             doc_id, score FROM x WHERE score > 0)
SELECT * FROM r WHERE rank <= 50
"""

LLM_ORACLE = {"op2_line_dedup": _LINES, "op5_exact_dedup": _EXACT, "op6_url_filters": _URL,
              "op7_mixing": _MIX, "op10_minhash": _NEAR, "op12_lexical_search": _SEARCH}
