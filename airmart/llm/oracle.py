"""DuckDB SQL for the queries that SQL can express (written without the operators' code)."""

OP8 = r"""
WITH best AS (SELECT doc_id, max(quality) AS q FROM labels GROUP BY doc_id),
d AS (
  SELECT t.doc_id, t.source, coalesce(len(regexp_extract_all(t.text, '[^\x20\x09-\x0D]+')), 0) AS size,
         -ln((CAST('0x' || substr(md5(coalesce(CAST(t.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)
           / CASE b.q WHEN 1 THEN 1.0 WHEN 0 THEN 0.5 ELSE 0.75 END AS k
  FROM documents t LEFT JOIN best b ON t.doc_id = b.doc_id),
s AS (SELECT source, sum(size)::DOUBLE AS size FROM d GROUP BY source),
w AS (SELECT source, size, 2 * size AS cap, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS wt FROM s),
-- A level at which the caps bind is one where the shares add up to the total: try the level at every cap.
lv AS (SELECT (SELECT 1.5 * sum(size) FROM s) AS total, a.cap / a.wt AS r,
              (SELECT coalesce(sum(cap), 0) FROM w b WHERE b.cap / b.wt < a.cap / a.wt) AS used,
              (SELECT sum(wt) FROM w b WHERE b.cap / b.wt >= a.cap / a.wt) AS wts FROM w a),
level AS (SELECT max((total - used) / wts) AS l FROM lv WHERE (total - used) / wts <= r),
t AS (SELECT source, size, CASE WHEN l IS NULL THEN cap ELSE least(cap, l * wt) END AS target FROM w, level),
e AS (SELECT *, coalesce(floor(target / nullif(size, 0)), 0) AS epochs FROM t),
p AS (SELECT d.doc_id, d.size, e.size AS source_size, e.target, e.epochs, e.target - e.epochs * e.size AS rest,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS before
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target::DOUBLE AS target,
       (size * (epochs + CASE WHEN before < rest AND before + size / 2.0 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""

OP9 = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS digest, b FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY b) AS last FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
FROM g
"""

OP2 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
word AS (SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d)),
tri AS (SELECT r, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM word WINDOW o AS (PARTITION BY r ORDER BY i)),
often AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w, w2, w3) AS n FROM tri WHERE w3 IS NOT NULL) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM often, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
words AS (SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars FROM word GROUP BY r),
line AS (SELECT r, unnest(ls) AS l, unnest(range(len(ls))) AS i FROM (SELECT r, string_split(t, chr(10)) AS ls FROM d)),
lw AS (SELECT r, i, l, regexp_extract_all(l, '[^\x20\x09-\x0D]+') AS ws FROM line),
judged AS (
  SELECT r, len(ws) AS n, row_number() OVER (PARTITION BY r, l ORDER BY i) > 1 AS dup,
    (len(ws) >= 3 AND len(list_filter(ws, lambda x: x IN ('|', '>', '>>', '/', '·', '•', '»', '→'))) >= 0.2 * len(ws))
    OR (len(ws) <= 25 AND regexp_matches(l, 'all rights reserved|copyright|licensed under|terms of (?:use|service)|privacy policy|cookies?\b|javascript|lorem ipsum|click here|read more|sign up|log ?in\b|subscribe|share this|skip to (?:main )?content', 'i'))
    OR NOT regexp_matches(l, '[A-Za-z]|[^\x00-\x{BF}]')
    OR (len(ws) >= 60 AND NOT regexp_matches(l, '[.!?:;,…。！？，]'))
    OR (len(ws) >= 3 AND len(list_filter(ws, lambda x: regexp_matches(x, '[#*$%&|<>~^=_+@{}!?]{2,}[.,;:]?$'))) > 0.3 * len(ws)) AS fails
  FROM lw WHERE len(ws) > 0),
lines AS (SELECT r, count(*) FILTER (WHERE dup) AS n_dup_lines, count(*) FILTER (WHERE fails) AS n_failed_lines,
                 coalesce(sum(n) FILTER (WHERE fails), 0) AS n_lost_words FROM judged GROUP BY r),
f AS (SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_failed_lines, 0)::BIGINT AS n_failed_lines,
             coalesce(n_lost_words, 0)::BIGINT AS n_lost_words
      FROM d LEFT JOIN words USING (r) LEFT JOIN rep USING (r) LEFT JOIN lines USING (r)),
g AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND n_lost_words <= 0.5 * n_words AS kept FROM g
"""

OP6 = r"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, url,
                  CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT r, page_id, url, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM p),
rules(h, pre, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (SELECT r, arg_max(h || pre, length(h || pre)) AS rule, arg_max(v, length(h || pre)) AS v
         FROM q JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre) GROUP BY r),
u AS (SELECT q.*, rule, v, CAST('0x' || substr(md5(url), 1, 4) AS INT) % 5 AS fold FROM q LEFT JOIN best USING (r)),
sym AS (SELECT r, regexp_replace(regexp_replace(lower(url), '[0-9]', '0', 'g'), '[^a-z0./\-_?=&%:#~+@]', '*', 'g') AS s FROM u),
ch AS (SELECT r, i, instr('abcdefghijklmnopqrstuvwxyz0./-_?=&%:#~+@*', substr(s, i, 1)) AS c FROM (SELECT r, s, unnest(range(1, length(s) + 1)) AS i FROM sym)),
g AS (SELECT r, lag(c, 2, 0) OVER o AS a, lag(c, 1, 0) OVER o AS b, c FROM ch WINDOW o AS (PARTITION BY r ORDER BY i)),
cls AS (SELECT unnest(['allow', 'block']) AS v),
n3 AS (SELECT v, a, b, c, count(*) AS n FROM g JOIN u USING (r) WHERE v IS NOT NULL AND fold <> 0 GROUP BY ALL),
nab AS (SELECT v, a, b, sum(n) AS n FROM n3 GROUP BY ALL), nbc AS (SELECT v, b, c, sum(n) AS n FROM n3 GROUP BY ALL),
nb AS (SELECT v, b, sum(n) AS n FROM n3 GROUP BY ALL), nc AS (SELECT v, c, sum(n) AS n FROM n3 GROUP BY ALL), na AS (SELECT v, sum(n) AS n FROM n3 GROUP BY ALL),
grams AS (SELECT DISTINCT a, b, c FROM g),
lp AS (SELECT x.a, x.b, x.c, cls.v,
         ln((coalesce(n3.n, 0) + 2.0 * ((coalesce(nbc.n, 0) + 2.0 * ((coalesce(nc.n, 0) + 2.0 / 42) / (coalesce(na.n, 0) + 2.0))) / (coalesce(nb.n, 0) + 2.0)))
            / (coalesce(nab.n, 0) + 2.0)) AS l
       FROM grams x CROSS JOIN cls
       LEFT JOIN n3 ON n3.v = cls.v AND n3.a = x.a AND n3.b = x.b AND n3.c = x.c LEFT JOIN nab ON nab.v = cls.v AND nab.a = x.a AND nab.b = x.b
       LEFT JOIN nbc ON nbc.v = cls.v AND nbc.b = x.b AND nbc.c = x.c LEFT JOIN nb ON nb.v = cls.v AND nb.b = x.b
       LEFT JOIN nc ON nc.v = cls.v AND nc.c = x.c LEFT JOIN na ON na.v = cls.v),
ratio AS (SELECT a, b, c, sum(CASE v WHEN 'allow' THEN l ELSE -l END) AS d FROM lp GROUP BY ALL),
score AS (SELECT r, avg(d) AS s FROM g JOIN ratio USING (a, b, c) GROUP BY r),
held AS (SELECT url, v, any_value(coalesce(s, 0)) AS s FROM u LEFT JOIN score USING (r) WHERE v IS NOT NULL AND fold = 0 GROUP BY url, v),
t AS (SELECT coalesce(((SELECT avg(s) FROM held WHERE v = 'allow') + (SELECT avg(s) FROM held WHERE v = 'block')) / 2, 0) AS t)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN coalesce(s, 0) >= t THEN 'allow' ELSE 'block' END) AS verdict
FROM u LEFT JOIN score USING (r), t
"""

OP4 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i, len(ws) AS n FROM d),
g AS (SELECT doc_id, n, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o AS s FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
sh AS (SELECT DISTINCT doc_id, s FROM g WHERE s IS NOT NULL UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 3),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
ends AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT a AS id, a AS r FROM ends UNION SELECT reach.id, ends.b FROM reach JOIN ends ON reach.r = ends.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(min(reach.r), d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.id = d.doc_id GROUP BY d.doc_id, n.n
"""

OP7 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i, len(ws) AS n FROM d),
win AS (SELECT doc_id, i, n, string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS s FROM w),
g AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM win WHERE i + 13 <= n),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM g, (SELECT unnest(range(13)) AS k) WHERE first < doc_id),
kept AS (SELECT doc_id, count(*) AS n, count(gone.i) AS x, coalesce(string_agg(w, ' ' ORDER BY i) FILTER (WHERE gone.i IS NULL), '') AS t
         FROM w LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(x, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP12 = r"""
WITH e AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS s
      FROM e a, e b WHERE a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.q) = len(b.q)),
p AS (SELECT a, anchor_id, id AS positive_id, s AS ps, row_number() OVER (PARTITION BY a ORDER BY s DESC, id, b) AS k FROM s WHERE same QUALIFY k <= 5)
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.a, p.k ORDER BY s.s DESC, s.id, s.b)::INT AS rank, s.id AS negative_id,
       p.ps AS positive_score, s.s AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.ps <= 100 * s.s AND 100 * s.s <= 90 * p.ps
QUALIFY rank <= 10
"""

OP13 = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
piece AS (SELECT lang, regexp_extract_all(x, '[^\x20\x09]+') AS ws
          FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS x FROM d)),
total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM piece GROUP BY lang),
gram AS (SELECT lang, ws[i:i + m - 1] AS w
         FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM piece, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(ws) >= m)),
c AS (SELECT lang, w, len(w) AS m, array_to_string(w, ' ') AS phrase, count(*) AS f FROM gram GROUP BY lang, w HAVING count(*) >= 30),
cut AS (SELECT *, unnest(range(1, m)) AS k FROM c WHERE m >= 2),
scored AS (SELECT cut.*, x.f AS l, y.f AS r, ((2000000::HUGEINT * cut.f) // (x.f + y.f))::BIGINT AS score
           FROM cut JOIN c x ON x.lang = cut.lang AND x.w = cut.w[1:k] JOIN c y ON y.lang = cut.lang AND y.w = cut.w[k + 1:cut.m]),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
stay AS (SELECT * FROM low WHERE NOT EXISTS (
  SELECT 1 FROM c q WHERE q.lang = low.lang AND q.m > low.m AND 100 * q.f >= 80 * low.f AND contains(' ' || q.phrase || ' ', ' ' || low.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS rank, phrase, f AS a, l, r, n, score
FROM stay JOIN total USING (lang) QUALIFY rank <= 2000
"""

ORACLE = {"op2_quality_rules": OP2, "op4_ngram_jaccard_join": OP4, "op6_url_filter": OP6, "op7_substring_dedup": OP7,
          "op8_source_mix": OP8, "op9_warc": OP9, "op12_hard_negatives": OP12, "op13_phrase_mining": OP13}
