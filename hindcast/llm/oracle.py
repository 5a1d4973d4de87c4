"""The same results in DuckDB's SQL, where SQL can express them."""

_COMPONENTS = """r AS (SELECT DISTINCT x AS id, x AS top FROM l UNION SELECT r.id, l.y FROM r JOIN l ON l.x = r.top),
c AS (SELECT id, min(top) AS component_id FROM r GROUP BY 1)"""

OP2 = r"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 18, 1))) AS i FROM w),
e AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(ws[i:i + 19], ' ') ORDER BY doc_id, i) > 1 AS again FROM s),
gone AS (SELECT DISTINCT doc_id, i + o AS p FROM e, range(20) t(o) WHERE again),
p AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM w),
k AS (SELECT p.doc_id, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY p.p) FILTER (WHERE gone.p IS NULL) AS kept FROM p LEFT JOIN gone ON gone.doc_id = p.doc_id AND gone.p = p.p GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)"""

OP4 = f"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL),
u AS (SELECT vec_id, label, e FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
{_COMPONENTS}, n AS (SELECT x, count(*) AS n_links FROM l GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(component_id, vec_id)) AS component_id, vec_id <= coalesce(component_id, vec_id) AS kept FROM embeddings LEFT JOIN c ON id = vec_id LEFT JOIN n ON x = vec_id"""

OP7 = rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
m AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM m JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)),
{_COMPONENTS}
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(component_id, w.doc_id)) AS component_id FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c ON id = w.doc_id"""

OP12 = r"""WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
i AS (SELECT row_number() OVER () AS i, * FROM d),
t AS (SELECT i, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM i),
k AS (SELECT lang, term, count(*) AS c FROM t GROUP BY 1, 2 HAVING count(DISTINCT i) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
l AS (SELECT lang, count(*) AS v, sum(c) AS n FROM k GROUP BY 1),
o AS (SELECT t.lang, source, term, count(*) AS c FROM t JOIN k USING (lang, term) GROUP BY 1, 2, 3),
s AS (SELECT g.lang, g.source, coalesce(sum(o.c), 0) AS n FROM g LEFT JOIN o ON o.lang = g.lang AND o.source = g.source GROUP BY 1, 2),
p AS (SELECT g.lang, g.source, k.term, coalesce(o.c, 0) AS c, CAST(1 + (1000000000 * (CAST(coalesce(o.c, 0) AS HUGEINT) + 5)) // CAST(s.n + 5 * l.v AS HUGEINT) AS BIGINT) AS p, CAST(1 + (1000000000 * (CAST(k.c AS HUGEINT) + 5)) // CAST(l.n + 5 * l.v AS HUGEINT) AS BIGINT) AS q
FROM g JOIN l USING (lang) JOIN k USING (lang) JOIN s ON s.lang = g.lang AND s.source = g.source LEFT JOIN o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q),
n AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r)
SELECT lang, source, part, item, value, rank FROM n WHERE part = 'pair' OR rank <= 50"""
