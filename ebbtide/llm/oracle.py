"""DuckDB statements of the queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op1_suffix_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS k
      FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM d)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS nth FROM w),
g AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END AS opens FROM f WHERE nth > 1),
n AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM g),
s AS (SELECT doc_id, span, min(i) AS a, max(i) + 100 AS b FROM n GROUP BY ALL),
p AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM s),
k AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS removed, max(b) AS tail,
             string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
      FROM p JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

ORACLE["op2_exact_dedup"] = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

ORACLE["op4_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_aggregate(w[i : i + 2], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS root FROM n UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node WHERE r.root < e.b)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.root, w.doc_id) AS component_id, coalesce(k.n_links, 0) AS n_links
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, count(*) AS n_links FROM e GROUP BY a) k ON k.a = w.doc_id LEFT JOIN (SELECT node, min(root) AS root FROM r GROUP BY node) c ON c.node = w.doc_id
"""

_BLANK = r"[ \t\r\f\x0B]+"
ORACLE["op6_line_dedup"] = rf"""
WITH t AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, text, unnest(lines) AS line, unnest(range(0, len(lines))) AS pos FROM t WHERE text IS NOT NULL),
m AS (SELECT doc_id, text, pos, regexp_replace(regexp_replace(line, '^{_BLANK}|{_BLANK}$', '', 'g'), '[^ \t\r\f\x0B]*[0-9][^ \t\r\f\x0B]*', '<*>', 'g') AS m FROM l),
k AS (SELECT doc_id, text, pos, string_split_regex(m, '{_BLANK}') AS w FROM m WHERE m <> ''),
v AS (SELECT doc_id, text, pos, w, len(w) AS n, w[1:3] AS path FROM k),
f AS (SELECT n, path FROM v GROUP BY n, path HAVING count(DISTINCT w) > 1 AND count(*) >= 4),
c AS (SELECT n, path, place, count(DISTINCT token) = 1 AS same
      FROM (SELECT v.n, v.path, unnest(w) AS token, unnest(range(0, v.n)) AS place FROM v JOIN f ON v.n = f.n AND v.path = f.path) GROUP BY ALL),
g AS (SELECT n, path FROM c GROUP BY n, path HAVING sum(same::int) >= n * 0.75),
x AS (SELECT doc_id, text, pos, CASE WHEN g.n IS NULL THEN v.w ELSE [v.n::varchar, '', array_to_string(v.path, ' ')] END AS t, g.n IS NOT NULL AS general
      FROM v LEFT JOIN g ON v.n = g.n AND v.path = g.path),
r AS (SELECT t, general, min((doc_id, pos)) AS first FROM x GROUP BY t, general HAVING count(DISTINCT text) >= 4),
o AS (SELECT doc_id, list(pos) AS gone FROM x JOIN r ON x.t = r.t AND x.general = r.general WHERE (doc_id, pos) <> first GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_dropped,
       sha256(CASE WHEN gone IS NULL THEN text ELSE
         coalesce(array_to_string([lines[i + 1] FOR i IN range(0, len(lines)) IF NOT list_contains(gone, i)], chr(10)), '') END) AS kept_sha256
FROM t LEFT JOIN o USING (doc_id)
"""

ORACLE["op7_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT vec_id, unnest(e) AS c, unnest(range(0, len(e))) AS i FROM v),
s AS (SELECT q.vec_id AS query_id, u.vec_id, CAST(sum(q.c * u.c) AS BIGINT) AS score
      FROM u q JOIN u ON q.i = u.i AND q.vec_id <> u.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE["op13_ranked_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS n_all, sum(len(w)) AS l_all FROM d WHERE len(w) > 0),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
i AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
f AS (SELECT term, CAST(floor(1000 * ln((2 * n_all + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM p, s GROUP BY term, n_all),
v AS (SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_all) // l_all))) AS v FROM p, s),
o AS (SELECT item_id, r, doc_id, CAST(sum(w * v) AS BIGINT) AS score FROM i JOIN f USING (term) JOIN v USING (term) GROUP BY item_id, r, doc_id HAVING sum(w * v) > 0),
k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM o)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 50
"""
