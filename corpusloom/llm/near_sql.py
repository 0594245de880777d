"""The SQL the near-copy queries must agree with: plain joins over all rows, for tables of test size."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_COMPONENTS = """
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT id, id AS r FROM nodes UNION SELECT edges.b, reach.r FROM reach JOIN edges ON edges.a = reach.id),
comp AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)"""

NGRAM_JOIN = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
grams AS (
  SELECT DISTINCT id, array_to_string(list_slice(ws, i, i + 4), ' ') AS g FROM (SELECT id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM words WHERE len(ws) > 0)),
nodes AS (SELECT words.id, count(g) AS n FROM words LEFT JOIN grams ON grams.id = words.id GROUP BY words.id),
common AS (SELECT x.id AS a, y.id AS b, count(*) AS o FROM grams x JOIN grams y ON x.g = y.g AND x.id < y.id GROUP BY 1, 2),
pairs AS (SELECT a, b FROM common JOIN nodes p ON p.id = a JOIN nodes q ON q.id = b WHERE 100 * o >= 75 * (p.n + q.n - o)),{_COMPONENTS}
SELECT id AS doc_id, n AS n_shingles, component_id FROM nodes JOIN comp USING (id)"""

SUBSTRINGS = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) > 12)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS f FROM win) WHERE f < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM late),
pos AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS text FROM pos ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(counts.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id LEFT JOIN counts ON counts.doc_id = w.doc_id"""

CAP_FILTERS = f"""
WITH RECURSIVE vectors AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
nodes AS (SELECT id FROM vectors),
sound AS (
  SELECT id, label, e, sqrt(list_inner_product(e, e)) AS n FROM vectors
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_inner_product(e, e) > 0),
pairs AS (SELECT x.id AS a, y.id AS b FROM sound x JOIN sound y ON x.label = y.label AND x.id < y.id AND len(x.e) = len(y.e)
          WHERE list_inner_product(x.e, y.e) >= 0.98 * x.n * y.n),{_COMPONENTS},
links AS (SELECT a AS id, count(*) AS n FROM edges GROUP BY a)
SELECT nodes.id AS vec_id, coalesce(n, 0) AS n_links, component_id, nodes.id = component_id AS kept
FROM nodes JOIN comp USING (id) LEFT JOIN links USING (id)"""
