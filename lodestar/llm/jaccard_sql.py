"""SQL of the Jaccard join."""

JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM words),
nodes AS (SELECT s, min(doc_id) AS node, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
grams AS (SELECT node, n, unnest(s) AS gram FROM nodes),
links AS (SELECT x.node AS a, y.node AS b FROM grams x JOIN grams y ON x.gram = y.gram AND x.node < y.node AND 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
  GROUP BY x.node, y.node, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT node, node AS other FROM nodes UNION SELECT r.node, l.b FROM reach r JOIN ways l ON l.a = r.other),
parts AS (SELECT node, min(other) AS least FROM reach GROUP BY node)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(p.least, d.doc_id) AS component_id
FROM sets d LEFT JOIN nodes n ON n.s = d.s LEFT JOIN parts p ON p.node = n.node
"""
