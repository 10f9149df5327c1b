"""SQL for the operators whose links and classes SQL can spell out on small tables."""

from __future__ import annotations

NEAR_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
t AS (SELECT t, min(doc_id) AS rep FROM d GROUP BY t),
s AS (SELECT rep, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM t JOIN d ON d.doc_id = t.rep),
c AS (SELECT rep, g, count(*) AS n FROM s GROUP BY ALL),
z AS (SELECT rep, sum(n) AS n FROM c GROUP BY 1),
o AS (SELECT a.rep AS x, b.rep AS y, sum(least(a.n, b.n)) AS m FROM c a JOIN c b ON a.g = b.g AND a.rep <> b.rep GROUP BY 1, 2),
l AS (SELECT x, y FROM o JOIN z p ON p.rep = x JOIN z q ON q.rep = y WHERE 5 * m >= 4 * (p.n + q.n - m)),
r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
k AS (SELECT x, min(y) AS y FROM r GROUP BY 1)
SELECT d.doc_id, least(t.rep, coalesce(k.y, t.rep)) AS class_id, d.doc_id = least(t.rep, coalesce(k.y, t.rep)) AS kept FROM d JOIN t USING (t) LEFT JOIN k ON k.x = t.rep
"""

VECTOR_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
k AS (SELECT x, min(y) AS y FROM r GROUP BY 1),
n AS (SELECT x, count(*) AS n FROM l GROUP BY 1)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(k.y, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(k.y, vec_id)) AS kept FROM v LEFT JOIN k ON k.x = vec_id LEFT JOIN n ON n.x = vec_id
"""
