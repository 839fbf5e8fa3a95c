"""DuckDB SQL of the queries that SQL can express (plain all-pairs forms, for small inputs)."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP4 = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
ok AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v
       WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95),
reach(src, dst) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.src, l.b FROM reach r JOIN l ON l.a = r.dst),
comp AS (SELECT src, min(dst) AS component_id FROM reach GROUP BY src),
deg AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN comp ON e.vec_id = comp.src LEFT JOIN deg ON deg.a = e.vec_id
"""

OP5 = f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s FROM w),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
      HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach(src, dst) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.src, l.b FROM reach r JOIN l ON l.a = r.dst)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(dst) AS component_id FROM s JOIN reach ON src = s.doc_id GROUP BY s.doc_id, len(s.s)
"""

SQL = {"op4_embedding_join": OP4, "op5_jaccard_join": OP5}
