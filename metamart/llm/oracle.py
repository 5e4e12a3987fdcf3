"""DuckDB SQL of the queries that SQL can express on whole tables."""

_REACH = """reach(id, root) AS (
  SELECT id, id FROM nodes
  UNION
  SELECT pair2.b, reach.root FROM reach JOIN pair2 ON pair2.a = reach.id)"""

ORACLE_SQL = {
    "op7_embedding_dedup": f"""
WITH RECURSIVE v AS (
  SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings),
ok AS (
  SELECT vec_id, e FROM v
  WHERE len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
    AND list_sum([x * x FOR x IN e]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
  ON a.vec_id < b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
pair2 AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
nodes AS (SELECT DISTINCT a AS id FROM pair2),
{_REACH},
root AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
n AS (SELECT a AS id, count(*) AS n FROM pair2 GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(root.root, v.vec_id) AS component_id,
       coalesce(root.root, v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN n ON n.id = v.vec_id LEFT JOIN root ON root.id = v.vec_id""",
    "op10_minhash_dedup": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM w),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs WHERE 100 * c >= 85 * (na + nb - c)),
pair2 AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
nodes AS (SELECT DISTINCT a AS id FROM pair2),
{_REACH},
root AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
same AS (SELECT doc_id, CASE WHEN len(s) > 0 THEN count(*) OVER (PARTITION BY list_sort(s)) ELSE 1 END AS copies FROM sets)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(root.root, sets.doc_id) AS component_id,
       coalesce(root.root, sets.doc_id) = sets.doc_id AS kept, CAST(same.copies AS BIGINT) AS n_copies
FROM sets JOIN same USING (doc_id) LEFT JOIN root ON root.id = sets.doc_id""",
}
