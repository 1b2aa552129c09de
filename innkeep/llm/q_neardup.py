"""op9: near duplicates among all documents, on two-word shingles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from innkeep.llm import neardup


def op9_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return neardup.near_duplicates(docs, "doc_id", "text", shingle=2, similarity=(80, 100)).withColumnRenamed("id", "doc_id")


QUERIES = {"op9_circulant_minhash": op9_circulant_minhash}
ORACLE = {
    "op9_circulant_minhash": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM w WHERE len(w) > 0)),
c AS (SELECT doc_id, count(*) AS n, bit_xor(hash(s)) AS x FROM s GROUP BY doc_id),
r AS (SELECT n, x, min(doc_id) AS rep FROM c GROUP BY n, x),
t AS (SELECT s.* FROM s JOIN r ON doc_id = rep),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM t a JOIN t b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN c ca ON a = ca.doc_id JOIN c cb ON b = cb.doc_id WHERE 100 * i >= 80 * (ca.n + cb.n - i)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
g(node, seen) AS (SELECT rep, rep FROM r UNION SELECT e.b, g.seen FROM g JOIN e ON g.node = e.a),
k AS (SELECT node, min(seen) AS component FROM g GROUP BY node)
SELECT d.doc_id, coalesce(c.n, 0)::BIGINT AS n_shingles, coalesce(k.component, d.doc_id) AS component_id, d.doc_id = coalesce(k.component, d.doc_id) AS kept
FROM documents d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN r ON c.n = r.n AND c.x = r.x LEFT JOIN k ON r.rep = k.node"""
}
