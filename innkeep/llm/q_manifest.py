"""op13: a Merkle manifest of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.llm import merkle, store


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n = F.col("n_chars")
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    fields = lambda chars: [F.col("doc_id"), F.col("source"), F.col("lang"), chars, F.col("text")]
    with store.scratch(spark) as own:
        rows = merkle.manifest(docs, "doc_id", "lang", fields(n), fields(F.when(hit, n + 1).otherwise(n)))
        rows = rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), merkle.folded(F.col("tampered"), F.col("path")).alias("folded_root"))
        return own.keep(rows.withColumn("verified", F.col("folded_root") == F.col("root")), "manifest")


def _h(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR END"


def _leaf(chars: str) -> str:
    return "sha256(" + " || ".join(_h(x) for x in ("doc_id", "source", "lang", chars, "text")) + ")"


#: Runs of two become their parent; x is a list of digests.
_UP = "list_transform(range(1, len(x) + 1, 2), lambda i: sha256(x[i] || coalesce(x[i + 1], '')))"
#: CRC-32 of a decimal number.
_CRC = "xor(list_reduce(list_transform(range(1, length({x}) + 1), lambda i: ascii({x}[i])::BIGINT), lambda c, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda y, k: xor(y >> 1, 3988292384 * (y & 1)), xor(c, b)), 4294967295::BIGINT), 4294967295)"

QUERIES = {"op13_merkle_manifest": op13_merkle_manifest}
ORACLE = {
    "op13_merkle_manifest": f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('1' || lang, '0') AS k, {_leaf("n_chars")} AS leaf,
    {_leaf("CASE WHEN " + _CRC.format(x="(doc_id::VARCHAR)") + " % 7 = 0 THEN n_chars + 1 ELSE n_chars END")} AS bad FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
t(k, l, x) AS (SELECT k, 0, list(leaf ORDER BY i) FROM o GROUP BY k UNION ALL SELECT k, l + 1, {_UP} FROM t WHERE len(x) > 1),
s AS (SELECT k, max(l) AS h, (max_by(x, l))[1] AS subroot, row_number() OVER (ORDER BY k) - 1 AS j FROM t GROUP BY k),
u(l, x) AS (SELECT 0, list(subroot ORDER BY j) FROM s UNION ALL SELECT l + 1, {_UP} FROM u WHERE len(x) > 1),
g AS (SELECT (max_by(x, l))[1] AS root, max(l) AS top FROM u),
p AS (SELECT o.k, i, l, CASE WHEN (i >> l) % 2 = 1 THEN x[i >> l] ELSE '' END AS b, CASE WHEN (i >> l) % 2 = 0 THEN coalesce(x[(i >> l) + 2], '') ELSE '' END AS a
    FROM o JOIN t ON o.k = t.k AND len(x) > 1
  UNION ALL SELECT o.k, i, h + l, CASE WHEN (j >> l) % 2 = 1 THEN x[j >> l] ELSE '' END, CASE WHEN (j >> l) % 2 = 0 THEN coalesce(x[(j >> l) + 2], '') ELSE '' END
    FROM o JOIN s ON o.k = s.k JOIN u ON len(x) > 1),
q AS (SELECT k, i, sha256(string_agg(b || a, '' ORDER BY l)) AS proof, list({{'b': b, 'a': a}} ORDER BY l) AS path FROM p GROUP BY k, i),
f(k, i, l, h, path) AS (SELECT o.k, o.i, 1, bad, path FROM o LEFT JOIN q ON o.k = q.k AND o.i = q.i
  UNION ALL SELECT k, i, l + 1, sha256(path[l].b || h || path[l].a), path FROM f WHERE l <= len(path)),
z AS (SELECT k, i, max_by(h, l) AS folded FROM f GROUP BY k, i)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM o JOIN s ON o.k = s.k CROSS JOIN g LEFT JOIN q ON o.k = q.k AND o.i = q.i JOIN z ON o.k = z.k AND o.i = z.i"""
}
