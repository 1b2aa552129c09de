"""op11: bytes of documents that repeat strings of documents with smaller ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.llm import store, suffixes

LENGTH = 50


def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with store.scratch(spark) as own:
        rows = suffixes.without_repeats(docs, "doc_id", "text", LENGTH)
        size = F.octet_length("kept").cast("long")
        return own.keep(rows.select(F.col("id").alias("doc_id"), "n_bytes", (F.col("n_bytes") - size).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")), "without-repeats")


QUERIES = {"op11_suffix_array_dedup": op11_suffix_array_dedup}
ORACLE = {
    "op11_suffix_array_dedup": f"""
WITH d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS MATERIALIZED (SELECT doc_id, r, q, n, substr(h, 2 * q + 1, 2 * {512 + LENGTH - 1}) AS h FROM (SELECT doc_id, r, h, length(h) // 2 AS n, unnest(range(0, length(h) // 2, 512)) AS q FROM d)),
w AS MATERIALIZED (SELECT doc_id, r, q + o AS o, substr(h, 2 * o + 1, {2 * LENGTH}) AS s FROM (SELECT doc_id, r, q, h, unnest(range(0, least(512, n - q - {LENGTH - 1}))) AS o FROM p)),
m AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
v AS (SELECT r, o FROM w JOIN m ON w.s = m.s WHERE coalesce(doc_id > least, least IS NOT NULL)),
b AS (SELECT r, q + o AS o, substr(h, 2 * o + 1, 2) AS x FROM (SELECT r, q, h, unnest(range(0, least(512, n - q))) AS o FROM p)),
c AS (SELECT b.r, b.o, x, coalesce(b.o - max(v.o) OVER (PARTITION BY b.r ORDER BY b.o) < {LENGTH}, FALSE) AS gone FROM b LEFT JOIN v ON v.r = b.r AND v.o = b.o),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY o), FALSE) AS first FROM c),
k AS (SELECT r, count(*) AS n, count(*) FILTER (gone) AS g, count(*) FILTER (first) AS f, coalesce(string_agg(x, '' ORDER BY o) FILTER (NOT gone), '') AS t FROM e GROUP BY r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_bytes, coalesce(g, 0)::BIGINT AS n_removed, coalesce(f, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(t, ''))) AS kept_sha256
FROM d LEFT JOIN k ON d.r = k.r"""
}
