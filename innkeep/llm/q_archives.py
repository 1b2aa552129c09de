"""op1: pages to WARC archives and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.llm import store, warc


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    with store.scratch(spark) as own:
        path = store.new_path(spark, "warc")
        warc.write_archive(warc.plan_records(pages, "page_id", "url", "html", min_dedup_bytes=0), path)
        read = warc.read_archive(spark, path).select(
            "record_id",
            "record_type",
            "row_id",
            F.col("refers_to"),
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.when(F.col("payload").isNotNull(), warc.sha1_base32(F.col("payload"))).alias("payload_digest"),
        )
        read = store.cut(read, "warc-read")
        return own.keep(warc.resolve_revisits(read).select(F.col("row_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"), "warc-rows")


_DIGITS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(sha1(h), {1 + 10 * i}, 10))::UBIGINT >> {35 - 5 * j}) & 31)::BIGINT + 1, 1)"
    for i in range(4)
    for j in range(8)
)

QUERIES = {"op1_warc": op1_warc}
ORACLE = {
    "op1_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, {_DIGITS} AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM g"""
}
