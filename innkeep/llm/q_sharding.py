"""op6: documents in 24 shards of nearly equal bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.llm import sharding


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return sharding.shard_by_bytes(docs, "doc_id", "text", 24).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


QUERIES = {"op6_sharding": op6_sharding}
ORACLE: dict[str, str] = {}
