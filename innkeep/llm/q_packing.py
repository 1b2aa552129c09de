"""op5: documents packed into sequences of 2048 tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from innkeep.llm import packing, store


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with store.scratch(spark) as own:
        return own.keep(packing.pack(store.cut(packing.tokenize(docs, "doc_id", "text"), "pieces")), "packed")


QUERIES = {"op5_packing": op5_packing}
ORACLE: dict[str, str] = {}
