"""op2: the language of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.llm import langid


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))), "text", "lang", "doc_id")
    found = langid.identify(docs.select("doc_id", "text"), model, "text")
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


QUERIES = {"op2_language_id": op2_language_id}
ORACLE: dict[str, str] = {}
