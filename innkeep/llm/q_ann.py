"""op4: approximate nearest neighbours among the embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.llm import nndescent


def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nndescent.nearest(vectors, "vec_id", "embedding", F.col("vec_id") % 100 == 0, 10)


QUERIES = {"op4_nn_descent": op4_nn_descent}
ORACLE: dict[str, str] = {}
