"""op3: documents mixed to weights by source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.llm import mixing, store


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with store.scratch(spark) as own:
        rows, goal = mixing.plan(docs, "doc_id", "source", mixing.word_count(F.col("text")), else_col="text")
        taken = rows.join(mixing._small(goal), "k").select(
            F.col("id").alias("doc_id"), "size", "source_size", "target", (mixing.copies(F.col("h")) * F.col("size")).alias("taken"), F.col("rate")
        )
        return own.keep(taken, "mixed")


_DRAWN = [f"(('0x' || substr(h, {1 + 8 * i}, 8))::UBIGINT::DOUBLE / 4294967296.0)" for i in range(8)]
_SUMS = ", ".join(f"sum(CASE WHEN {d} < rate - floor(rate) THEN size ELSE 0 END) AS d{i}" for i, d in enumerate(_DRAWN))
_OFF = ", ".join(f"{{'off': abs(floor(rate) * source_size + d{i} - target), 'draw': {i}}}" for i in range(8))
_PICK = " ".join(f"WHEN {i} THEN {d}" for i, d in enumerate(_DRAWN))

QUERIES = {"op3_mixing": op3_mixing}
ORACLE = {
    "op3_mixing": f"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    sha256(coalesce(doc_id::VARCHAR, text, '')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
    2.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM w)
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / ((SELECT sum(weight) FROM w)
      - coalesce(sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM w),
t AS (SELECT source, source_size, coalesce(least(cap, (SELECT max(level) FROM l WHERE level * weight <= cap) * weight), cap) AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t),
g AS (SELECT r.source, any_value(rate) AS rate, any_value(source_size) AS source_size, any_value(target) AS target, {_SUMS}
    FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source GROUP BY r.source),
p AS (SELECT source, source_size, target, rate, list_min([{_OFF}]).draw AS draw FROM g)
SELECT doc_id, size, source_size, target,
  ((floor(rate) + CASE WHEN CASE draw {_PICK} END < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken, rate
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source"""
}
