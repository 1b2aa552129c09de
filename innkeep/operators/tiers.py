"""Post-filter of fuzzy mappings: confidence tiers, first-wins dedup, and the statistics after it.

``strict`` keeps low-tier rows away whose source already has a high-tier match; by default such rows stay, as in the
result that this must equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.functions.scoring import half_even

HIGH = ["exact", "high_confidence"]
LOW = ["medium_confidence", "low_confidence", "none"]


def first_by(df: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    """The row with the smallest ``order`` of each key."""
    return df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min_by(F.struct("*"), order).alias("r")).select("r.*")


def last_by(df: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    """The row with the largest ``order`` of each key."""
    return df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max_by(F.struct("*"), order).alias("r")).select("r.*")


def tiered(mappings: DataFrame, strict: bool = False) -> DataFrame:
    """ord, tier, code, description, target_code, target_name, match_score, match_type, confidence; best score first by (match_score, tier, ord)."""
    m = mappings.where(F.col("match_type").isin(HIGH + LOW)).withColumn("code", F.coalesce("code", F.lit(""))).withColumn("target_code", F.coalesce("target_code", F.lit("")))
    high = first_by(m.where(F.col("match_type").isin(HIGH) & (F.col("target_code") != "")), ["code", "target_code"])
    low = first_by(m.where(F.col("match_type").isin(LOW)), ["code"])
    if strict:
        low = low.join(high.select("code"), "code", "left_anti")
    cols = ["ord", "code", F.coalesce("description", F.lit("")).alias("description")]
    score = ["match_score", "match_type", "confidence"]
    one = high.select(F.lit("high").alias("tier"), *cols, "target_code", F.coalesce("target_name", F.lit("")).alias("target_name"), *score)
    two = low.select(F.lit("low").alias("tier"), *cols, F.lit(None).cast("string").alias("target_code"), F.lit(None).cast("string").alias("target_name"), *score)
    return one.unionByName(two)


def tier_statistics(mappings: DataFrame, unique: DataFrame) -> DataFrame:
    """One row: counts before and after the post-filter."""
    n = lambda *kinds: F.count_if(F.col("match_type").isin(*kinds))
    before = mappings.agg(F.count("*").alias("original_count"), n(*HIGH, *LOW).alias("filtered_count"))
    total, mapped = F.count("*"), F.count_if(F.col("tier") == "high")
    after = unique.agg(
        total.alias("total"), mapped.alias("mapped"), (total - mapped).alias("unmapped"),
        n("exact").alias("exact"), n("high_confidence").alias("high"), n("medium_confidence").alias("medium"), n("low_confidence").alias("low"), n("none").alias("none"),
        half_even(F.coalesce(F.avg("match_score"), F.lit(0.0))).alias("average_score"),
        F.when(total > 0, F.concat(F.format_string("%.2f", mapped / total * 100), F.lit("%"))).otherwise("0%").alias("mapping_rate"),
    )
    return before.join(F.broadcast(after)).withColumn("duplicates_removed", F.col("filtered_count") - F.col("total"))


def simplified(mappings: DataFrame) -> DataFrame:
    """Code and name of both sides, score and type; a missing target is empty."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return mappings.select(text("code"), text("name"), text("target_code"), text("target_name"), "match_score", "match_type")
