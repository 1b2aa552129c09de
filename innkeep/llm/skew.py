"""Equal-key joins that deal the rows of hot keys over several tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a key that stay in one task; more in tables so large that over MAX_HOT keys would exceed it.
KEY_ROWS = 1024
MAX_HOT = 100_000


def spread_join(left: DataFrame, right: DataFrame, on: list[str], spread_by: Column, counts: DataFrame | None = None, how: str = "inner") -> DataFrame:
    """left joined (inner or left) with right on equal non-null keys. Hot keys are those with many rows of left: each of their rows goes to
    one of several tasks by ``spread_by`` (a long), and rows of right with these keys are repeated for each.

    counts: the keys and n, the rows of left that hold them, if they are known; at most MAX_HOT keys are broadcast.
    """
    counts = left.groupBy(*on).agg(F.count("*").alias("n")) if counts is None else counts
    most = max(KEY_ROWS, (counts.agg(F.sum("n")).first()[0] or 0) // MAX_HOT)
    hot = counts.where(F.col("n") > most).select(*on, F.ceil(F.col("n") / most).cast("int").alias("_parts"))
    if hot.isEmpty():
        return left.join(right, on, how)
    hot = F.broadcast(hot)
    parts = F.coalesce("_parts", F.lit(1))
    dealt = left.join(hot, on, "left").withColumn("_part", F.pmod(spread_by, parts).cast("int")).drop("_parts")
    copies = right.join(hot, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return dealt.join(copies, [*on, "_part"], how).drop("_part")
