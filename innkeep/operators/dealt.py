"""Equal-key joins whose result is far larger than their inputs: the pairs of a key are dealt over tasks.

Both sides of a key meet in cells of a share of each side, so that few or hot keys, or one file, leave no task with much of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a key and side in one cell, about; more in tables with over MAX_HOT times as many.
CELL_ROWS = 2048
MAX_HOT = 100_000


def dealt_join(left: DataFrame, right: DataFrame, on: tuple[str, str], by: tuple[Column, Column], condition: Column | None = None, null_safe: bool = False, sizes: tuple[Column, Column] | None = None, unfold: str | None = None, share: int = 1) -> DataFrame:
    """left joined with right where the columns ``on`` (of left, of right) are equal and ``condition`` holds.

    by: what a side's rows are dealt by (hashed). Names of both sides must differ. sizes: where a side's rows are lists, how many rows
    each stands for. unfold: a list of left that is taken apart where it meets right, so that lists are shuffled. share: cells are smaller by so much on both sides.
    """
    a, b = on
    spark = left.sparkSession
    n, m = sizes or (F.lit(1), F.lit(1))
    one = lambda df, c, n, m: df.select(F.col(c).alias("k_"), n.cast("long").alias("n_"), m.cast("long").alias("m_"))
    counts = one(left, a, n, F.lit(0)).unionByName(one(right, b, F.lit(0), m)).groupBy("k_").agg(F.sum("n_").alias("n_"), F.sum("m_").alias("m_")).where("n_ > 0 and m_ > 0")
    total, largest = counts.agg(F.coalesce(F.sum(F.col("n_") + F.col("m_")), F.lit(0)), F.coalesce(F.max(F.greatest("n_", "m_")), F.lit(0))).first()
    most = max(CELL_ROWS // share, total // MAX_HOT)
    parts = lambda n: F.ceil(F.col(n) / most).cast("int")
    share = lambda c, n: F.pmod(F.xxhash64(c), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    same = lambda x, y: F.col(x).eqNullSafe(F.col(y)) if null_safe else F.col(x) == F.col(y)
    sides = []
    for df, c, first in ((left, a, True), (right, b, False)):
        row, tile = ("l_row", "l_tile") if first else ("r_row", "r_tile")
        if largest > most:
            hot = F.broadcast(counts.where(F.greatest("n_", "m_") > most).select("k_", parts("n_").alias("p_"), parts("m_").alias("t_")))  # at most 2 x MAX_HOT keys
            p, t = F.coalesce("p_", F.lit(1)), F.coalesce("t_", F.lit(1))
            df = df.join(hot, same(c, "k_"), "left").withColumn(row, share(by[0], p) if first else every(p)).withColumn(tile, every(t) if first else share(by[1], t)).drop("k_", "p_", "t_")
        else:
            df = df.withColumn(row, F.lit(0)).withColumn(tile, F.lit(0))
        # a number, so that cells aren't put together again by their bytes: these tell nothing of the pairs
        sides.append(df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), c, row, tile))
    if unfold:
        sides[0] = sides[0].withColumn(unfold, F.explode(unfold))
    if sizes:
        sides[1] = sides[1].hint("merge")  # never broadcast: Spark's estimates count a list as one member
    met = same(a, b) & (F.col("l_row") == F.col("r_row")) & (F.col("l_tile") == F.col("r_tile"))
    return sides[0].join(sides[1], met if condition is None else met & condition).drop("l_row", "l_tile", "r_row", "r_tile")
