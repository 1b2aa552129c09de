"""Gapless places of rows in an order, without a window over all rows.

Rows are dealt by ranges of the order and sorted where they lie, and written once with their partition and their place in
it, so that both are data from then on. A partition's rows of a group begin after those that earlier partitions hold: only
these counts, a row per partition and group in it, are summed up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innkeep.sources import shared

#: Offsets that are broadcast; more of them are joined.
BROADCAST_ROWS = 200_000


def with_places(df: DataFrame, order: list[Column], group: list[str] | None = None, name: str = "place") -> DataFrame:
    """df with ``name``, the place of each row (from 0, long) in its group, or among all rows.

    ``order`` should tell rows apart: rows that are equal in it lie in one task, in any order. Nulls are first unless it says
    otherwise; null is a group like any other. Columns of any name stay; an equal name is replaced.
    """
    group = group or []
    keep = [c for c in df.columns if c != name]
    mark = "_" * (1 + max([len(name), *map(len, df.columns)]))  # longer than any column's name
    part, at, first, before = (mark + x for x in ("part", "at", "first", "before"))
    by = [*[F.col(g).asc_nulls_first() for g in group], *order]
    laid = df.repartitionByRange(*by).sortWithinPartitions(*by).select(*keep, F.spark_partition_id().alias(part), F.monotonically_increasing_id().alias(at))
    laid = shared.cut(laid, "places")
    counts = laid.groupBy(*group, part).agg(F.min(at).alias(first), F.count("*").alias("n_"))
    ahead = Window.partitionBy(*(group or [F.lit(0)])).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = shared.cut(counts.select(*[F.col(g).alias(f"{mark}{k}") for k, g in enumerate(group)], F.col(part).alias(f"{mark}p"), first, F.coalesce(F.sum("n_").over(ahead), F.lit(0)).alias(before)), "offsets")
    if starts.count() <= BROADCAST_ROWS:
        starts = F.broadcast(starts)
    on = F.col(part) == F.col(f"{mark}p")
    for k, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"{mark}{k}"))
    return laid.join(starts, on).select(*keep, (F.col(at) - F.col(first) + F.col(before)).alias(name))
