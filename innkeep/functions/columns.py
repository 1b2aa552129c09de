"""Columns that are worked out once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settled(df: DataFrame, *names: str) -> DataFrame:
    """df with the named columns worked out once per row.

    They come out of a generator, so that later filters and functions refer to them; otherwise the optimizer may put their
    whole expressions in each place that names them, also inside functions over arrays.
    """
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, F.explode(F.array(F.struct(*names))).alias("x_")).select(*rest, *[F.col(f"x_.{n}") for n in names])
