"""Summaries of matching results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


_BUCKETS = 500_000


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def exact_medians(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """One row: the interpolated medians of columns (name of the result to column), 0.0 over nothing.

    Values of all columns are counted at once in buckets of 1 / 500,000 over [-1, 1] (the last ones are open), so that no task
    sees more than a million counts of a column; only the buckets that hold the middles are ordered.
    """
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("c"), F.col(c).cast("double").alias("x")) for k, c in enumerate(cols.values())]))
    values = df.select(each.alias("v")).select("v.*").where("x is not null")
    values = values.withColumn("b", F.floor((F.least(F.greatest("x", F.lit(-1.0)), F.lit(1.0)) + 1) * _BUCKETS).cast("int"))
    order = Window.partitionBy("c").orderBy("b")
    counts = values.groupBy("c", "b").agg(F.count("*").alias("n"))
    sums = counts.select("c", "b", "n", F.sum("n").over(order).alias("upto"), F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    middle = F.explode(F.array(F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)))
    wanted = sums.select("c", "b", "n", "upto", middle.alias("k")).where((F.col("k") < F.col("upto")) & (F.col("k") >= F.col("upto") - F.col("n"))).select("c", "b", (F.col("k") - F.col("upto") + F.col("n")).alias("r"))
    near = values.join(F.broadcast(wanted.select("c", "b").distinct()), ["c", "b"], "left_semi")  # at most two buckets of a column
    ranked = near.withColumn("r", F.row_number().over(Window.partitionBy("c", "b").orderBy("x")).cast("long") - 1)
    of = lambda k: _zero(F.sum(F.when(F.col("c") == k, F.col("x"))) / 2)
    return ranked.join(F.broadcast(wanted), ["c", "b", "r"]).agg(*[of(k).alias(name) for k, name in enumerate(cols)])


def exact_median(df: DataFrame, col: str, name: str) -> DataFrame:
    """One row: the interpolated median of a column, 0.0 over nothing."""
    return exact_medians(df, {name: col})


def similarity_stats(sim: str, prefix: str = "") -> list[Column]:
    """mean, min and max of a column; 0.0 over nothing."""
    return [_zero(f(sim)).alias(f"{prefix}{n}") for n, f in (("mean", F.avg), ("min", F.min), ("max", F.max))]


def match_summary(assigned: DataFrame, ad_unmatched: DataFrame, block: str) -> DataFrame:
    """One row: pairs, matches, unmatched rooms per side and statistics of the similarities, with exact medians."""
    got = F.col("ad_ord").isNotNull()
    main = assigned.agg(F.countDistinct(block).alias("pairs"), F.count_if(got).alias("matches"), F.count_if(~got).alias("unmatched_hb"), *similarity_stats("sim"), *similarity_stats("adjusted", "adjusted_"))
    out = main.join(F.broadcast(ad_unmatched.agg(F.count("*").alias("unmatched_ad"))))
    return out.join(F.broadcast(exact_medians(assigned, {"median": "sim", "adjusted_median": "adjusted"})))


def flag_counts(matches: DataFrame) -> DataFrame:
    """Matches with any failed check, and those whose occupancies differ. Needs the struct flags."""
    f = F.col("flags")
    failed = ~(f["bedroom_match"] & f["room_type_match"] & f["occupancy_match"])
    return matches.agg(F.count_if(failed).alias("with_warnings"), F.count_if(~f["occupancy_match"]).alias("occupancy_warnings"))


def hotel_totals(rooms: DataFrame, hotel: str = "hotel_code") -> DataFrame:
    return rooms.groupBy(hotel).agg(F.count("*").alias("total_rooms"))


def normalization_metadata(hotels: DataFrame) -> DataFrame:
    """total_count, total_rooms and total_rooms_with_occupancy of normalized hotels (rooms: array of structs with occupancy)."""
    with_occ = F.size(F.filter("rooms", lambda r: r["occupancy"].isNotNull()))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return hotels.agg(F.count("*").alias("total_count"), zero(F.size("rooms")).alias("total_rooms"), zero(with_occ).alias("total_rooms_with_occupancy"))


def hotel_confidence(matches: DataFrame, hotel: str, matched: str) -> DataFrame:
    """Share of a hotel's rooms that are matched; 0.0 without rooms."""
    return matches.groupBy(hotel).agg(F.coalesce(F.avg(F.col(matched).cast("double")), F.lit(0.0)).alias("confidence"))


def char_batches(texts: DataFrame, text_col: str, batch: int = 30) -> DataFrame:
    """chars and mean length per batch of ``batch`` texts in the order of ord."""
    return texts.groupBy(F.floor(F.col("ord") / batch).alias("batch")).agg(F.sum(F.length(text_col)).alias("chars"), F.avg(F.length(text_col)).alias("mean_chars"))


def samples(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n rows in the given order, for a look at results."""
    return df.orderBy(*order).limit(n)
