"""Mixing sources to target weights.

Words are summed per source, targets follow from weights and a budget, and a source's repetition rate is target / size.
A document is emitted floor(rate) times, plus one copy if a hash of its id (of ``else_col``, where it has none) falls below the rate's fraction. The hash
gives eight independent draws; each source uses the draw whose words come nearest to its target, so a few long documents
don't carry a small source far off. Everything is a function of the table: reruns agree.

Targets: sources share ``budget`` times all words by weight; none gets more than ``most`` times its own size, and what
is over is shared again by weight. In order of cap / weight, the first source that its share doesn't fill sets the level
for all after it, so running sums over the sources give the targets at once.

Only one number per source is gathered; the table of sources is broadcast if it has at most BROADCAST_SOURCES rows and
joined by a shuffle otherwise. Nothing groups rows of a source together but sums, so hot sources don't matter.

Defined results: null text has size 0; the null source is a source, last in order; sources without words have target 0;
documents of size 0 are emitted as the rates say, and take no words; repeated rows get equal decisions; an empty table
gives no rows; other columns are kept (``mix`` replaces its own column names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innkeep.llm import store

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST = 2.0
DRAWS = 8
BROADCAST_SOURCES = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n"))


def targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """From columns k, source and size: a row per source with source_size, weight and target."""
    per = sizes.groupBy("k").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")  # one row per source
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", w).withColumn("cap", most * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = budget * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    per = per.withColumn("level", level)
    per = per.withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(whole))
    return per.select("k", "source_size", "weight", F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap")).alias("target"))


def _small(sources: DataFrame) -> DataFrame:
    return F.broadcast(sources) if sources.count() <= BROADCAST_SOURCES else sources


def _draw(h: Column, i) -> Column:
    """Draw i of DRAWS, in [0, 1), from a SHA-256 in hex digits."""
    return F.conv(F.substr(h, F.lit(1) + F.lit(8) * i, F.lit(8)), 16, 10).cast("double") / float(1 << 32)


def _hash(id_col: str, else_col: str | None) -> Column:
    """SHA-256 in hex digits of the id; of else_col where it is null."""
    of = [F.col(c).cast("string") for c in (id_col, else_col) if c is not None]
    return F.sha2(F.coalesce(*of, F.lit("")).cast("binary"), 256)


def plan(
    docs: DataFrame, id_col: str, source_col: str, size: Column, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST, else_col: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(a row per document: id, source, k, size, h), written once; and a row per source: k, source_size, target, rate, draw."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        _key(source_col).alias("k"),
        size.alias("size"),
        _hash(id_col, else_col).alias("h"),
    )
    rows = store.cut(rows, "mix-sizes")
    goal = targets(rows, weights, budget, most).withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    goal = store.cut(goal, "mix-targets")
    drawn = rows.join(_small(goal.select("k", "rate")), "k").groupBy("k").agg(
        *[F.sum(F.when(_draw(F.col("h"), F.lit(i)) < F.col("rate") - F.floor("rate"), F.col("size")).otherwise(0)).alias(f"d{i}") for i in range(DRAWS)]
    )
    off = [F.struct(F.abs(F.floor("rate") * F.col("source_size") + F.col(f"d{i}") - F.col("target")).alias("off"), F.lit(i).alias("draw")) for i in range(DRAWS)]
    goal = goal.join(drawn, "k").withColumn("draw", F.least(*off)["draw"]).select("k", "source_size", "target", "rate", "draw")
    return rows, store.cut(goal, "mix-rates")


def copies(h: Column) -> Column:
    return (F.floor("rate") + F.when(_draw(h, F.col("draw")) < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("int")


def mix(docs: DataFrame, id_col: str, source_col: str, size: Column, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST, else_col: str | None = None) -> DataFrame:
    """The mixed documents: every row as often as its source's rate says, with all its columns."""
    _, goal = plan(docs, id_col, source_col, size, weights, budget, most, else_col)
    goal = _small(goal.select(F.col("k").alias("_k"), F.col("rate"), F.col("draw")))
    h = _hash("d." + id_col, None if else_col is None else "d." + else_col)
    joined = docs.alias("d").join(goal, F.coalesce(F.concat(F.lit("s"), F.col("d." + source_col).cast("string")), F.lit("n")) == goal["_k"])
    n = F.floor(goal["rate"]) + F.when(_draw(h, goal["draw"]) < goal["rate"] - F.floor(goal["rate"]), 1).otherwise(0)
    many = joined.select(F.struct("d.*").alias("d"), F.explode(F.array_repeat(F.lit(0), n.cast("int"))).alias("_i"))
    return many.select("d.*")
