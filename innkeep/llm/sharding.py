"""Sharding by sampled splitters, with DataFrame functions only.

Rows with equal texts are a group, and groups are placed whole. Groups are ordered by a hash of their text, a sample of
them weighted by size gives splitters of about equal bytes, and groups are range-partitioned by them. Exact sums per range
then place every group in the order of all bytes: its shard is the one that holds its middle byte. A range that still
exceeds twice its share is subdivided by splitters from a sample of its own groups.

Sizes are levelled in three steps: groups above SINGLE_SHARE of a shard come first, the largest to the emptiest shard;
groups above GROUP_SHARE go by splitters into the room that leaves; and so do the others, which fill each shard up to one
level. Only a group above a whole shard's share is cut: its rows are groups of their own, told apart by a hash of the id.
What is gathered are the splitters, sums of ranges and shards, and at most shards / GROUP_SHARE groups above that share.

Defined results: a null text has size 8 and a null checksum is 0 (of no bytes); null and empty texts are one group; null
ids are allowed; ties of hash and id go by no fixed order (such rows are equal); an empty table gives no rows; other columns
are ignored. Texts whose 64-bit hashes collide are one group.
"""

from __future__ import annotations

import heapq
import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innkeep.llm import skew, store

GROUP_SHARE = 0.01
SINGLE_SHARE = 0.05
SAMPLE_PER_RANGE = 48
ROWS_PER_RANGE = 50_000
MAX_RANGES = 2048


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, size, text_crc32, and the keys a (of the text) and b (of the row)."""
    text = F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit(b""))
    return docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("a"),
        F.xxhash64(F.lit(11), id_col).alias("b"),
    )


def _after(pairs: Column) -> Column:
    """How many of the pairs (an array of struct<a, b>) are at or below the row's key."""
    return F.size(F.filter(pairs, lambda p: (p["a"] < F.col("a")) | ((p["a"] == F.col("a")) & (p["b"] <= F.col("b")))))


def _pairs(spark, cuts: list[tuple[int, int]]) -> Column:
    if not cuts:
        return F.expr("cast(array() as array<struct<a:bigint,b:bigint>>)")
    one = lambda k: F.from_json(F.lit("[" + ",".join(str(c[k]) for c in cuts) + "]"), "array<bigint>")
    return F.arrays_zip(one(0).alias("a"), one(1).alias("b"))


def _splitters(groups: DataFrame, total: int, ranges: int, seed: int) -> list[tuple[int, int]]:
    """Quantiles of a sample in which a group's chance is its share of the bytes; about SAMPLE_PER_RANGE keys a range."""
    if ranges < 2:
        return []
    chance = F.col("size") * (SAMPLE_PER_RANGE * ranges / max(1, total))
    u = F.pmod(F.xxhash64(F.lit(seed), "a", "b"), F.lit(1 << 40)) / float(1 << 40)
    drawn = groups.where(u < chance).select("a", "b", F.greatest(F.lit(1.0), chance).alias("w"))
    order = Window.orderBy("a", "b")  # over the bounded sample only
    at = F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, 0))
    whole = F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    cell = drawn.select("a", "b", F.floor(at / whole * ranges).cast("int").alias("q"))
    firsts = cell.groupBy("q").agg(F.min(F.struct("a", "b")).alias("k")).where("q between 1 and %d" % (ranges - 1))
    return sorted({(r["k"]["a"], r["k"]["b"]) for r in firsts.collect()})


def _in_range(rows: DataFrame, cuts: list[tuple[int, int]]) -> DataFrame:
    """Adds r, the range of each row: first among sqrt(n) coarse cuts, then among those of the coarse range."""
    step = max(1, int(len(cuts) ** 0.5))
    coarse = [cuts[i] for i in range(step - 1, len(cuts), step)]
    fine = [cuts[i * step : i * step + step - 1] for i in range(len(coarse) + 1)]
    rows = rows.withColumn("c", _after(_pairs(rows.sparkSession, coarse)))
    inside = F.from_json(F.lit("[" + ",".join("[" + ",".join(f'{{"a":{a},"b":{b}}}' for a, b in f) + "]" for f in fine) + "]"), "array<array<struct<a:bigint,b:bigint>>>")
    return rows.withColumn("r", F.col("c") * step + _after(F.element_at(inside, F.col("c") + 1))).drop("c")


def _spread(items: list[tuple[int, int, int]], shards: int) -> tuple[list[tuple[int, int, int]], list[int]]:
    """(a, b, shard) of each item (a, b, size), the largest to the emptiest shard; and the bytes that shards then hold."""
    emptiest = [(0, s) for s in range(shards)]
    held, out = [0] * shards, []
    for a, b, size in sorted(items, key=lambda r: (-r[2], r[0], r[1])):
        _, s = heapq.heappop(emptiest)
        held[s] += size
        out.append((a, b, s))
        heapq.heappush(emptiest, (held[s], s))
    return out, held


def _room(held: list[int], rest: int) -> list[float]:
    """What each shard takes of the rest, so that all but those above it reach one level."""
    order, below, level = sorted(held), 0, 0.0
    for n, h in enumerate(order, 1):
        below += h
        level = (rest + below) / n
        if n == len(order) or level <= order[n]:
            break
    return [max(0.0, level - h) for h in held]


def _place(groups: DataFrame, held: list[int], first_range: int) -> DataFrame:
    """a, b, size, r, shard of groups (a, b, size, n), by splitters, into the room beside what shards hold."""
    whole = groups.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("n")).first()
    total, n, shards = whole["bytes"], whole["n"], len(held)
    room = _room(held, total)
    ranges = max(1, min(MAX_RANGES, max(4 * shards if n > 4 * shards else 1, n // ROWS_PER_RANGE)))
    cuts = _splitters(groups, total, ranges, 1)
    for again in range(2, 5):
        ranged = _in_range(groups, cuts)
        sums = {r["r"]: r["s"] for r in ranged.groupBy("r").agg(F.sum("size").alias("s")).collect()}
        over = [r for r, s in sums.items() if s > 2 * total / ranges]
        if not over or again == 4:
            break
        more = _splitters(ranged.where(F.col("r").isin(over)), sum(sums[r] for r in over), 2 * -(-sum(sums[r] for r in over) * ranges // max(1, total)), again)
        if set(more) <= set(cuts):
            break
        cuts = sorted({*cuts, *more})
    base, at = {}, 0
    for r in sorted(sums):
        base[r] = at
        at += sums[r]
    start = F.element_at(F.from_json(F.lit("[" + ",".join(str(base.get(r, 0)) for r in range(len(cuts) + 1)) + "]"), "array<bigint>"), F.col("r") + 1)
    upto = F.sum("size").over(Window.partitionBy("r").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends = F.from_json(F.lit("[" + ",".join(repr(x) for x in itertools.accumulate(room[:-1])) + "]"), "array<double>")
    placed = ranged.withColumn("middle", start + upto - F.col("size") / 2.0).withColumn("shard", F.size(F.filter(ends, lambda x: x <= F.col("middle"))))
    return placed.select("a", "b", "size", "n", (F.col("r") + first_range).alias("r"), "shard")


def _one_of(keys: list[int]) -> Column:
    return F.array_contains(F.from_json(F.lit("[" + ",".join(map(str, keys)) + "]"), "array<bigint>"), F.col("a"))


def shard_by_bytes(docs: DataFrame, id_col: str, text_col: str, shards: int) -> DataFrame:
    """id, size, text_crc32, shard (0 to shards - 1) and slot (0, 1, .. in each shard); shards hold nearly equal bytes."""
    spark = docs.sparkSession
    with store.scratch(spark) as own:
        rows = store.cut(keyed(docs, id_col, text_col), "shard-keys")
        groups = store.cut(rows.groupBy("a").agg(F.sum("size").alias("size"), F.count("*").alias("n")), "shard-groups")
        share = (groups.agg(F.sum("size")).first()[0] or 0) / shards
        large = [(r["a"], 0, r["size"]) for r in groups.where(F.col("size") > GROUP_SHARE * share).collect()]  # at most shards / GROUP_SHARE
        torn = sorted(a for a, _, size in large if size > share)
        groups = groups.withColumn("b", F.lit(0).cast("long"))
        rows = rows.withColumn("b", F.when(_one_of(torn), F.col("b")).otherwise(F.lit(0).cast("long")))
        if torn:
            single = store.cut(rows.where(_one_of(torn)).groupBy("a", "b").agg(F.sum("size").alias("size"), F.count("*").alias("n")), "shard-torn")
            large = [x for x in large if x[2] <= share] + [(r["a"], r["b"], r["size"]) for r in single.where(F.col("size") > GROUP_SHARE * share).collect()]
            groups = groups.where(~_one_of(torn)).unionByName(single)
        alone, held = _spread([x for x in large if x[2] > SINGLE_SHARE * share], shards)
        where = {(a, b): s for a, b, s in alone}
        listed = "[" + ",".join(f'{{"a":{a},"b":{b},"step":{1 if (a, b) in where else 2},"at":{where.get((a, b), 0)}}}' for a, b, _ in large) + "]"
        table = F.broadcast(spark.range(1).select(F.inline(F.from_json(F.lit(listed), "array<struct<a:bigint,b:bigint,step:int,at:int>>"))))
        groups = store.cut(groups.join(table, ["a", "b"], "left"), "shard-steps")
        placed = [groups.where("step = 1").select("a", "b", "size", "n", F.lit(-1).alias("r"), F.col("at").alias("shard"))]
        for i, step in enumerate(("step = 2", "step is null")):
            some = groups.where(step).select("a", "b", "size", "n")
            if not some.isEmpty():
                one = store.cut(_place(some, held, i * 4 * MAX_RANGES), "shard-places")
                for r in one.groupBy("shard").agg(F.sum("size").alias("s")).collect():
                    held[r["shard"]] += r["s"]
                placed.append(one)
        places = placed[0]
        for one in placed[1:]:
            places = places.unionByName(one)
        # groups of very many rows are numbered in parts
        places = places.withColumn("parts", F.ceil(F.col("n") / ROWS_PER_RANGE))
        found = skew.spread_join(rows, places.select("a", "b", "r", "shard", "parts"), ["a", "b"], F.xxhash64(F.lit(5), "id"), places.select("a", "b", "n"))
        found = found.withColumn("part", F.when(F.col("parts") > 1, F.pmod(F.xxhash64(F.lit(6), "id"), "parts")).otherwise(F.lit(0)).cast("int"))
        found = found.withColumn("i", F.row_number().over(Window.partitionBy("r", "shard", "part").orderBy("a", "b", "id")) - 1)
        found = store.cut(found.select("id", "size", "text_crc32", "r", "shard", "part", "i"), "shard-rows")
        cells = found.groupBy("r", "shard", "part").agg(F.count("*").alias("n"))  # bounded by ranges, shards and rows / ROWS_PER_RANGE
        cells = cells.select("r", "shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("r", "part")) - F.col("n")).alias("first"))
        out = found.join(cells, ["r", "shard", "part"]).select("id", "size", "text_crc32", "shard", (F.col("first") + F.col("i")).alias("slot"))
        return own.keep(out, "shards")
