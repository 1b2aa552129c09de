"""Hotel pairs, room candidates and greedy one-to-one assignment.

Rooms carry their place in the input (an ordinal): assignment goes in that order, and ties go to the smaller one. Each room
of the first side is a row with its candidates that reach the threshold, best first.

Assignment is deferred acceptance: rooms propose to the best candidate that has not refused them, a candidate keeps the room with the
smallest ordinal and refuses the others, until nobody is refused. As all candidates prefer smaller ordinals, this gives
what taking the rooms one by one would give, in any order of proposals. So the rooms of a block that is not large propose
in one pass, in their order, and are done. Those of a large block are dealt by ordinals into buckets that propose at the
same time, each in one pass that knows what earlier buckets hold so far; the smallest ordinals win, and buckets that lost
rooms propose again. After round k the first k buckets are final, so there are as many rounds as buckets at most. A pass
keeps only the places taken in its block.

Lists of all candidates would be quadratic in a block. Rooms of vectors choose in one pass where they meet, block by block; in
large blocks they propose from short lists, in phases.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innkeep.functions import scoring
from innkeep.functions.columns import settled
from innkeep.operators import similar
from innkeep.operators.dealt import dealt_join
from innkeep.operators.positions import with_places
from innkeep.sources import shared

ST_THRESHOLD = 0.75
GM_THRESHOLD = 0.90
#: Rooms of a bucket; blocks with more rooms are large.
BUCKET_ROOMS = 4096
#: Rooms of a side up to which a block chooses in one pass, some rooms against all places at a time.
ONE_PASS_ROOMS = 40_960
#: Candidates that a room of a large block proposes to in a phase.
LIST_ROOMS = 64


def hotel_pairs(hb: DataFrame, ad: DataFrame, key: str = "place_id", null_safe: bool = False) -> DataFrame:
    """Inner equi-join on the key: every hb hotel with every ad hotel of the place. Other columns get the prefixes hb_ and ad_.

    The pairs of a place are quadratic in it, so they are dealt over tasks.
    """
    left = hb.select(F.col(key).alias("hb_key"), *[F.col(c).alias(f"hb_{c}") for c in hb.columns if c != key])
    right = ad.select(F.col(key).alias("ad_key"), *[F.col(c).alias(f"ad_{c}") for c in ad.columns if c != key])
    by = tuple(F.struct(*df.columns) for df in (left, right))
    return dealt_join(left, right, ("hb_key", "ad_key"), by, null_safe=null_safe).drop("ad_key").withColumnRenamed("hb_key", key)


def unmatched_hotels(hotels: DataFrame, others: DataFrame, key: str = "place_id") -> DataFrame:
    """Hotels whose key the other side lacks."""
    return hotels.join(others.select(key), key, "left_anti")


def room_pairs(hb: DataFrame, ad: DataFrame, block: str, vec: str, keep: tuple[str, ...] = (), threshold: float | None = None) -> DataFrame:
    """block, hb_ord, ad_ord, sim and the columns ``keep`` of both sides, for the pairs of a block that reach the threshold.

    Without a threshold, all pairs that have a similarity.
    """
    met = similar.candidates(hb, ad, block, vec, threshold, keep)
    each = met.select(block, F.col("ord").alias("hb_ord"), *[F.col(c).alias(f"hb_{c}") for c in keep], F.explode("met").alias("m"))
    return each.select(block, "hb_ord", F.col("m.ord").alias("ad_ord"), "m.sim", *[f"hb_{c}" for c in keep], *[F.col(f"m.{c}").alias(f"ad_{c}") for c in keep])


def _ranked(met: DataFrame, block: str, threshold: float, adjusted=None) -> DataFrame:
    """Rows of :func:`similar.candidates` with their candidates in order of preference.

    adjusted: from a candidate (a struct column) to its adjusted similarity, which must reach the threshold too.
    """
    adj = (lambda m: F.coalesce(adjusted(m), m["sim"])) if adjusted else (lambda m: m["sim"])
    pairs = F.transform("met", lambda m: F.struct(m["ord"].alias("ad_ord"), m["sim"].alias("sim"), adj(m).alias("adjusted")))
    rows = settled(met.select(F.col(block).alias("block"), F.col("ord").alias("hb_ord"), pairs.alias("all"), ((F.size("met") == 0) & ~F.col("unknown")).alias("below")), "all")
    good = F.filter("all", lambda m: m["adjusted"] >= threshold)
    valid = F.array_sort(F.transform(good, lambda m: F.struct((-m["adjusted"]).alias("a"), (-m["sim"]).alias("b"), m["ad_ord"].alias("ad_ord"), m["sim"].alias("sim"), m["adjusted"].alias("adjusted"))))
    failed = F.transform(F.filter("all", lambda m: ~(m["adjusted"] >= threshold)), lambda m: m["ad_ord"])
    rows = settled(rows.select("block", "hb_ord", valid.alias("valid"), failed.alias("failed"), "below"), "valid")
    return rows.select("block", "hb_ord", F.col("valid.ad_ord").alias("ords"), F.col("valid.sim").alias("sims"), F.col("valid.adjusted").alias("adjs"), "failed", "below")


def _proposed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block and bucket, first what earlier buckets hold (held), then rooms in order: each room's first free candidate."""
    now, used = object(), set()
    for b in batches:
        out = []
        for at, bucket, held, hb, ords, sims, adjs, failed, below in zip(*(b.column(c).to_pylist() for c in ("block", "bucket", "held", "hb_ord", "ords", "sims", "adjs", "failed", "below")), strict=True):
            if (at, bucket) != now:
                now, used = (at, bucket), set()
            if held is not None:
                used.add(held)
                continue
            hit = next((i for i, o in enumerate(ords) if o not in used), None)
            if hit is not None:
                used.add(ords[hit])
                out.append((at, bucket, hb, ords[hit], sims[hit], adjs[hit], None))
            elif any(o not in used for o in failed):
                out.append((at, bucket, hb, None, None, None, "failed_validation_checks"))
            else:
                out.append((at, bucket, hb, None, None, None, "below_threshold" if below else "no_match_found"))
        if out:
            kinds = [b.schema.field("block").type, pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["block", "bucket", "hb_ord", "ad_ord", "sim", "adjusted", "reason"])


def _round(rooms: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """Proposals of rooms (block, bucket, hb_ord, candidates), given held (block, bucket, held: a place that an earlier bucket has)."""
    cols = ["hb_ord", "ords", "sims", "adjs", "failed", "below"]
    rows = rooms.select("block", "bucket", F.lit(None).cast("long").alias("held"), *cols)
    if held is not None:
        rows = rows.unionByName(held.select("block", "bucket", "held", *[F.lit(None).cast(rooms.schema[c].dataType).alias(c) for c in cols]))
    kind = rooms.schema["block"].dataType.simpleString()
    return rows.repartition("block", "bucket").sortWithinPartitions("block", "bucket", F.col("held").isNull(), "hb_ord").mapInArrow(_proposed, f"block {kind}, bucket long, hb_ord long, ad_ord long, sim double, adjusted double, reason string")


def _accepted(rooms: DataFrame) -> DataFrame:
    """Final proposals of the rooms of large blocks, by rounds."""
    rooms = shared.cut(rooms, "rooms")
    placed = with_places(rooms.select("block", "hb_ord"), [F.col("hb_ord").asc()], ["block"], "place")
    bucket = F.floor(F.col("place") / BUCKET_ROOMS)
    rooms = shared.cut(rooms.join(placed.select("block", "hb_ord", bucket.alias("bucket")), ["block", "hb_ord"]), "buckets")
    last = shared.cut(rooms.groupBy("block").agg(F.max("bucket").alias("last")), "last-buckets")
    held = None
    while True:
        found = shared.cut(_round(rooms, held), "proposals")
        taken = found.where("ad_ord is not null")
        held = taken.groupBy("block", F.col("ad_ord").alias("held")).agg(F.min(F.struct("hb_ord", "bucket")).alias("by"), F.count("*").alias("n"))
        held = shared.cut(held.select("block", "held", F.col("by.bucket").alias("of"), "n"), "held")
        if held.where("n > 1").isEmpty():
            return found
        # later buckets of the block learn what is held; a block's buckets are few
        held = held.join(last, "block").where("of < last").select("block", "held", F.explode(F.sequence(F.col("of") + 1, F.col("last"))).alias("bucket"))


def _assigned(rooms: DataFrame, block: str, large: DataFrame | None) -> DataFrame:
    """Assignment of rooms as :func:`_ranked` gives them. large: the blocks (column block) of more than BUCKET_ROOMS rooms, if any."""
    if large is None or large.isEmpty():
        found = _round(rooms.withColumn("bucket", F.lit(0).cast("long")))
    else:
        with shared.scratch(rooms.sparkSession) as own:
            rooms = shared.cut(rooms, "candidates")
            hot = large.select(F.col("block").alias("l_"))
            small = _round(rooms.join(hot, F.col("block") == F.col("l_"), "left_anti").withColumn("bucket", F.lit(0).cast("long")))
            found = own.keep(small.unionByName(_accepted(rooms.join(hot, F.col("block") == F.col("l_"), "left_semi"))), "assigned")
    return found.select(F.col("block").alias(block), "hb_ord", "ad_ord", "sim", "adjusted", "reason")


def assign(pairs: DataFrame, block: str, threshold: float, adjusted: Column | None = None) -> DataFrame:
    """block, hb_ord, ad_ord, sim, adjusted, reason: a row per hb room that has ad rooms in its block; ad_ord is null where unmatched.

    pairs: block, hb_ord, ad_ord and sim of all pairs of a block. Each hb room, in order, takes its best unused candidate: raw
    similarity and ``adjusted`` (if given) must reach the threshold. Null similarity is no candidate, and with one of them
    the best similarity of a room counts as unknown. With large blocks, results are written in the shared folder.
    """
    known = F.col("sim").isNotNull() & ~F.isnan("sim")
    adj = F.coalesce(adjusted, F.col("sim")) if adjusted is not None else F.col("sim")
    one = F.struct(F.col("ad_ord").cast("long").alias("ord"), "sim", adj.alias("adj"))
    met = pairs.groupBy(block, F.col("hb_ord").cast("long").alias("ord")).agg(F.collect_list(F.when(known & (F.col("sim") >= threshold), one)).alias("met"), F.max(~known).alias("unknown"))
    return _assigned(_ranked(met, block, threshold, lambda m: m["adj"]), block, _large(pairs.select(block, "hb_ord").distinct(), block))


def _large(rooms: DataFrame, block: str) -> DataFrame:
    return rooms.groupBy(F.col(block).alias("block")).agg(F.count("*").alias("n")).where(F.col("n") > BUCKET_ROOMS)


def _many(hb: DataFrame, ad: DataFrame, block: str) -> DataFrame:
    """b_: blocks that are too large for one pass."""
    return similar.block_sizes(hb, ad, block).where(F.greatest("n_", "m_") > ONE_PASS_ROOMS)


def _cells(active: DataFrame, places: DataFrame, held: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Rooms dealt into parts of at most about BUCKET_ROOMS, and the places for each part, with who holds them."""
    parts = active.groupBy("block").agg(F.ceil(F.count("*") / BUCKET_ROOMS).cast("int").alias("parts"))
    if held is not None:
        places = places.join(held.select("block", F.col("ad_ord").alias("ord"), F.col("hb_ord").alias("by")), ["block", "ord"], "left")
    else:
        places = places.withColumn("by", F.lit(None).cast("long"))
    dealt = active.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("ord"), "parts").cast("int")).drop("parts")
    return dealt, places.join(parts, "block").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")


def _in_phases(rooms: DataFrame, places: DataFrame, threshold: float, facts: tuple[str, ...], adjust: similar.Adjust | None) -> DataFrame:
    """Assignment in large blocks from lists of LIST_ROOMS candidates. rooms, places: block, ord, vec and facts.

    A room whose list is used up, though it has more candidates, waits. In the next phase it gets a list of the best places that no earlier
    room holds: what is held only passes to earlier rooms, so refusals stay, and no list of all candidates is needed. All propose again from their lists.
    """
    rooms, places = shared.cut(rooms, "rooms"), shared.cut(places, "seats")
    key = ["block", "hb_ord"]
    active, held, flags, lists = rooms, None, None, None
    while True:
        found = similar.best(*_cells(active, places, held), LIST_ROOMS, threshold, facts, adjust)
        lists = shared.cut(found if lists is None else found.unionByName(lists.join(active.select("block", F.col("ord").alias("hb_ord")), key, "left_anti")), "lists")
        flags = lists if flags is None else flags
        proposals = lists.select(*key, "ords", "sims", "adjs", F.array().cast("array<bigint>").alias("failed"), F.lit(False).alias("below"))
        got = shared.cut(_assigned(proposals, "block", _large(lists, "block")), "got")
        held = got.where("ad_ord is not null").drop("reason")
        waiting = got.where("ad_ord is null").join(lists.where("more").select(*key), key).select("block", F.col("hb_ord").alias("ord"))
        active = shared.cut(rooms.join(waiting, ["block", "ord"], "left_semi"), "waiting")
        if active.isEmpty():
            break
    left = shared.cut(flags.join(held.select(*key), key, "left_anti").select(*key, "near", "failed", "unknown"), "left")
    failed = left.where("failed").select(*key)
    if adjust is not None:  # whether a place that failed is open, now that all is settled
        again = rooms.join(failed.withColumnRenamed("hb_ord", "ord"), ["block", "ord"], "left_semi")
        failed = similar.best(*_cells(again, places, held), 1, threshold, facts, adjust).where("failed").select(*key)
    reason = F.when(F.col("open"), "failed_validation_checks").when(F.col("near") | F.col("unknown"), "no_match_found").otherwise("below_threshold")
    none = left.join(failed.withColumn("open", F.lit(True)), key, "left")
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("ad_ord", "long"), ("sim", "double"), ("adjusted", "double"))]
    return held.withColumn("reason", F.lit(None).cast("string")).unionByName(none.select(*key, *nothing, reason.alias("reason")))


def _matched(hb: DataFrame, ad: DataFrame, block: str, vec: str, threshold: float, facts: tuple[str, ...] = (), adjust: similar.Adjust | None = None) -> DataFrame:
    """Greedy assignment without lists of all candidates: in one pass, or in phases in large blocks."""
    if _many(hb, ad, block).isEmpty():
        return similar.chosen(hb, ad, block, vec, threshold, facts, adjust).withColumnRenamed("block", block)
    with shared.scratch(hb.sparkSession) as own:
        hot = shared.cut(_many(hb, ad, block).select(F.col("b_").alias("l_")), "large-blocks")
        of = lambda df, how: df.join(hot, F.col(block) == F.col("l_"), how)
        large = [of(df, "left_semi").select(F.col(block).alias("block"), F.col("ord").cast("long").alias("ord"), F.col(vec).alias("vec"), *facts) for df in (hb, ad)]
        small = similar.chosen(of(hb, "left_anti"), of(ad, "left_anti"), block, vec, threshold, facts, adjust)
        found = own.keep(small.unionByName(_in_phases(*large, threshold, facts, adjust)), "assigned")
    return found.withColumnRenamed("block", block)


def match_rooms(hb: DataFrame, ad: DataFrame, block: str, vec: str, threshold: float = ST_THRESHOLD) -> DataFrame:
    """Greedy assignment by plain similarity. Null similarity is no candidate; with one of them, a room's best one counts as unknown."""
    return _matched(hb, ad, block, vec, threshold)


def match_rooms_validated(hb: DataFrame, ad: DataFrame, block: str, vec: str, threshold: float = GM_THRESHOLD, penalties: scoring.Penalties = scoring.Penalties(), text: str = "text", occ: str = "occupancy") -> DataFrame:
    """Greedy assignment by similarity less penalties for bedrooms, occupancy and room type."""
    facts = scoring.fact_numbers(F.col(text), F.col(occ))
    hb, ad = (df.select(block, "ord", vec, *[c.alias(f"_{n}") for n, c in facts.items()]) for df in (hb, ad))
    bare = lambda x: {n[1:]: v for n, v in x.items()}
    return _matched(hb, ad, block, vec, threshold, tuple(f"_{n}" for n in facts), lambda sim, a, b: scoring.adjusted_arrays(sim, bare(a), bare(b), penalties))


def unmatched_rooms(hb: DataFrame, ad: DataFrame, assigned: DataFrame, block: str) -> DataFrame:
    """side, block, ord, reason for all rooms without a partner; hb and ad hold the rooms of the paired blocks.

    Every block is there on at least one side; a side that is empty makes the whole other side unmatched.
    """
    none_ad = hb.join(ad.select(block).distinct(), block, "left_anti").select(F.lit("hb").alias("side"), block, F.col("ord").cast("long"), F.lit("no_axisdata_rooms_available").alias("reason"))
    none_hb = ad.join(hb.select(block).distinct(), block, "left_anti").select(F.lit("ad").alias("side"), block, F.col("ord").cast("long"), F.lit("no_hotelbeds_rooms_available").alias("reason"))
    left = assigned.where("ad_ord is null").select(F.lit("hb").alias("side"), block, F.col("hb_ord").alias("ord"), "reason")
    used = assigned.where("ad_ord is not null").select(block, F.col("ad_ord").alias("ord"))
    right = ad.join(hb.select(block).distinct(), block, "left_semi").withColumn("ord", F.col("ord").cast("long")).join(used, [block, "ord"], "left_anti")
    return left.unionByName(right.select(F.lit("ad").alias("side"), block, "ord", F.lit("no_hotelbeds_match_found").alias("reason"))).unionByName(none_ad).unionByName(none_hb)
