"""Nested results of matching: hotel pairs with their matches and unmatched rooms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innkeep.operators import summary
from innkeep.sources.documents import Document, document

_SIDES = (("hb", "hotelbeds"), ("ad", "axisdata"))


def pair_report(pairs: DataFrame, hb_rooms: DataFrame, ad_rooms: DataFrame, assigned: DataFrame, unmatched: DataFrame) -> DataFrame:
    """A row per hotel pair: codes, names, room totals, room_matches, unmatched rooms of both sides.

    pairs: pair, place_id, hb_hotel_code, hb_hotel_name, ad_...; rooms: pair, ord, room_code, room_id, text_for_embedding.
    """
    room = ["room_code", "room_id", "text"]
    side = {p: df.select("pair", F.col("ord").cast("long").alias("ord"), "room_code", "room_id", F.col("text_for_embedding").alias("text")) for (p, _), df in zip(_SIDES, (hb_rooms, ad_rooms), strict=True)}
    m = assigned.where("ad_ord is not null")
    for p, name in _SIDES:
        m = m.join(side[p].select("pair", F.col("ord").alias(f"{p}_ord"), *[F.col(c).alias(f"{name}_{c}" if c != "text" else f"{name}_text") for c in room]), ["pair", f"{p}_ord"])
    cols = [f"{name}_{c}" for _, name in _SIDES for c in room]
    matches = m.groupBy("pair").agg(F.array_sort(F.collect_list(F.struct("hb_ord", F.struct(F.col("sim").alias("similarity_score"), F.col("adjusted").alias("adjusted_score"), *cols).alias("r")))).alias("x"))
    # lists are never broadcast: Spark's estimates count a list as one member
    out = pairs.join(matches.select("pair", F.transform("x", lambda e: e["r"]).alias("room_matches")).hint("merge"), "pair", "left")
    for p, name in _SIDES:
        u = unmatched.where(F.col("side") == p).join(side[p], ["pair", "ord"])
        u = u.groupBy("pair").agg(F.array_sort(F.collect_list(F.struct("ord", F.struct(*room, "reason").alias("r")))).alias("x")).select("pair", F.transform("x", lambda e: e["r"]).alias(f"unmatched_{name}_rooms"))
        n = side[p].groupBy("pair").agg(F.count("*").alias(f"{name}_total_rooms"))
        out = out.join(u.hint("merge"), "pair", "left").join(n, "pair", "left").fillna(0, [f"{name}_total_rooms"])
        out = out.withColumnRenamed(f"{p}_hotel_code", f"{name}_hotel_code").withColumnRenamed(f"{p}_hotel_name", f"{name}_hotel_name")
    return out.withColumn("confidence", F.lit(1.0))


def mapped_document(report: DataFrame, assigned: DataFrame, ad_unmatched: DataFrame, **metadata) -> Document:
    """The document {metadata, summary, hotel_pairs}, pairs by place_id and then in input order."""
    s = summary.match_summary(assigned, ad_unmatched, "pair")
    meta = F.struct(*[F.lit(v).alias(k) if not isinstance(v, Column) else v.alias(k) for k, v in metadata.items()], F.current_timestamp().cast("string").alias("generated_at"))
    return document(s.select(meta.alias("metadata"), F.struct(*s.columns).alias("summary")), "hotel_pairs", report, [F.col("place_id").asc(), F.col("pair").asc()], ("pair",))


def hotel_mapping(hotel_matches: DataFrame, room_lists: DataFrame) -> DataFrame:
    """ord, confidence, rooms: hotel matches with the room list at the same place (none: empty), each room at 0.8 or 0.0.

    room_lists: ord, rooms (array of structs with matched boolean). A hotel's confidence is its share of matched rooms.
    """
    rooms = F.transform("rooms", lambda r: F.struct(r.alias("room"), F.when(r["matched"], 0.8).otherwise(0.0).alias("confidence")))
    share = F.coalesce(F.try_divide(F.size(F.filter("rooms", lambda r: r["matched"])), F.size("rooms")), F.lit(0.0))
    return hotel_matches.join(room_lists.hint("merge"), "ord", "left").withColumn("confidence", F.coalesce(share, F.lit(0.0))).withColumn("rooms", F.coalesce(rooms, F.array().cast(room_lists.select(rooms.alias("x")).schema["x"].dataType)))


def output_document(mappings: DataFrame, order: str = "ord") -> Document:
    """The document {metadata, mappings} with counts."""
    n = mappings.agg(F.count("*").alias("hotels"), F.coalesce(F.sum(F.size("rooms")), F.lit(0)).alias("rooms"))
    meta = F.struct(F.current_timestamp().cast("string").alias("generated_at"), F.col("hotels").alias("total_hotels"), F.col("rooms").alias("total_rooms"))
    return document(n.select(meta.alias("metadata")), "mappings", mappings, [F.col(order).asc()], (order,))


def valid_document(doc: Document) -> bool:
    return {"metadata", "mappings"} <= doc.members
