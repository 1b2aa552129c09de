"""Room-code enrichment from a catalog of room types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innkeep.operators.tiers import last_by

BROADCAST_ROWS = 200_000


def catalog(records: DataFrame) -> DataFrame:
    """code, codeDescription, type of the valid records (ord, code, codeDescription, type, occupancies), trimmed; of equal codes the last."""
    fields = ["code", "codeDescription", "type"]
    ok = F.col("occupancies").isNotNull()
    for c in fields:
        ok = ok & (F.trim(c) != "")
    return last_by(records.where(ok).select("ord", *[F.trim(c).alias(c) for c in fields]), ["code"]).drop("ord")


def enrich(rooms: DataFrame, types: DataFrame, hotel: str | None = None) -> DataFrame:
    """rooms (room_code, code_description, ...) with descriptions from the catalog where it has the trimmed code.

    With ``hotel``, hotels of which a room's code is null are dropped whole.
    """
    if hotel is not None:
        rooms = rooms.join(rooms.where("room_code is null").select(hotel).distinct(), hotel, "left_anti")
    known = types.select(F.col("code").alias("_code"), F.col("codeDescription").alias("_found"))
    if known.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    out = rooms.join(known, F.trim("room_code") == F.col("_code"), "left")
    return out.withColumn("code_description", F.coalesce("_found", "code_description")).withColumn("enriched", F.col("_code").isNotNull()).drop("_code", "_found")


def counters() -> dict[str, Column]:
    """Counts of enriched rooms by name, to be observed while they are written: attempts (rooms with a code), enriched, no_code."""
    has = F.coalesce(F.trim("room_code"), F.lit("")) != ""
    return {"attempts": F.count_if(has), "enriched": F.count_if("enriched"), "no_code": F.count_if(~has)}


def enrichment_stats(enriched: DataFrame) -> DataFrame:
    """attempts (rooms with a code), enriched, missed, no_code and the rate in percent."""
    n = counters()
    attempts, hits = n["attempts"], n["enriched"]
    return enriched.agg(attempts.alias("attempts"), hits.alias("enriched"), (attempts - hits).alias("missed"), n["no_code"].alias("no_code"), F.coalesce(F.try_divide(hits, attempts) * 100, F.lit(0.0)).alias("rate"))


def lookup(types: DataFrame, code: str) -> DataFrame:
    """The catalog's entry of a code, without outer spaces; no row if it has none."""
    return types.where(F.col("code") == code.strip())
