"""Occupancy structs: normal forms of both suppliers and their description in words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from innkeep.functions.text import safe_int

FIELDS = ["min_occupancy", "max_occupancy", "min_adults", "max_adults", "min_children", "max_children"]
OPTIONAL = ["max_child_age", "min_infants", "max_infants", "max_infant_age", "standard_occupancy"]
STRUCT = "struct<" + ",".join(f"{n}:int" for n in FIELDS + OPTIONAL) + ">"


def from_hotelbeds(occ: Column) -> Column:
    """Five integers renamed, absent ones 0; null stays null. occ: struct of minOccupancy, maxOccupancy, minAdult, maxAdults, maxChildren."""
    int0 = lambda n: F.coalesce(occ[n].cast("int"), F.lit(0))
    parts = [int0("minOccupancy"), int0("maxOccupancy"), int0("minAdult"), int0("maxAdults"), F.lit(0), int0("maxChildren")]
    out = F.struct(*[p.alias(n) for p, n in zip(parts, FIELDS, strict=True)], *[F.lit(None).cast("int").alias(n) for n in OPTIONAL])
    return F.when(occ.isNotNull(), out)


def from_axisdata(occ: Column) -> Column:
    """Integers from texts: base fields 0 if absent or unreadable; optional ones null if absent or empty, else 0 if unreadable."""
    base = ["MinOccupancy", "MaxOccupancy", "MinAdultOccupancy", "MaxAdultOccupancy", "MinChildOccupancy", "MaxChildOccupancy"]
    more = ["MaxChildAge", "MinInfantOccupancy", "MaxInfantOccupancy", "MaxInfantAge", "StandardOccupancy"]
    opt = lambda n: F.when(F.nullif(occ[n], F.lit("")).isNotNull(), safe_int(occ[n]))
    out = F.struct(*[safe_int(occ[s]).alias(n) for s, n in zip(base, FIELDS, strict=True)], *[opt(s).alias(n) for s, n in zip(more, OPTIONAL, strict=True)])
    return F.when(occ.isNotNull(), out)


def describe(occ: Column) -> Column:
    """An occupancy in words; empty if there is nothing to say."""
    text = lambda c: c.cast("string")

    def span(low: Column, high: Column, one: str, two: str, upto: str) -> Column:
        return F.when(low.isNotNull() & (low == high), F.format_string(one, high)).when(low.isNotNull() & high.isNotNull(), F.format_string(two, low, high)).when(high.isNotNull(), F.format_string(upto, high))

    def some(n: Column, age: Column, what: str) -> Column:
        aged = F.when(age.isNotNull(), F.concat(F.lit(" (max age "), text(age), F.lit(")"))).otherwise(F.lit(""))
        return F.when(n > 0, F.concat(F.lit("up to "), text(n), F.lit(f" {what}"), aged))

    parts = [
        span(occ["min_occupancy"], occ["max_occupancy"], "accommodates %d guests", "accommodates %d to %d guests", "accommodates up to %d guests"),
        span(occ["min_adults"], occ["max_adults"], "%d adults", "%d to %d adults", "up to %d adults"),
        some(occ["max_children"], occ["max_child_age"], "children"),
        some(occ["max_infants"], occ["max_infant_age"], "infants"),
        F.when(occ["standard_occupancy"] > 0, F.concat(F.lit("standard occupancy "), text(occ["standard_occupancy"]))),
    ]
    return F.coalesce(F.concat_ws(", ", *parts), F.lit(""))


def summary_json(occ: Column) -> Column:
    """The fields that have a value, in order, as JSON."""
    return F.to_json(occ)
