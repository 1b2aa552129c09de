"""Similarities, penalties and bands."""

from __future__ import annotations

from dataclasses import dataclass
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeep.functions.ratio import ratios

def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column, norm_a: Column, norm_b: Column) -> Column:
    """Cosine similarity of double arrays; null if either is zero."""
    return F.try_divide(dot(a, b), norm_a * norm_b)


@dataclass(frozen=True)
class Penalties:
    """The shares that a similarity loses by default."""

    bedroom: float = 0.30
    occupancy_high: float = 0.25
    occupancy_low: float = 0.10
    adults_high: float = 0.25
    adults_low: float = 0.10
    children: float = 0.15
    room_type: float = 0.50


#: Room types with their patterns, the first that fits counts.
ROOM_TYPES = [("apartment", "apartment|apt"), ("suite", "suite"), ("studio", "studio"), ("room", "room"), ("double", "double"), ("single", "single"), ("twin", "twin")]


def bedrooms(text: Column) -> Column:
    """Number of bedrooms that a text names; studio is 0; null if it names none."""
    low = F.lower(text)
    digits = F.nullif(F.regexp_extract(low, r"(?U)\b(\d+)\s*bedroom", 1), F.lit("")).try_cast("int")
    out = F.when(digits.isNotNull(), digits)
    for n, word in enumerate(["one", "two", "three", "four"], 1):
        out = out.when(low.rlike(rf"(?U)\b{word}\s*bedroom"), n)
    return out.when(low.rlike(r"(?U)\bstudio\b"), 0)


def room_type(text: Column) -> Column:
    low, out = F.lower(text), None
    for name, pattern in ROOM_TYPES:
        fits = low.rlike(rf"(?U)\b({pattern})\b")
        out = F.when(fits, name) if out is None else out.when(fits, name)
    return out


def _tiers(a: Column, b: Column, high: float, low: float) -> Column:
    diff = F.abs(a - b)
    return F.when(diff >= 2, high).when(diff == 1, low).otherwise(F.lit(0.0))


def penalized(sim: Column, text_a: Column, text_b: Column, occ_a: Column, occ_b: Column, p: Penalties = Penalties()) -> Column:
    """struct<adjusted, flags>: a similarity less its penalties, in the order bedroom, occupancy, type; and what was found.

    occ_a, occ_b: structs of max_occupancy, max_adults and max_children; a null struct or member is never penalized.
    """
    return penalized_facts(sim, (bedrooms(text_a), room_type(text_a), occ_a), (bedrooms(text_b), room_type(text_b), occ_b), p)


def penalized_facts(sim: Column, a: tuple[Column, Column, Column], b: tuple[Column, Column, Column], p: Penalties = Penalties()) -> Column:
    """The same from bedrooms, room type and occupancy of both sides, so that they need be worked out only once per room."""
    (ba, ta, occ_a), (bb, tb, occ_b) = a, b
    bedroom = F.coalesce(ba != bb, F.lit(False))
    tiers = [
        ("max_occupancy", _tiers(occ_a["max_occupancy"], occ_b["max_occupancy"], p.occupancy_high, p.occupancy_low)),
        ("max_adults", _tiers(occ_a["max_adults"], occ_b["max_adults"], p.adults_high, p.adults_low)),
        ("max_children", _tiers(occ_a["max_children"], occ_b["max_children"], p.children, 0.0)),
    ]
    studio = F.coalesce(((ta == "studio") & (bb > 0)) | ((tb == "studio") & (ba > 0)), F.lit(False)) & ta.isNotNull() & tb.isNotNull()
    adjusted = sim * F.when(bedroom, 1 - p.bedroom).otherwise(1.0)
    for _, t in tiers:
        adjusted = adjusted * (1 - F.coalesce(t, F.lit(0.0)))
    adjusted = adjusted * F.when(studio, 1 - p.room_type).otherwise(1.0)

    def said(name: str, t: Column) -> Column:
        high = F.abs(occ_a[name] - occ_b[name]) >= 2
        kind = F.lit("_diff") if name == "max_children" else F.when(high, "_high_diff").otherwise("_low_diff")
        return F.when(t > 0, F.concat(F.lit(name), kind, F.format_string(": HB=%d AD=%d (-%d%%)", occ_a[name], occ_b[name], F.round(t * 100).cast("int"))))

    notes = [F.when(bedroom, F.format_string("bedroom_mismatch: HB=%d AD=%d (-%d%%)", ba, bb, F.lit(round(p.bedroom * 100))))]
    notes += [said(n, t) for n, t in tiers]
    notes.append(F.when(studio, F.lit(f"studio_bedroom_mismatch (-{p.room_type * 100:.0f}%)")))
    any_tier = (F.coalesce(tiers[0][1], F.lit(0.0)) > 0) | (F.coalesce(tiers[1][1], F.lit(0.0)) > 0) | (F.coalesce(tiers[2][1], F.lit(0.0)) > 0)
    flags = F.struct(
        (~bedroom).alias("bedroom_match"),
        (~studio).alias("room_type_match"),
        (~any_tier).alias("occupancy_match"),
        F.filter(F.array(*notes), lambda x: x.isNotNull()).alias("penalties_applied"),
        F.when(bedroom, ba).alias("hb_bedrooms"),
        F.when(bedroom, bb).alias("ad_bedrooms"),
    )
    return F.struct(adjusted.alias("adjusted"), flags.alias("flags"))


def fact_numbers(text: Column, occ: Column) -> dict[str, Column]:
    """What :func:`adjusted_arrays` needs of a room, as doubles: bedrooms, whether it is a studio (null without a type), and occupancy."""
    kind = room_type(text)
    named = {"bedrooms": bedrooms(text), "studio": F.when(kind.isNotNull(), (kind == "studio").cast("int")), **{n: occ[n] for n in ("max_occupancy", "max_adults", "max_children")}}
    return {n: c.cast("double") for n, c in named.items()}


def adjusted_arrays(sim: np.ndarray, a: dict[str, np.ndarray], b: dict[str, np.ndarray], p: Penalties = Penalties()) -> np.ndarray:
    """The adjusted similarities of :func:`penalized_facts`, to the last bit, of many pairs at once; facts by name, NaN where null."""
    differ = lambda n: np.abs(a[n] - b[n])
    tier = lambda d, high, low: np.where(d >= 2, high, np.where(d == 1, low, 0.0))
    out = sim * np.where(differ("bedrooms") > 0, 1 - p.bedroom, 1.0)
    for n, high, low in (("max_occupancy", p.occupancy_high, p.occupancy_low), ("max_adults", p.adults_high, p.adults_low), ("max_children", p.children, 0.0)):
        out = out * (1 - tier(differ(n), high, low))
    known = ~np.isnan(a["studio"]) & ~np.isnan(b["studio"])
    studio = known & (((a["studio"] == 1) & (b["bedrooms"] > 0)) | ((b["studio"] == 1) & (a["bedrooms"] > 0)))
    return out * np.where(studio, 1 - p.room_type, 1.0)


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of arrays as sets; 0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def numeric_match(a: Column, b: Column) -> Column:
    """1 if both are empty, 0 if one is; else the shared part of the larger set."""
    both = F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both)


def ratio(a: str | None, b: str | None) -> float:
    """Whole-percent similarity of texts by matching blocks, from 0 to 1 (the ratio of Python's difflib)."""
    return round(100 * SequenceMatcher(None, a, b).ratio()) / 100 if a and b else 0.0


@F.pandas_udf(T.DoubleType())
def fuzzy_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """``ratio`` of two columns, all pairs of a batch at once."""
    return pd.Series(ratios([x if isinstance(x, str) else None for x in a], [x if isinstance(x, str) else None for x in b]), dtype="float64")


#: The weights of the parts of a room score.
WEIGHTS = {"token": 35, "stem": 30, "numeric": 20, "fuzzy": 15}


def room_score(token: Column, stem: Column, numeric: Column, fuzzy: Column) -> Column:
    """The weighted score, 0 to 100."""
    return (token * WEIGHTS["token"] + stem * WEIGHTS["stem"] + numeric * WEIGHTS["numeric"] + fuzzy * WEIGHTS["fuzzy"]) / sum(WEIGHTS.values()) * 100


def score_features(token: Column, stem: Column, numeric: Column, fuzzy: Column) -> Column:
    parts = [F.when(c > (0.5 if n == "fuzzy" else 0), F.concat(F.lit(f"{n}:"), F.format_string("%.2f", c))) for n, c in zip(WEIGHTS, (token, stem, numeric, fuzzy), strict=True)]
    return F.filter(F.array(*parts), lambda x: x.isNotNull())


def half_even(c: Column, digits: int = 2) -> Column:
    """A double rounded to some decimals (8 at most) by its exact binary value, ties to the even digit, as Python's round does.

    The product with a power of ten is taken as the exact sum of two doubles: the number is split into halves of 26 bits, whose
    products are exact, and the error of their sum is known (Dekker's and Knuth's transformations). So a tie is a tie
    only if the binary value lies right between two decimals. Numbers too large to have such decimals stay.
    """
    if not 0 <= digits <= 8:
        raise ValueError("0 to 8 decimals")
    ten = 10.0**digits
    x = F.abs(c.cast("double"))
    big = x * 134217729.0  # 2^27 + 1
    high = big - (big - x)
    a, b = high * ten, (x - high) * ten
    total = a + b
    rest = (a - (total - (total - a))) + (b - (total - a))
    whole = F.floor(total).cast("double")
    over = (total - whole - 0.5) + rest
    up = (over > 0) | ((over == 0) & (whole % 2 == 1))
    rounded = (whole + F.when(up, 1.0).otherwise(0.0)) / ten * F.when(c < 0, -1.0).otherwise(1.0)
    return F.when(x < 2.0**52 / ten, rounded).otherwise(c.cast("double"))


def band(score: Column) -> Column:
    """The match type of an unrounded score. The bands' limits."""
    return F.when(score >= 95, "exact").when(score >= 90, "high_confidence").when(score >= 85, "medium_confidence").when(score >= 75, "low_confidence").otherwise("none")
