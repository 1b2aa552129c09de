"""The inverted index against all pairs, ratios of many pairs against difflib, exact rounding."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from innkeep.functions import scoring
from innkeep.functions.ratio import ratios
from innkeep.operators import fuzzy, inverted
from innkeep.sources import shared


def rooms(spark, rng, n, words, everywhere):
    rows = []
    for i in range(n):
        k = rng.choice([0, 1, 2, 5, 6, 7, 8, 30])
        name = " ".join([*everywhere, *rng.choices(words, k=k), *rng.choice([[], ["2", "beds"], ["3", "rooms"], ["2rooms"]])])
        rows.append((i, f"C{i}", rng.choice([name, name, None, ""]), rng.choice([name, "", None])))
    return spark.createDataFrame(rows, "ord long, code string, name string, description string")


@pytest.mark.parametrize("seed,stems,ratio,everywhere,hot", [(0, True, True, ["room"], 20_000), (2, False, False, ["room", "view"], 3)])
def test_index_against_all_pairs(spark, monkeypatch, seed, stems, ratio, everywhere, hot):
    monkeypatch.setattr(inverted, "HOT_POSTINGS", hot)
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 7))) + rng.choice(["", "s", "ing"]) for _ in range(70)]
    source, target = rooms(spark, rng, 90, words, everywhere), rooms(spark, rng, 120, words, everywhere)
    cols = ["ord", "target_ord", "target_code", "score", "match_type", "matching_features"]
    want, got = (sorted(map(repr, fuzzy.best_matches(source, target, stems, ratio, indexed=x).select(*cols).collect())) for x in (False, True))
    assert got == want


def test_few_pairs_are_scored(spark):
    """A word in every text, and one text in a hundred alike."""
    rng = random.Random(9)
    words = [f"word{i}" for i in range(300)]
    texts = [" ".join(["room", *rng.sample(words, 6)]) for _ in range(400)]
    near = [" ".join(t.split()[:-1]) for t in texts]
    side = lambda xs: fuzzy.normalize_rooms(spark.createDataFrame([(i, "c", x, None) for i, x in enumerate(xs)], "ord long, code string, name string, description string"))
    lists = [F.first(c).alias(c) for c in ("tokens", "stems", "numeric_features")]
    with shared.scratch(spark):
        s, t = side(near).groupBy("text").agg(*lists), side(texts).groupBy("text").agg(F.min("ord").alias("t_ord"), *lists)
        found, unsure, pairs = inverted.search(s, t, True, True)
        assert found.count() == 400 and unsure.count() == 0 and pairs.count() < 0.05 * 400 * 400
        assert {r["text"]: r["t_ord"] for r in found.collect()} == {x: i for i, x in enumerate(near)}


def test_ratios_against_difflib():
    rng = random.Random(3)
    a, b = [], []
    for _ in range(4000):
        letters = rng.choice(["ab", "abc ", "abcdefgh ", "abcdefghijklmnopqrstuvwxyz é😀"])
        x = "".join(rng.choices(letters, k=rng.choice([0, 1, 3, 10, 30, 60])))
        y = list(x) if rng.random() < 0.5 else rng.choices(letters, k=rng.choice([0, 2, 9, 40]))
        for _ in range(rng.randint(0, 4)):
            if y:
                y[rng.randrange(len(y))] = rng.choice(letters)
        a.append(x)
        b.append("".join(y))
    for _ in range(150):  # long second texts, in which common characters begin no block
        letters = rng.choice(["ab", "abc ", "abcdefgh ", "abcdefghijklmnopqrstuvwxyz é"])
        n = rng.choice([199, 200, 201, 420])
        x = "".join(rng.choices(letters, k=rng.choice([5, 100, n])))
        y = (list(x) + rng.choices(letters, k=n))[:n]
        for _ in range(rng.randint(0, 60)):
            y[rng.randrange(n)] = rng.choice(letters)
        a.append(x)
        b.append("".join(y))
    a, b = [*a, None, "x", None], [*b, "x", None, None]
    want = [round(100 * SequenceMatcher(None, x, y).ratio()) / 100 if x and y else 0.0 for x, y in zip(a, b, strict=True)]
    assert ratios(a, b).tolist() == want == [scoring.ratio(x, y) for x, y in zip(a, b, strict=True)]
    assert ratios([], []).tolist() == []


def test_ratio_column(spark):
    df = spark.createDataFrame([("room two", "room 2"), (None, "x"), ("", "")], "a string, b string")
    assert [r["f"] for r in df.select(scoring.fuzzy_ratio("a", "b").alias("f")).collect()] == [scoring.ratio("room two", "room 2"), 0.0, 0.0]


@pytest.mark.parametrize("digits", [0, 2])
def test_rounding_equals_that_of_python(spark, digits):
    rng = random.Random(digits)
    values = [rng.uniform(-200, 200) for _ in range(50_000)] + [k / 8 for k in range(-900, 900)] + [k / 200 for k in range(-9000, 9000)] + [2.675, 0.125, 2.665, 0.005, 0.015, 1e300, -1e17, 0.0, 5e-324]
    got = spark.createDataFrame([(x,) for x in values], "x double").select("x", scoring.half_even(F.col("x"), digits).alias("y")).collect()
    assert all(r["y"] == round(r["x"], digits) for r in got)
    odd = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),)], "x double").select(scoring.half_even(F.col("x"), digits).alias("y")).collect()
    assert odd[0]["y"] is None and odd[1]["y"] != odd[1]["y"] and odd[2]["y"] == float("inf")
