"""Assignment in large blocks by rounds, pairs in cells, exact similarities."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from innkeep.functions import scoring
from innkeep.operators import matching, similar
from test_engine import greedy


def rooms(rng, blocks, size, kinds):
    """Rooms of few distinct vectors, so that ties are many; some without similarity."""
    vectors = [[rng.choice([0.0, 1.0, 2.0]) for _ in range(3)] for _ in range(kinds)] + [[0.0, 0.0, 0.0], None, [1.0, float("nan"), 0.0], [1.0, 2.0]]
    weights = [20] * kinds + [1, 1, 1, 1]
    return [(b, o, rng.choices(vectors, weights)[0]) for b in range(blocks) for o in rng.sample(range(1000), rng.randint(1, size))]


def similarity(x, y):
    if x is None or y is None or len(x) != len(y):
        return None
    dot = norm_x = norm_y = 0.0
    for a, b in zip(x, y, strict=True):
        dot, norm_x, norm_y = dot + a * b, norm_x + a * a, norm_y + b * b
    return None if not norm_x or not norm_y or norm_x != norm_x or norm_y != norm_y else dot / (np.sqrt(norm_x) * np.sqrt(norm_y))


@pytest.mark.parametrize("seed,bucket,tile,cell", [(0, 4096, 4096, 1 << 26), (2, 3, 2, 4)])
def test_large_blocks_against_loop(spark, monkeypatch, seed, bucket, tile, cell):
    monkeypatch.setattr(matching, "BUCKET_ROOMS", bucket)
    monkeypatch.setattr(similar, "TILE", tile)
    monkeypatch.setattr(similar, "CELL_PAIRS", cell)
    rng = random.Random(seed)
    hb, ad = rooms(rng, 5, 17, 6), rooms(rng, 5, 12, 6)
    pairs = [(b, o, p, s, s) for b, o, x in hb for c, p, y in ad if b == c for s in [similarity(x, y)]]
    kind = "b long, ord long, v array<double>"
    got = matching.match_rooms(spark.createDataFrame([*hb, (None, 3, [1.0, 1.0, 1.0])], kind), spark.createDataFrame([*ad, (None, 4, [1.0, 1.0, 1.0])], kind), "b", "v", 0.9).collect()
    assert sorted(((r["b"], r["hb_ord"], r["ad_ord"], r["reason"]) for r in got), key=str) == greedy(pairs, 0.9)
    met = {(r["b"], r["hb_ord"], r["ad_ord"]): r["sim"] for r in matching.room_pairs(spark.createDataFrame(hb, kind), spark.createDataFrame(ad, kind), "b", "v").collect()}
    assert met == {(b, o, p): s for b, o, p, s, _ in pairs if s is not None}


@pytest.mark.parametrize("bucket", [4])
def test_equal_preferences_in_rounds(spark, monkeypatch, bucket):
    """Every room likes the same candidates best, and later ones are penalized."""
    monkeypatch.setattr(matching, "BUCKET_ROOMS", bucket)
    pairs = [("b", h, a, 1.0 - a / 100, (1.0 - a / 100) * (0.5 if (h + a) % 5 == 0 else 1.0)) for h in range(15) for a in range(11)]
    df = spark.createDataFrame(pairs, "b string, hb_ord long, ad_ord long, sim double, adj double")
    got = sorted(((r["b"], r["hb_ord"], r["ad_ord"], r["reason"]) for r in matching.assign(df, "b", 0.6, F.col("adj")).collect()), key=str)
    assert got == greedy(pairs, 0.6) and any(x[3] == "failed_validation_checks" for x in got)


def test_similarities_equal_those_of_the_expression(spark):
    rng = np.random.default_rng(4)
    x = [(0, i, v.tolist()) for i, v in enumerate(rng.normal(size=(40, 37)))]
    df = spark.createDataFrame(x, "b long, ord long, v array<double>")
    a, b = df.select(F.col("ord").alias("i"), F.col("v").alias("x")), df.select(F.col("ord").alias("j"), F.col("v").alias("y"))
    want = {(r["i"], r["j"]): r["s"] for r in a.crossJoin(b).select("i", "j", scoring.cosine(F.col("x"), F.col("y"), scoring.norm(F.col("x")), scoring.norm(F.col("y"))).alias("s")).collect()}
    got = {(r["hb_ord"], r["ad_ord"]): r["sim"] for r in matching.room_pairs(df, df, "b", "v", threshold=0.1).collect()}
    assert got == {k: s for k, s in want.items() if s >= 0.1}


def test_no_rooms(spark):
    df = spark.createDataFrame([("b", 1, [1.0])], "b string, ord long, v array<double>")
    none = df.where("1 = 0")
    for hb, ad in ((df, none), (none, df), (none, none)):
        assert matching.match_rooms(hb, ad, "b", "v").count() == 0


TEXTS = ["one bedroom apartment", "2 bedroom suite", "studio apartment", "studio", "double room", "hall", None]


@pytest.mark.parametrize("seed,bucket,tile,few", [(0, 4096, 4096, 32), (1, 4096, 4096, 32), (2, 3, 2, 2), (3, 5, 4, 1)])
def test_no_list_of_all_candidates(spark, monkeypatch, seed, bucket, tile, few):
    """Penalized rooms against the loop, in one pass and in phases of short lists."""
    rng = random.Random(seed)
    fact = lambda: (rng.choice(TEXTS), rng.choice([None, (rng.choice([None, 1, 2, 4]), rng.choice([1, 2, 3]), rng.choice([None, 0, 3]))]))
    hb, ad = ([(b, o, x, *fact()) for b, o, x in rooms(rng, 4, n, 6)] for n in (17, 12))
    kind = "b long, ord long, v array<double>, text string, occupancy struct<max_occupancy:int,max_adults:int,max_children:int>"
    one, two = spark.createDataFrame(hb, kind), spark.createDataFrame(ad, kind)
    met = one.alias("x").join(two.alias("y"), "b").select("b", F.col("x.ord").alias("i"), F.col("y.ord").alias("j"), scoring.penalized(F.lit(1.0), F.col("x.text"), F.col("y.text"), F.col("x.occupancy"), F.col("y.occupancy"))["adjusted"].alias("f"))
    factor = {(r["b"], r["i"], r["j"]): r["f"] for r in met.collect()}
    pairs = [(b, o, p, s, None if s is None else s * factor[b, o, p]) for b, o, x, *_ in hb for c, p, y, *_ in ad if b == c for s in [similarity(x, y)]]
    monkeypatch.setattr(matching, "BUCKET_ROOMS", bucket)
    monkeypatch.setattr(matching, "LIST_ROOMS", few)
    monkeypatch.setattr(matching, "ONE_PASS_ROOMS", bucket)
    monkeypatch.setattr(similar, "TILE", tile)
    monkeypatch.setattr(similar, "candidates", None)  # these were lists of all candidates
    got = matching.match_rooms_validated(one, two, "b", "v", 0.6).collect()
    assert sorted(((r["b"], r["hb_ord"], r["ad_ord"], r["reason"]) for r in got), key=str) == greedy(pairs, 0.6)
    assert {r["reason"] for r in got} >= {None, "failed_validation_checks"}


def test_adjusted_arrays_equal_the_expression(spark):
    rng = random.Random(5)
    fact = lambda: (rng.choice(TEXTS), rng.choice([None, (rng.choice([None, 1, 2, 4]), rng.choice([1, 2, 3]), rng.choice([None, 0, 3]))]))
    kind = "s double, x string, a struct<max_occupancy:int,max_adults:int,max_children:int>, y string, b struct<max_occupancy:int,max_adults:int,max_children:int>"
    df = spark.createDataFrame([(rng.random(), *fact(), *fact()) for _ in range(400)], kind)
    sides = [scoring.fact_numbers(F.col(t), F.col(o)) for t, o in (("x", "a"), ("y", "b"))]
    r = df.select("s", scoring.penalized(F.col("s"), F.col("x"), F.col("y"), F.col("a"), F.col("b"))["adjusted"].alias("want"), *[c.alias(f"{k}{n}") for k, f in enumerate(sides) for n, c in f.items()]).toPandas()
    a, b = ({n: r[f"{k}{n}"].to_numpy(float) for n in sides[0]} for k in (0, 1))
    assert (scoring.adjusted_arrays(r["s"].to_numpy(), a, b) == r["want"].to_numpy()).all()


def test_only_pairs_that_may_decide_are_worked_out(monkeypatch):
    """Rooms of a block of any size choose among all places; before, each pair above the threshold was worked out and sorted."""
    rng = np.random.default_rng(8)
    vectors = np.abs(rng.normal(size=(700, 8)))
    batch = lambda ords: pa.RecordBatch.from_pydict({"ord": pa.array(ords), "vec": pa.array(vectors[ords].tolist())})
    worked, kept = [], similar._Tile.exact
    monkeypatch.setattr(similar._Tile, "exact", lambda self, x, norm, i, j: worked.append(len(i)) or kept(self, x, norm, i, j))
    seats = similar._Seats(similar._Tile([batch(list(range(0, 700, 2)))], []), 0.3, (), None)
    got = [r for o in range(1, 700, 100) for r in seats.taken(batch(list(range(o, o + 100, 2))))]
    assert sum(worked) < 2000  # of 122,500 pairs
    pairs = [("b", h, a, s, s) for h in range(1, 700, 2) for a in range(0, 700, 2) for s in [similarity(vectors[h].tolist(), vectors[a].tolist())]]
    assert sorted((("b", h, r[0], r[3]) for h, r in zip(range(1, 700, 2), got, strict=True)), key=str) == greedy(pairs, 0.3)
    assert matching.ONE_PASS_ROOMS > 30_769  # a label of 615,384 vectors
