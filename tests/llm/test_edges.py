"""Nulls, empty texts, repeated rows, empty tables and extra columns through the operators."""

import random
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from innkeep.llm import langid, licenses, maxscore, mixing, neardup, nndescent, packing, sharding, skew, store, urltree
from plain import url_templates

DOCS = [(1, "one two three four", "en", "a"), (2, "ONE two  three four", "en", "a"), (3, None, None, None), (4, "", "fr", "b"), (5, "five six seven", "fr", "b"), (1, "one two three four", "en", "a"), (None, "one two three four", "en", "c")]
KIND = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, KIND).withColumn("score", F.lit("extra")).withColumn("id", F.lit("extra"))


def test_near_duplicates(spark, docs):
    got = sorted(((r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs, "doc_id", "text", 2).collect()), key=str)
    assert got == sorted([(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 2, 5, True), (None, 3, None, True)], key=str)


def test_rows_that_share_an_id_are_linked(spark):
    rows = [(1, "a b c d"), (5, "a b c d"), (5, "p q r s"), (5, ""), (7, "p q r s"), (9, "z y x")]
    got = sorted((r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 2).collect())
    assert got == [(1, 3, 1, True), (5, 0, 5, True), (5, 3, 1, False), (5, 3, 1, False), (7, 3, 1, False), (9, 2, 9, True)]


def test_language(spark, docs):
    model = langid.fit(docs, "text", "lang", "doc_id")
    rows = langid.identify(docs, model, "text").collect()
    assert len(rows) == len(DOCS) and {r["lang_pred"] for r in rows if not r["text"]} == {"und"}
    empty = docs.where("1 = 0")
    assert langid.identify(empty, langid.fit(empty, "text", "lang", "doc_id"), "text").count() == 0


def test_mixing_and_packing(spark, docs):
    rows, goal = mixing.plan(docs, "doc_id", "source", mixing.word_count(F.col("text")))
    g = {r["k"]: r["target"] for r in goal.collect()}
    assert abs(sum(g.values()) - 1.5 * 19) < 1e-9 and g["n"] == 0.0
    assert set(mixing.mix(docs, "doc_id", "source", mixing.word_count(F.col("text"))).columns) == set(docs.columns)
    packed = packing.pack(packing.tokenize(docs, "doc_id", "text")).collect()
    assert len(packed) == len(DOCS) and sum(r["length"] == 1 for r in packed) == 2


def test_sharding(spark, docs):
    got = sharding.shard_by_bytes(docs, "doc_id", "text", 3).collect()
    assert len(got) == len(DOCS) and sorted(r["size"] for r in got)[:2] == [8, 8]
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


def test_shards_beside_very_large_rows(spark):
    rows = [(i, f"{i} " * 40) for i in range(600)] + [(1000, "x" * 60_000), (1001, "y" * 9_000)] + [(2000 + i, "same words " * 9) for i in range(200)] + [(None, "no id")] * 5
    got = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 6).collect()
    held = [sum(r["size"] for r in got if r["shard"] == s) for s in range(6)]
    others = sorted(held)[:-1]
    assert len(got) == len(rows) and max(held) == 60_008 and max(others) - min(others) < 0.05 * max(others)
    for s in range(6):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


def test_groups_stay_whole_unless_larger_than_a_shard(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_RANGE", 50)
    monkeypatch.setattr(skew, "KEY_ROWS", 30)
    rows = [(i, f"{i} " * 30) for i in range(800)] + [(2000 + i, f"group {i % 5} " * 20) for i in range(200)] + [(4000 + i, "") for i in range(300)] + [(5000 + i, "hot " * 30) for i in range(900)]
    got = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 8).collect()
    texts, where = dict(rows), defaultdict(set)
    for r in got:
        where[texts[r["id"]]].add(r["shard"])
    held = [sum(r["size"] for r in got if r["shard"] == s) for s in range(8)]
    assert {t for t, s in where.items() if len(s) > 1} == {"hot " * 30} and max(held) - min(held) < 0.02 * max(held)
    for s in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


def test_repeated_query_rows(spark):
    rows = [(0, [5.0, 5.0])] * 9 + [(i, [float(i % 7), 1.0]) for i in range(1, 40)]
    v = spark.createDataFrame(rows, "vec_id long, v array<double>").coalesce(1)
    got = [(r["rank"], r["vec_id"], r["score"]) for r in maxscore.top_k(v, "vec_id", "v", F.col("vec_id") == 0, 3).orderBy("rank").collect()]
    assert got == [(1, 6, 35 * 65536), (2, 13, 35 * 65536), (3, 20, 35 * 65536)]


def test_repeated_query_rows_beside_unusable_ones(spark):
    rows = [(0, [1.0, 2.0]), (0, [float("nan"), 9.0]), (0, [None, 9.0]), (0, None), (0, [float("inf"), 1.0]), (0, [1e308, 1.0]), (1, [3.0, 1.0]), (2, [0.0, 1.0])]
    got = maxscore.top_k(spark.createDataFrame(rows, "vec_id long, v array<double>"), "vec_id", "v", F.col("vec_id") == 0, 5).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got) == [(1, 1, 5 * 65536), (2, 2, 2 * 65536)]


def test_searches(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [float("nan"), 1.0]), (5, [0.0, 0.0]), (6, [0.5, 0.5])]
    v = spark.createDataFrame(rows, "vec_id long, v array<double>").withColumn("score", F.lit(1))
    got = [(r["rank"], r["vec_id"], r["score"]) for r in maxscore.top_k(v, "vec_id", "v", F.col("vec_id") == 0, 3).orderBy("rank").collect()]
    assert got == [(1, 1, 65536), (2, 6, 32768), (3, 2, 0)]
    got = [(r["rank"], r["vec_id"]) for r in nndescent.nearest(v, "vec_id", "v", F.col("vec_id") == 0, 10).orderBy("rank").collect()]
    assert got == [(1, 1), (2, 6), (3, 2)]


def test_licenses_and_urls(spark):
    docs = spark.createDataFrame([(1, "x\nReleased under the MIT Licence"), (2, licenses.KNOWN[0][1]), (3, None), (4, "")], "doc_id long, text string")
    got = {r["doc_id"]: (r["license"], r["notices"]) for r in licenses.scan(docs, "text").collect()}
    assert got[1] == (None, ["MIT"]) and got[2][0] == "MIT" and got[3] == (None, []) and got[4] == (None, [])
    urls = spark.createDataFrame([(1, "http://A.com/en/7?x"), (2, None), (3, "nothing"), (4, "http://b.a.com/en/1"), (5, "http://acom/en/1")], "i long, u string")
    labels = spark.createDataFrame([], "i long, bad int")
    got = {r["id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urltree.judge(urls, labels, "i", "u", "i", "bad", [("block", "a.com", "/en/"), ("allow", "b.a.com", "/en/1")]).collect()}
    assert got == {1: ("a.com", "/en/7", "a.com/en/", "block"), 2: ("", "", None, "allow"), 3: ("", "", None, "allow"), 4: ("b.a.com", "/en/1", "b.a.com/en/1", "allow"), 5: ("acom", "/en/1", None, "allow")}


def test_descent_and_search_go_on_until_nothing_changes(spark):
    x = np.random.default_rng(5).standard_normal((1500, 32))
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>")
    nodes, width = nndescent.encode(v)
    graph = nndescent.build_graph(nodes, width, 15).cache()
    d = np.sqrt(np.maximum((x * x).sum(1)[:, None] + (x * x).sum(1)[None] - 2 * x @ x.T, 0))
    np.fill_diagonal(d, np.inf)
    true = np.argsort(d, axis=1)
    share = np.mean([len(set(np.frombuffer(r["nb"], np.int64).tolist()) & set(true[r["id"], :15].tolist())) / 15 for r in graph.select("id", "nb").collect()])
    asked = spark.range(0, 1500, 50)
    found = defaultdict(list)
    for r in nndescent.search(graph, asked, beam=60, expand=5).where("q <> c").orderBy("q", "d").collect():
        found[r["q"]].append(r["c"])
    recall = np.mean([len(set(found[q][:10]) & set(true[q, :10].tolist())) / 10 for q in range(0, 1500, 50)])
    assert share >= 0.9 and recall >= 0.95, (share, recall)


def test_recall_on_many_vectors(spark):
    x = np.random.default_rng(6).standard_normal((20_000, 24)) + 1000  # far from zero
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, v array<double>").repartition(4)
    got = defaultdict(list)
    for r in nndescent.nearest(v, "vec_id", "v", F.col("vec_id") % 100 == 0, 10).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = 0
    for q in range(0, 20_000, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        assert len(got[q]) == 10 and all(abs(s - d[c]) < 1e-9 for c, s in got[q]) and got[q] == sorted(got[q], key=lambda r: (r[1], r[0]))
        hits += len({c for c, _ in got[q]} & set(np.argsort(d)[1:11].tolist()))
    assert hits / 2000 >= 0.95


def test_nearest_of_many_equal_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(700)] + [(1000 + i, [float(i), 0.5]) for i in range(40)] + [(5000, [1.0, 2.5])]
    v = spark.createDataFrame(rows, "vec_id long, v array<double>").repartition(5)
    got = defaultdict(list)
    for r in nndescent.nearest(v, "vec_id", "v", F.col("vec_id").isin(0, 3, 5000), 5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert got[0] == [(i, 0.0) for i in (1, 2, 3, 4, 5)] and got[3] == [(i, 0.0) for i in (0, 1, 2, 4, 5)] and got[5000] == [(i, 0.5) for i in range(5)]


def test_hubs_meet_in_parts(spark, monkeypatch):
    monkeypatch.setattr(nndescent, "HUB", 20)
    x = np.random.default_rng(7).standard_normal((400, 8))
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, v array<double>")
    got = defaultdict(list)
    for r in nndescent.nearest(v, "vec_id", "v", F.col("vec_id") % 40 == 0, 5).collect():
        got[r["query_id"]].append(r["vec_id"])
    true = {q: set(np.argsort(((x - x[q]) ** 2).sum(axis=1))[1:6].tolist()) for q in got}
    assert len(got) == 10 and np.mean([len(true[q] & set(c)) / 5 for q, c in got.items()]) >= 0.95


def test_search_follows_a_long_chain_to_its_end(spark):
    code = lambda i: np.array([i], np.float16).tobytes()
    rows = [(i, code(i), np.array([i + 1] if i < 11 else [], np.int64).tobytes(), np.array([1.0] if i < 11 else [], np.float32).tobytes()) for i in range(12)]
    graph = spark.createDataFrame(rows, "id long, code binary, nb binary, nd binary").coalesce(1)
    found = nndescent.search(graph, spark.range(1)).collect()
    assert sorted((r["c"], r["d"]) for r in found) == [(i, float(i * i)) for i in range(12)]


def test_scores_beyond_64_bits(spark):
    rows = [(0, [1.0]), (1, [1e7]), (2, [2e7]), (3, [3e7]), (4, [-5.0])]
    v = spark.createDataFrame(rows, "vec_id long, v array<double>")
    got = [(r["vec_id"], r["score"]) for r in maxscore.top_k(v, "vec_id", "v", F.col("vec_id") == 0, 4).orderBy("rank").collect()]
    assert got == [(3, 256 * 256 * 30_000_000), (2, 256 * 256 * 20_000_000), (1, 256 * 256 * 10_000_000), (4, -5 * 65536)]
    rng = np.random.default_rng(9)
    for scale in (1e9, 1e14, 1e80):
        x = np.concatenate([rng.normal(0, scale, (300, 6)), np.full((3, 6), scale * 0.1)])
        v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, v array<double>").repartition(3)
        whole = [[int(c) for c in r] for r in np.floor(x * 256)]
        got = defaultdict(list)
        for r in maxscore.top_k(v, "vec_id", "v", F.col("vec_id") % 60 == 0, 7).orderBy("rank").collect():
            got[r["query_id"]].append((r["vec_id"], r["score"]))
        for q in range(0, 303, 60):
            exact = [(sum(a * b for a, b in zip(whole[q], r, strict=True)), i) for i, r in enumerate(whole) if i != q]
            best = sorted(exact, key=lambda s: (-s[0], s[1]))[:7]
            assert got[q] == [(i, max(-(2**63), min(2**63 - 1, s))) for s, i in best], scale


def test_scan_keeps_every_column(spark):
    docs = spark.createDataFrame([(1, licenses.KNOWN[0][1], "a", "b"), (2, "x " * 300_000, "c", "d"), (2, None, None, None)], "doc_id long, text string, known string, known0 string")
    out = licenses.scan(docs, "text")
    assert set(docs.columns) < set(out.columns)
    got = sorted(((r["doc_id"], r["known"], r["known0"], r["license"]) for r in out.collect()), key=str)
    assert got == [(1, "a", "b", "MIT"), (2, "c", "d", None), (2, None, None, None)]
    assert licenses.scan(docs.where("1 = 0"), "text").count() == 0


def test_url_trees_against_plain_ones(spark):
    rng, urls, labels = random.Random(3), {}, []
    for url, n, bad in [("http://h/x/y/w/a", 100, 0), ("http://h/x/y/w/z", 100, 90), ("http://h/x/y/w/b", 1, None)]:
        for j in range(n):
            if bad is not None:
                labels.append((len(urls), int(j < bad)))
            urls[len(urls)] = url
    for _ in range(1500):
        parts = [rng.choice(["a", "b", "", "forum", "12", f"x{rng.randint(0, 60)}", "2020-1-2", "7.html", "0af3"]) for _ in range(rng.choice([0, 1, 2, 3, 5, 9]))]
        url = "http://" + rng.choice("pqr") + ".com" + "".join("/" + x for x in parts) + rng.choice(["", "/", "?q", "#z", "//"])
        if rng.random() < 0.6:
            labels += [(len(urls), int(rng.random() < (0.9 if "forum" in parts else 0.2 if "p.com" in url else 0.5)))] * rng.choice([1, 1, 2])
        urls[len(urls)] = url
    for url in (None, "junk", "x://", "http://é.com/ü/" + "s/" * 300):
        urls[len(urls)] = url
    labels += [(0, 1), (5, None), (None, 1), (10**9, 1)]
    want = url_templates(urls, labels)
    df = spark.createDataFrame([*urls.items(), (len(urls) - 3, "junk")], "i long, u string").withColumn("host", F.lit("extra")).withColumn("n", F.lit(1)).repartition(4)
    got = [(r["id"], r["host"], r["path"], r["template"], r["bad_share"], r["verdict"]) for r in urltree.judge(df, spark.createDataFrame(labels, "i long, bad int"), "i", "u", "i", "bad", []).collect()]
    assert len(got) == len(urls) + 1
    for i, host, path, template, share, verdict in got:
        assert (host, path, template) == want[i][:3] and abs(share - want[i][3]) < 1e-6 and verdict == ("block" if want[i][3] > 0.5 else "allow")
    by = {template: share for i, host, _, template, share, _ in got if host == "h" and i}
    assert abs(by["/x/y/w/a"] - 0.027) < 0.01 and by["/x/y/w/z"] > 0.88 and 0.4 < by["/x/y/w/b"] < 0.5
    empty = df.where("1 = 0")
    assert urltree.judge(empty, spark.createDataFrame(labels, "i long, bad int"), "i", "u", "i", "bad", []).count() == 0


def test_hot_keys_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(skew, "KEY_ROWS", 10)
    left = spark.range(500).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    right = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    got = sorted((r["id"], r["k"], r["w"]) for r in skew.spread_join(left, right, ["k"], F.xxhash64("id")).collect())
    assert got == [(i, k, 2 * k) for i in range(500) if (k := 0 if i % 3 == 0 else i) < 400]


def test_tables_of_a_scratch_are_removed(spark):
    with store.scratch(spark) as own:
        gone = store.new_path(spark, "gone")
        spark.range(3).write.parquet(gone)
        kept = own.keep(spark.read.parquet(gone))
    assert kept.count() == 3 and not Path(gone.removeprefix("file://")).exists()
