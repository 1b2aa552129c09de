"""Repeated passages, conversation repair and the Merkle manifest against plain versions, with odd rows."""

import hashlib
import random
import re
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from innkeep.llm import merkle, q_repair, q_suffixes, repair, store, suffixes


def plain_repeats(docs: list[tuple], length: int) -> list[tuple]:
    """(id, kept bytes, spans) of each row, from all strings."""
    least: dict[bytes, float] = {}
    order = lambda i: float("inf") if i is None else i
    raw = [(i, (t or "").encode()) for i, t in docs]
    for i, b in raw:
        for o in range(len(b) - length + 1):
            least[b[o : o + length]] = min(least.get(b[o : o + length], float("inf")), order(i))
    out = []
    for i, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for o in range(len(b) - length + 1):
            if least[b[o : o + length]] < order(i):
                gone[o : o + length] = True
        edges = np.flatnonzero(np.diff(np.append(False, gone).astype(int)))
        out.append((i, bytes(x for x, g in zip(b, gone, strict=False) if not g), list(zip(edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist(), strict=True))))
    return out


def found_repeats(spark, docs, length, **sizes):
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("id", F.lit("extra")).withColumn("shard", F.lit("extra")).repartition(3)
    rows = suffixes.without_repeats(df, "doc_id", "text", length, **sizes).collect()
    assert all(r["n_bytes"] == len(bytes(r["kept"])) + sum(s["length"] for s in r["spans"]) for r in rows)
    return [(r["id"], bytes(r["kept"]), [(s["start"], s["length"]) for s in r["spans"]]) for r in rows]


@pytest.mark.parametrize("seed,length,sizes", [(0, 50, {}), (1, 50, {"shard_bytes": 3000, "range_bytes": 4000, "hot_shards": 1}), (2, 9, {"shard_bytes": 500, "range_bytes": 1 << 30, "hot_shards": 0, "part_bytes": 200}), (4, 30, {"part_bytes": 300}), (3, 24, {"shard_bytes": 1, "range_bytes": 100, "hot_shards": 3})])
def test_repeats_against_all_strings(spark, monkeypatch, seed, length, sizes):
    monkeypatch.setattr(suffixes, "BROADCAST_ROWS", suffixes.BROADCAST_ROWS if seed % 2 else 0)
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeéß字\0", k=rng.randint(1, 7))) for _ in range(60)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    passages = [prose(30) for _ in range(4)] + ["ab" * 60, "x" * 130]
    docs: list[tuple] = []
    for i in range(90):
        parts = [prose(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            parts += [p[rng.randint(0, 9) : len(p) - rng.randint(0, 30)], prose(rng.randint(0, 9))]
        docs.append((rng.choice([i, i, 1000 - i]), "".join(parts)))
    docs += [(5000 + i, docs[3][1]) for i in range(20)] + [(7, None), (8, ""), (None, docs[4][1]), (None, passages[0]), (None, passages[0]), docs[5], (docs[5][0], passages[1]), (-3, passages[2])]
    want = plain_repeats(docs, length)
    assert sum(len(s) for *_, s in want) > 40
    assert sorted(found_repeats(spark, docs, length, **sizes), key=repr) == sorted(want, key=repr)


def test_repeats_of_very_long_and_no_texts(spark):
    rng = random.Random(5)
    long = "".join(rng.choices("abcdefgh ", k=600_000))
    docs = [(2, long), (1, long[200_000:200_300] + "!" + long[500_000:500_049]), (3, "z" * 5000), (4, "z" * 51), (5, long[:49])]
    got = {i: (len(k), s) for i, k, s in found_repeats(spark, docs, 50, shard_bytes=1 << 16, part_bytes=1 << 14)}
    assert got[2] == (599_700, [(200_000, 300)]) and got[4] == (0, [(0, 51)]) and got[5] == (49, []) and got[1][1] == got[3][1] == []
    assert found_repeats(spark, [(1, "none")], 50) == [(1, b"none", [])]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.without_repeats(empty, "doc_id", "text", 50).count() == 0


@pytest.mark.parametrize("text", ["a" * 300, "abracadabra" * 40, "".join(random.Random(7).choices("ab", k=700)), "x", "\0" * 200, "".join(random.Random(8).choices("a\0", k=700)) + "\0" * 70])
def test_suffix_arrays_and_prefixes(text):
    data = np.frombuffer(text.encode(), np.uint8)
    sa, depth = suffixes.suffix_array(data, 50)
    assert depth == 56 and sorted(sa.tolist()) == list(range(len(text)))
    assert sa.tolist() == sorted(range(len(text)), key=lambda i: (text[i : i + depth], i))
    shared = [0] + [next((k for k in range(depth) if i + k >= len(text) or j + k >= len(text) or text[i + k] != text[j + k]), depth) for i, j in zip(sa[:-1].tolist(), sa[1:].tolist(), strict=True)]
    assert suffixes.common_prefixes(data, sa, depth, stretch=13).tolist() == shared


def test_equal_hashes_of_different_strings():
    """Strings are told apart by their bytes even if all hashes are equal."""
    real, suffixes.hashes = suffixes.hashes, lambda data, width: np.zeros(max(0, len(data) - width + 1), np.uint64)
    try:
        part = lambda doc, text: (0, doc, 32, suffixes._packed(np.array([doc]), np.array([len(text) - 3])), len(text), suffixes.pa.compress(text, codec="zstd", asbytes=True))
        rows = [(doc, doc, suffixes._packed_size([0], [0]), part(doc, t)[3], len(t), part(doc, t)[5]) for doc, t in ((9, b"abcdef"), (3, b"xbcdez"), (5, b"abcd"))]
        got = {shard: np.unpackbits(np.frombuffer(m, np.uint8)).tolist()[:3] for shard, _, m in suffixes._merged(rows, 4)}
    finally:
        suffixes.hashes = real
    assert got == {9: [1, 1, 0], 3: [0, 0, 0], 5: [0, 0, 0]}


def test_a_shard_sends_a_row_per_range():
    """However many parts its text is sorted in: rows grow with shards and ranges only."""
    text = "".join(random.Random(9).choices("abcdefgh", k=20_000)).encode()
    shard = suffixes._Shard([4], [len(text)], len(text), suffixes._SHARD_CODEC.compress(text, asbytes=True), 50, 24, 40)
    grams, _ = shard.grams()
    every = np.packbits(np.ones(len(grams), bool)).tobytes() + np.packbits(np.zeros(len(grams), bool)).tobytes()
    rows = list(suffixes._suspects(shard, 0, [(0, len(grams), every)], 50, 40, 40, 1 << 9))
    assert [r[0] for r in rows] == [-1, 0, 1]
    assert sum(r[5] for r in rows) > 20_000


_KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_NEXT = {0: 2, 1: 2, 2: 3, 3: 2}


def plain_repair(rows: list[tuple]) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, hash) of one conversation's rows (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    digest = lambda r, x: hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).hexdigest()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1], r[2])))
    seen, fault = set(), []
    for _, r, x in rows:
        ink = re.sub(r"[\x20\x09-\x0D]+\Z", "", x)
        fault.append("blank" if not ink else "duplicate" if (r, x) in seen else "truncated" if ink[-1] not in ".!?" else "")
        seen.add((r, x))

    @cache
    def best(i: int, s: int, put: int = 0) -> tuple:
        ways = []
        if i == len(rows) and s in (0, 3):
            ways.append((0, "", ()))
        if put < 3:
            c, a, k = best(i, _NEXT[s], put + 1)
            ways.append((2 + c, "I" + a, ("assistant:" if s == 2 else "user:", *k)))
        if i < len(rows):
            _, r, x = rows[i]
            c, a, k = best(i + 1, s)
            ways.append((3 + c, "D" + a, k))
            if fault[i] in ("", "truncated"):
                more = fault[i] == "truncated"
                if (s, r[:1]) in _KEEP:
                    c, a, k = best(i + 1, _KEEP[s, r[:1]])
                    ways.append((c + more, "K" + a, (f"{r}:{x}", *k)))
                c, a, k = best(i + 1, _NEXT[s])
                ways.append((2 + c + more, "R" + a, (("assistant:" if s == 2 else "user:") + x, *k)))
        return min(ways, default=(10**9, "", ()))

    cost, audit, kept = best(0, 0)
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows[:-1], rows[1:], strict=True))
    return gaps, fault.count("blank"), fault.count("duplicate"), fault.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()


@pytest.mark.parametrize("chunk", [1024, 3])
def test_repair_against_all_edits(spark, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    rng = random.Random(chunk)
    rows = []
    for c in [None, *range(60)]:
        for t in range(rng.choice([1, 2, 3, 5, 9, 17])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "sys", "usurper", "tool", "", None, "é"])
            text = rng.choice(["Fine.", "Cut short", "Why? ", " \t\r\n\x0b\x0c", "", None, " ", "no end ", f"Number {rng.randint(0, 3)}!", "a.\n\n"])
            rows.append((c, rng.choice([t, t, t, t + 5, None]), role, text))
    rows += rows[:9]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("key", F.lit("extra")).withColumn("at", F.lit(1)).repartition(3)
    facts = repair.facts(df, "conv_id", "turn", "role", "text")
    edits = store.cut(repair.edits(facts), "edits")
    got = {r["conv"]: tuple(r)[2:] for r in repair.report(facts, edits).collect()}
    by: dict = {}
    for c, *r in rows:
        by.setdefault(c, []).append(tuple(r))
    assert got == {c: plain_repair(r) for c, r in by.items()}
    listed: dict = {}
    for r in sorted(repair.repaired(facts, edits).collect(), key=lambda r: (r["key"], r["step"])):
        listed.setdefault(r["key"], []).append(r)
    for c, want in got.items():
        steps = listed["0" if c is None else f"1{c}"]
        assert "".join(r["edit"] for r in steps) == want[6] and [r["step"] for r in steps] == list(range(len(steps)))
        kept = "\n".join(f"{r['role']}:{r['text']}" for r in steps if r["edit"] != "D")
        assert hashlib.sha256(kept.encode()).hexdigest() == want[7] and re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in steps if r["edit"] != "D"))


def test_repair_of_nothing_and_of_one_long_text(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    facts = repair.facts(empty, "conv_id", "turn", "role", "text")
    assert repair.report(facts, repair.edits(facts)).count() == 0 and repair.repaired(facts, repair.edits(facts)).count() == 0
    facts = repair.facts(spark.createDataFrame([("c", 1, "user", "x" * 1_000_000)], "conv_id string, turn int, role string, text string"), "conv_id", "turn", "role", "text")
    (r,) = repair.report(facts, repair.edits(facts)).collect()
    assert (r["conv"], r["cost"], r["audit"]) == ("c", 3, "D")


def test_damage(spark):
    rows = [(c, t, r, x) for c in (1, 2, None) for t in (*range(40), None) for r, x in (("user", "A. B! C?"), (None, None))]
    got = q_repair.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    import zlib

    want = []
    for c, t, r, x in rows:
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        one = (c, t, "user" if d == 4 else r, "" if d == 1 else re.sub("[.!?]", "", x) if d == 2 else x)
        want += [one] * (0 if d == 0 else 2 if d == 3 else 1)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def _h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(leaves: dict, fanout: int) -> tuple:
    """(subroots, root, proof siblings by group and place) of {group: [digests]}."""
    def tree(nodes):
        paths, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            up, under = [], []
            for s in range(0, len(nodes), fanout):
                run = nodes[s : s + fanout]
                for k, own in enumerate(below[s : s + fanout]):
                    for i in own:
                        paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
                up.append(_h(*run))
                under.append([i for own in below[s : s + fanout] for i in own])
            nodes, below = up, under
        return nodes[0], paths

    groups = sorted(leaves, key=lambda g: (g is not None, (g or "").encode()))
    each = {g: tree(leaves[g]) for g in groups}
    root, upper = tree([each[g][0] for g in groups])
    return {g: each[g][0] for g in groups}, root, {g: [p + upper[k] for p in each[g][1]] for k, g in enumerate(groups)}


@pytest.mark.parametrize("fanout,block", [(2, 256), (2, 4), (3, 4)])
def test_manifest_against_plain_trees(spark, monkeypatch, fanout, block):
    monkeypatch.setattr(merkle, "BLOCK", block)
    rng = random.Random(fanout)
    docs = [(i, rng.choice(["text", "", None, "é字", "-", "x" * 3000]), rng.choice(["en"] * 9 + ["é", "z", "", None, "-"]), i % 3 or None) for i in range(90)]
    docs += [docs[5], (docs[7][0], "other", docs[7][2], 1), (None, "t", "en", None), (200, "one", "alone", 1), (-5, "neg", "en", 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, n long").withColumn("key", F.lit("extra")).withColumn("at", F.lit(0)).repartition(3)
    cols = [F.col("doc_id"), F.col("lang"), F.col("text"), F.col("n")]
    rows = merkle.manifest(df, "doc_id", "lang", cols, [*cols[:3], F.col("n") + 1], fanout)
    got = rows.select("id", "key", "leaf", "tampered", "subroot", "root", merkle.folded(F.col("leaf"), F.col("path")).alias("same"), merkle.folded(F.col("tampered"), F.col("path")).alias("folded"), merkle.proof(F.col("path")).alias("proof")).collect()
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda d, more=0: _h(*[part(v) for v in (d[0], d[2], d[1], d[3] if d[3] is None else d[3] + more)])
    by: dict = {}
    for d in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, leaf(d))):
        by.setdefault(d[2], []).append(d)
    subroots, root, paths = plain_manifest({g: [leaf(d) for d in ds] for g, ds in by.items()}, fanout)
    want = []
    for g, ds in by.items():
        for d, path in zip(ds, paths[g], strict=True):
            bad = leaf(d, 1)
            for a, b in path:
                bad = _h(a, bad, b)
            want.append((d[0], "0" if g is None else "1" + g, leaf(d), leaf(d, 1), subroots[g], root, root, bad, _h(*[a + b for a, b in path])))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert all((r["folded"] == root) == (r["leaf"] == r["tampered"]) for r in got)


def test_manifest_of_few_rows(spark):
    one = spark.createDataFrame([(1, None)], "doc_id long, lang string")
    (r,) = merkle.manifest(one, "doc_id", "lang", [F.col("doc_id")]).select("leaf", "subroot", "root", merkle.proof(F.col("path")).alias("p")).collect()
    assert r["leaf"] == r["subroot"] == r["root"] == _h("1:1") and r["p"] == _h("")
    assert merkle.manifest(one.where("1 = 0"), "doc_id", "lang", [F.col("doc_id")]).count() == 0
    with pytest.raises(ValueError):
        merkle.manifest(one, "doc_id", "lang", [F.col("doc_id")], fanout=1)
