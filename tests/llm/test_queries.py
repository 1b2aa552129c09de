"""The registered queries and the pipeline on the driver's small tables, against SQL or plain versions."""

import base64
import hashlib
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from innkeep.llm import components, mixing, neardup, packing, q_urls, queries, sharding, skew, warc
from innkeep.sources import shared
from plain import links_of, norm, shingles, url_templates

TINY, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(SMALL).is_dir(), reason="no driver tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_against_sql(spark, name):
    df = queries.QUERIES[name](spark, TINY)
    cols = sorted(df.columns)
    con = duckdb.connect()
    for p in Path(TINY).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    want = con.execute(queries.ORACLE[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == cols
    got = sorted(repr([norm(v) for v in r]) for r in df.select(*cols).collect())
    assert got == sorted(repr([norm(r[names.index(c)]) for c in cols]) for r in want.fetchall())


def test_language_accuracy_on_held_out_rows(spark):
    found = queries.QUERIES["op2_language_id"](spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    rows = found.join(docs, "doc_id").collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all((r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) for r in rows)
    judged = [r["lang_pred"] == r["lang"] for r in rows if r["held_out"] and r["lang"] and r["lang_pred"] != "und"]
    assert len(judged) > 100 and np.mean(judged) >= 0.9


def test_nearest_recall(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r["vec_id"] for r in rows if r["embedding"]])
    x = np.array([r["embedding"] for r in rows if r["embedding"]], np.float64)
    got = defaultdict(list)
    for r in queries.QUERIES["op4_nn_descent"](spark, SMALL).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = total = 0
    for q in ids[ids % 100 == 0].tolist():
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        at = [i for i in np.lexsort((ids, d)).tolist() if ids[i] != q][:10]
        assert [round(s, 9) for v, s in got[q]] == [round(float(d[ids == v][0]), 9) for v, s in got[q]] and len(got[q]) == 10
        hits += len({v for v, _ in got[q]} & set(ids[at].tolist()))
        total += 10
    assert hits / total >= 0.9


def test_packing_round_trip(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.QUERIES["op5_packing"](spark, SMALL).collect()
    tokenizer, pieces, bins = Tokenizer.from_file(packing.default_tokenizer()), defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    tokens = 0
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        tokens += len(ids)
        own = sorted(pieces[doc], key=lambda r: r["piece"])
        assert [r["start"] for r in own] == list(range(0, len(ids), 2048))
        assert [(r["length"], r["ids_crc32"]) for r in own] == [(len(p), zlib.crc32(p.tobytes())) for p in (ids[r["start"] : r["start"] + 2048] for r in own)]
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= 1.02 * -(-tokens // 2048) + 1


def test_shards_are_nearly_equal(spark):
    rows = queries.QUERIES["op6_sharding"](spark, SMALL).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    held, slots, groups = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        held[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        groups[texts[r["doc_id"]]].add(r["shard"])
    assert set(held) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(held.values()) / 24
    assert max(abs(b - mean) for b in held.values()) <= 0.01 * mean
    assert all(len(s) == 1 for s in groups.values())  # none is larger than a shard's share
    # what is not placed by itself goes by splitters
    sizes = Counter()
    for t in texts.values():
        sizes[t] += len((t or "").encode()) + 8
    assert sum(s for s in sizes.values() if s <= sharding.SINGLE_SHARE * mean) > 0.5 * sum(sizes.values())


def test_url_query_against_plain_trees(spark):
    pages, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("pages", "labels"))
    labelled = [tuple(r) for r in spark.sql(q_urls.LABELLED, pages=pages, labels=labels).collect()]
    want = url_templates({r["page_id"]: r["url"] for r in pages.collect()}, labelled)
    rows = queries.QUERIES["op7_url_tree"](spark, SMALL).collect()
    assert len(rows) == len(want) and len({r["bad_share"] for r in rows}) < len({(r["host"], r["template"]) for r in rows})
    for r in rows:
        host, path, template, share = want[r["page_id"]]
        fits = [(v, h, p) for v, h, p in q_urls.RULES if ("." + host).endswith("." + h) and path.startswith(p)]
        rule = max(fits, key=lambda x: len(x[1] + x[2]), default=None)
        assert (r["host"], r["path"], r["template"]) == (host, path, template) and abs(r["bad_share"] - share) < 1e-6
        assert (r["rule"], r["verdict"]) == ((rule[1] + rule[2], rule[0]) if rule else (None, "block" if share > 0.5 else "allow"))


def test_archive_edges(spark):
    pages = [(1, "http://a/", "x" * 70_000), (2, None, "x" * 70_000), (3, "http://b/", None), (4, "http://b/", ""), (4, "http://b/", ""), (None, "c", "é\r\n"), (5, "d", "WARC/1.1\r\n\r\n")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("extra"))
    path = corpus_pipeline.store.new_path(spark, "warc")
    warc.write_archive(warc.plan_records(df, "page_id", "url", "html"), path)
    rows = warc.read_archive(spark, path).collect()
    assert len(rows) == len(pages) and {r["status"] for r in rows} == {"ok"}
    answers = {r["record_id"]: r for r in rows if r["record_type"] == "response"}
    for r in rows:
        payload = bytes((answers[r["refers_to"]] if r["record_type"] == "revisit" else r)["payload"])
        assert r["digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (r["row_id"], payload) in {(i, (t or "").encode()) for i, _, t in pages}
    assert Counter(r["record_type"] for r in rows) == {"response": 4, "revisit": 3}
    assert {r["row_id"] for r in answers.values()} == {2, 4, None, 5}
    empty = corpus_pipeline.store.new_path(spark, "warc")
    warc.write_archive(warc.plan_records(df.where("1 = 0"), "page_id", "url", "html"), empty)
    assert warc.read_archive(spark, empty).count() == 0


def test_damaged_archives(spark, tmp_path):
    whole = list(warc.record_bytes(1, "http://a/", b"x" * 5000, "D", "<urn:uuid:1>", None, 1000, 300))
    other = list(warc.record_bytes(2, "http://b/", b"y" * 5000, "E", "<urn:uuid:2>", None, 1000, 300))
    small = list(warc.record_bytes(3, "http://c/", b"fine", "F", "<urn:uuid:3>", None, 1000, 300))
    longer = [*other[:-1], other[-1].replace(b"Total-Length: ", b"Total-Length: 1")]
    files = {
        "lost": [*small, *whole[:2], *whole[3:]], "cut": [*small, b"".join(whole)[:-700]], "longer": longer, "junk": [*small, b"junk", *whole], "frame": [small[0].replace(b"4\r\nfine", b"9\r\nfine")],
        "twice": [*whole, *whole], "none": [], "split-1": whole[:3], "split-2": whole[3:],
    }
    got = {}
    for name, parts in files.items():
        folder = tmp_path / name.split("-")[0]
        folder.mkdir(exist_ok=True)
        (folder / f"{name}.warc").write_bytes(b"".join(parts))
        got[folder.name] = sorted((r["row_id"] or 0, r["status"], len(r["payload"] or b"")) for r in warc.read_archive(spark, str(folder)).collect())
    assert got["lost"] == [(1, "segments missing", 0), (3, "ok", 4)] and got["longer"] == [(2, "wrong total length", 0)]
    assert got["cut"] == [(0, "truncated", 0), (1, "no total length", 0), (3, "ok", 4)] and got["junk"] == [(0, "not a record", 0), (3, "ok", 4)]
    assert got["frame"] == [(3, "bad chunk framing", 0)] and got["none"] == []
    assert got["twice"] == got["split"] == [(1, "ok", 5000)]


def test_revisits_when_every_job_lays_out_its_scan_anew(spark, monkeypatch, tmp_path):
    """The registered query over pages with copies, repeated ids and files that are split differently from job to job."""
    rows = [(i % 550, "http://a/", None if i % 11 == 0 else f"page {i % 97} " * 50) for i in range(600)]
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7).write.parquet(f"{tmp_path}/pages.parquet")
    key, real, jobs = "spark.sql.files.minPartitionNum", corpus_pipeline.store.shared_dir, iter(range(10_000))

    def anew(session):
        n = next(jobs)
        session.conf.set(key, str([1, 13, 2, 29, 5][n % 5]))
        session.conf.set("spark.sql.files.maxPartitionBytes", str([1 << 27, 3000, 9000][n % 3]))
        return real(session)

    monkeypatch.setattr(shared, "shared_dir", anew)
    try:
        got = queries.QUERIES["op1_warc"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset(key)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 600 and next(jobs) > 4
    by = defaultdict(list)
    for i, _, html in rows:
        by[(html or "").encode()].append(i)
    want = Counter()
    for payload, ids in by.items():
        for k, i in enumerate(sorted(ids, reverse=True)):
            want[i, len(payload), "revisit" if k else "response", max(ids) if k else None] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got) == want
    con = duckdb.connect()
    unique = {r[0]: r for r in rows}
    con.register("pages", pa.table({"page_id": list(unique), "html": [r[2] for r in unique.values()]}))
    spark.createDataFrame(list(unique.values()), "page_id long, url string, html string").write.parquet(f"{tmp_path}/u/pages.parquet")
    sql = con.execute(queries.ORACLE["op1_warc"])
    names = [c[0] for c in sql.description]
    assert sorted(map(repr, map(tuple, queries.QUERIES["op1_warc"](spark, f"{tmp_path}/u").select(*names).collect()))) == sorted(map(repr, sql.fetchall()))


def test_a_revisit_without_its_response_fails(spark):
    rows = spark.createDataFrame([("a", "revisit", 1, "gone", 0, "D")], "record_id string, record_type string, row_id long, refers_to string, payload_bytes long, payload_digest string")
    with pytest.raises(Exception, match="revisit without a response: a"):
        warc.resolve_revisits(corpus_pipeline.store.cut(rows, "read")).collect()


def test_revisits_of_a_hot_response(spark, monkeypatch):
    monkeypatch.setattr(skew, "KEY_ROWS", 7)
    pages = spark.createDataFrame([(i, "http://a/", "same" if i % 3 else f"own {i}") for i in range(90)], "page_id long, url string, html string").repartition(3)
    path = corpus_pipeline.store.new_path(spark, "warc")
    warc.write_archive(warc.plan_records(pages, "page_id", "url", "html", min_dedup_bytes=5), f"{path}-long")
    assert {r["record_type"] for r in warc.read_archive(spark, f"{path}-long").collect()} == {"response"}
    warc.write_archive(warc.plan_records(pages, "page_id", "url", "html"), path)
    read = warc.read_archive(spark, path).select("record_id", "record_type", "row_id", "refers_to", F.octet_length("payload").alias("payload_bytes"), F.col("digest").alias("payload_digest"))
    got = {r["row_id"]: (r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.resolve_revisits(corpus_pipeline.store.cut(read, "read")).collect()}
    assert got == {i: ("response", None, len(f"own {i}")) if i % 3 == 0 else ("response", None, 4) if i == 89 else ("revisit", 89, 4) for i in range(90)}


@pytest.mark.parametrize(("small_family", "n"), [(400, 5), (3, 5), (3, 2)])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, small_family, n):
    monkeypatch.setattr(neardup, "SMALL_FAMILY", small_family)
    rng = np.random.default_rng(n)
    texts: list[str | None] = [None, "", "One", "one"]
    for _ in range(12):
        words = [f"w{k}" for k in rng.integers(0, 400, 120)]
        for _ in range(8):
            other = list(words)
            for at in rng.integers(0, 120, rng.integers(0, 8)):
                other[at] = f"v{rng.integers(0, 10_000)}"
            texts.append(" ".join(other))
    rows = list(enumerate(texts, 10))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs, "doc_id", "text", n).collect()}
    sets = {i: shingles(t, n) for i, t in rows}
    want = links_of(sets, 80, 100)
    assert got == {i: (len(sets[i]), want[i], want[i] == i) for i, _ in rows}


def test_documents_that_share_a_passage_against_all_pairs(spark, monkeypatch):
    """One family that is torn into very many components, some of them of several documents."""
    monkeypatch.setattr(neardup, "SMALL_FAMILY", 20)
    rng = np.random.default_rng(11)
    passage, texts = [f"p{k}" for k in range(60)], []
    for k in range(120):
        own = [f"o{x}" for x in rng.integers(0, 100_000, 30)]
        for _ in range(1 if k % 3 else 4):
            words = passage + own
            for at in rng.integers(0, 90, rng.integers(0, 4)):
                words[at] = f"v{rng.integers(0, 100_000)}"
            texts.append(" ".join(words))
    rows = list(enumerate(texts))
    got = {r["id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "doc_id", "text", 2).collect()}
    assert got == links_of({i: shingles(t, 2) for i, t in rows}, 80, 100) and len(set(got.values())) >= 120


def test_components_by_star_steps(spark, monkeypatch):
    monkeypatch.setattr(components, "CHUNK", 10)
    rng = np.random.default_rng(8)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(400 + i, 401 + i) for i in range(60)]
    edges = spark.createDataFrame(pairs, "a long, b long").repartition(4)
    nodes = sorted({x for p in pairs for x in p})
    place = {x: i for i, x in enumerate(nodes)}
    root = components.roots(len(nodes), np.array([place[a] for a, _ in pairs]), np.array([place[b] for _, b in pairs]))
    assert {r["node"]: r["component"] for r in components.components(edges, "a", "b").collect()} == {x: nodes[root[place[x]]] for x in nodes}
    assert components.components(edges.where("1 = 0"), "a", "b").count() == 0


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    columns = docs.columns
    one = corpus_pipeline.store.cut(corpus_pipeline.language_id(spark, docs, TINY), "t1")
    whole, kept = {r["doc_id"]: r["text"] for r in docs.collect()}, {r["doc_id"]: r["text"] for r in one.collect()}
    assert one.columns == columns and set(kept) <= set(whole)
    assert len(kept) >= 0.95 * sum(any(c.isalpha() for c in t or "") for t in whole.values()) and all(any(c.isalpha() for c in t) for t in kept.values())
    two = corpus_pipeline.store.cut(corpus_pipeline.near_dedup(spark, one, TINY), "t2")
    component = links_of({i: shingles(t, 5) for i, t in kept.items()}, 80, 100)
    assert two.columns == columns and sorted(r["doc_id"] for r in two.collect()) == sorted(set(component.values()))
    three = corpus_pipeline.store.cut(corpus_pipeline.mix_sources(spark, two, TINY), "t3")
    times = Counter(r["doc_id"] for r in three.collect())
    rate = {r["k"]: r["rate"] for r in mixing.plan(two, "doc_id", "source", mixing.word_count(F.col("text")))[1].collect()}
    for r in two.collect():
        want = rate["n" if r["source"] is None else "s" + r["source"]]
        assert times[r["doc_id"]] in (int(want), int(want) + (want > int(want)))
    four = corpus_pipeline.pack(spark, three, TINY).collect()
    tokenizer, used = Tokenizer.from_file(packing.default_tokenizer()), Counter()
    for r in four:
        used[r["doc_id"]] += r["length"]
    assert three.columns == columns and used == {i: n * (len(tokenizer.encode(kept[i], add_special_tokens=False).ids) + 1) for i, n in times.items()}
    empty = docs.where("1 = 0")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, TINY).count() == 0


def test_pipeline_stages_with_nulls_repeats_and_extra_columns(spark):
    base = spark.read.parquet(f"{TINY}/documents.parquet").limit(60)
    odd = [(None, "one two three four five six", "en", None, 1), (None, None, None, None, None), (-7, "", None, "a", 0), (-7, None, "en", "a", 0), (10**6, "12 34", None, None, 5), (10**6 + 1, "word " * 60_000, None, "b", 300_000)]
    docs = base.unionByName(base.limit(5)).unionByName(spark.createDataFrame(odd, base.schema))
    for c in ("_lang", "_share", "_spans", "id", "k", "rate", "kept_id"):
        docs = docs.withColumn(c, F.lit("extra"))
    docs = corpus_pipeline.store.cut(docs, "odd")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, docs, TINY)
        assert rows.columns == docs.columns and all(r["_lang"] == r["id"] == r["kept_id"] == "extra" for r in rows.collect())
        docs = corpus_pipeline.store.cut(rows, "odd")
    ids = [r["doc_id"] for r in docs.select("doc_id").distinct().collect()]
    assert 10**6 + 1 in ids and 10**6 not in ids and -7 not in ids
    assert {r["doc_id"] for r in corpus_pipeline.pack(spark, docs, TINY).collect()} == set(ids)
