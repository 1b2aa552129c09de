"""Counts taken while rows are written, embeddings that are kept, a service that fails, stages that are reused."""

import json
from dataclasses import replace

import pytest

from innkeep.operators import embed, summary
from innkeep.plans import run as plan
from innkeep.sources import hotels as src
from innkeep.sources import tables
from test_engine import files  # noqa: F401


def counting(note, bad=()):
    """A factory whose embedder gives a text's length and notes what it was asked for."""

    def factory():
        def f(texts):
            with open(note, "a") as out:
                out.writelines(f"{t}\n" for t in texts)
            if any(t in bad for t in texts):
                raise ValueError("too odd")
            return [[float(len(t)), 1.0] for t in texts]

        return f

    return factory


def said(path):
    return sorted(path.read_text().split()) if path.exists() else []


def test_embeddings_are_kept(spark, tmp_path):
    df = lambda *t: spark.createDataFrame([(x,) for x in t], "text_for_embedding string")
    note, cache = tmp_path / "note", embed.Cache(f"{tmp_path}/cache", "m1")
    run = lambda rows, c=cache, bad=(): {r["text_for_embedding"]: (r["embedding"], r["embedding_error"]) for r in embed.embed(rows, counting(str(note), bad), 2, batch=1, cache=c).collect()}
    assert run(df("a", "bb", "a")) == {"a": ([1.0, 1.0], None), "bb": ([2.0, 1.0], None)} and said(note) == ["a", "bb"]
    assert run(df("bb", "ccc"), bad=["ccc"]) == {"bb": ([2.0, 1.0], None), "ccc": ([0.0, 0.0], "ValueError: too odd")} and said(note) == ["a", "bb", "ccc"]
    assert run(df("ccc"))["ccc"] == ([3.0, 1.0], None) and said(note) == ["a", "bb", "ccc", "ccc"]
    assert run(df("a"), embed.Cache(cache.path, "m2"))["a"][0] == [1.0, 1.0] and said(note).count("a") == 2
    cache.compact(spark)
    assert cache.read(spark).count() == 4 and cache._generations(spark) == [1]
    assert len(run(df("a", "bb", "ccc"))) == 3 and len(said(note)) == 5
    assert run(df()) == {}


def test_errors_of_the_code_end_the_run(spark):
    def broken():
        return lambda texts: texts.nothing  # no such attribute

    df = spark.createDataFrame([("a",)], "text_for_embedding string")
    with pytest.raises(Exception, match="AttributeError"):
        embed.embed(df, broken, 2).collect()
    assert [r["embedding_error"] for r in embed.embed(df, lambda: lambda texts: [[1.0]], 2).collect()] == ["ValueError: 1 vectors of 2 numbers were expected"]


class Flaky:
    """A service that fails some times in a row, and a clock that only sleeping moves."""

    def __init__(self, fails, error=ConnectionError):
        self.fails, self.error, self.now, self.calls = fails, error, 0.0, []

    def __call__(self, texts):
        self.calls.append(round(self.now, 3))
        if len(self.calls) <= self.fails:
            raise self.error("busy")
        return [[1.0] for _ in texts]

    def sleep(self, seconds):
        self.now += seconds


def test_a_service_that_fails():
    ask = lambda f, **kw: embed.RemoteEmbedder(f, clock=lambda: f.now, sleep=f.sleep, **kw)
    f = Flaky(3)
    assert ask(f, pause=1.0)(["a", "b"]) == [[1.0], [1.0]] and f.calls == [0, 1, 3, 7]
    f = Flaky(9)
    with pytest.raises(embed.RemoteError, match="3 attempts: ConnectionError: busy"):
        ask(f, retries=2, pause=8.0, longest=10.0)(["a"])
    assert f.calls == [0, 8, 18]
    f = Flaky(1, KeyError)
    with pytest.raises(KeyError):
        ask(f)(["a"])
    f = Flaky(0)
    paced = ask(f, rate=2.0, burst=3)
    for _ in range(6):
        paced(["a"])
    assert f.calls == [0, 0, 0, 0.5, 1.0, 1.5]


def test_load_counts_in_the_passes_that_write(spark, files, monkeypatch):  # noqa: F811
    cat = src.load_catalog(spark, str(files / "hb.json"), src.HOTELBEDS)
    want = cat.stats().first().asDict()
    monkeypatch.setattr(src.Catalog, "stats", None)
    written = []
    real = plan._keep
    monkeypatch.setattr(plan, "_keep", lambda df, cfg, name: written.append(name) or real(df, cfg, name))
    spark.sparkContext.setJobGroup("counted", "load")
    try:
        counts = plan.load(spark, plan.Config(str(files / "hb.json"), str(files / "ad.json"), str(files / "counted")))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts["hotelbeds"] == want and len(written) == 4
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    spark.sparkContext.setJobGroup("again", "load")
    try:
        monkeypatch.setattr(plan, "_observed", lambda df, counts: (df, type("N", (), {"get": dict.fromkeys(counts, 0)})()))
        plan.load(spark, plan.Config(str(files / "hb.json"), str(files / "ad.json"), str(files / "counted2")))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("again")) == jobs  # counting takes no job of its own


def test_stages_are_reused(spark, files, tmp_path):  # noqa: F811
    cfg = plan.Config(str(files / "hb.json"), str(files / "ad.json"), str(tmp_path / "out"), str(files / "types.json"), "validated", 0.4, reuse=True)
    first = plan.run(spark, cfg)
    assert first["steps"] == ["load", "enrich", "normalize", "embed", "match"]
    again = plan.run(spark, cfg)
    assert again["steps"] == [f"{s}_reused" for s in first["steps"]] and again["summary"] == first["summary"] and again["total_hotels"] == first["total_hotels"]
    assert plan.run(spark, replace(cfg, threshold=0.5))["steps"] == ["load_reused", "enrich_reused", "normalize_reused", "embed_reused", "match"]
    types = json.loads((files / "types.json").read_text())
    (files / "types.json").write_text(json.dumps([*types, {"code": "N", "codeDescription": "New", "type": "t", "occupancies": []}]))
    assert plan.run(spark, cfg)["steps"] == ["load_reused", "enrich", "normalize", "embed", "match"]
    env = tables.load_embeddings(spark, *[f"{cfg.output_dir}/{k}_embeddings_{p}" for p in ("hotelbeds", "axisdata") for k in ("hotel", "room")])
    assert {r["room_id"] for r in env["axisdata"][1].collect()} == {"8", "9"}


def test_medians_of_several_columns(spark):
    df = spark.createDataFrame([(0.1, 3.0, None), (0.5, -2.0, None), (0.2, None, None), (None, 7.0, None)], "a double, b double, c double")
    assert summary.exact_medians(df, {"x": "a", "y": "b", "z": "c"}).first().asDict() == {"x": 0.2, "y": 3.0, "z": 0.0}
