"""The catalog pipeline and its command line.

Stages: load and validate, enrich, normalize, embed, match, report. Each reads what the stages before it wrote below the
output folder and writes its own tables there, so a stage also runs alone (``--stage``). Enrichment is optional and never
stops the run; any other stage that fails ends it.
"""

from __future__ import annotations

import argparse
import hashlib
import json
import os
import sys
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from innkeep import settings
from innkeep.functions.scoring import Penalties
from innkeep.operators import embed, enrich, matching, results, summary
from innkeep.sources import hotels as src
from innkeep.sources import shared, tables

SIDES = (("hotelbeds", src.HOTELBEDS), ("axisdata", src.AXISDATA))


@dataclass
class Config:
    hotelbeds: str
    axisdata: str
    output_dir: str
    catalog: str | None = None
    method: str = "plain"  # or "validated": described texts, penalties
    threshold: float | None = None
    embedder: Callable = embed.HashEmbedder
    dimensions: int = 256
    penalties: Penalties = field(default_factory=Penalties)
    strict: bool = False
    lines: bool = False
    skip_enrichment: bool = False
    skip_embeddings: bool = False
    skip_normalization: bool = False
    document: bool = True  # also write results as JSON documents with metadata
    model: str | None = None  # the embedder's name in the cache and in exports; by default that of its code
    cache: bool = True  # keep embeddings for later runs
    batch_size: int = embed.BATCH
    pause: float = 0.0
    reuse: bool = False  # leave out stages whose inputs and parameters have not changed

    def path(self, name: str) -> str:
        return f"{self.output_dir}/{name}"


def _keep(df: DataFrame, cfg: Config, name: str) -> DataFrame:
    df.write.mode("overwrite").parquet(cfg.path(name))
    return df.sparkSession.read.parquet(cfg.path(name))


def _observed(df: DataFrame, counts: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """df whose rows are counted while they are written."""
    seen = Observation()
    return df.observe(seen, *[c.alias(k) for k, c in counts.items()]), seen


def _read(spark: SparkSession, cfg: Config, name: str) -> DataFrame | None:
    try:
        return spark.read.parquet(cfg.path(name))
    except AnalysisException:
        return None


def load(spark: SparkSession, cfg: Config) -> dict:
    """Validated hotels and flat rooms of both sides, their issues and counts, taken in the passes that write them."""
    counts = {}
    catalogs = src.load_all(spark, cfg.hotelbeds, cfg.axisdata, cfg.strict, cfg.lines)
    is_ = lambda level: F.count_if(F.col("level") == level)
    for name, provider in SIDES:
        cat = catalogs[name]
        issues, n_issues = _observed(cat.counted, {"errors": is_("error"), "warnings": is_("warning"), "bad_hotels": F.count_if("first")})
        tables.write_rows(issues.drop("first"), cfg.path(f"issues_{name}"))
        hotels, n_hotels = _observed(src.hotel_members(cat, provider), {"valid_hotels": F.count(F.lit(1))})
        _keep(hotels, cfg, f"hotels_{name}")
        rooms, n_rooms = _observed(src.flat_rooms(cat, provider, checked=True), {"rooms": F.count(F.lit(1)), "rooms_with_occupancy": F.count_if("occupancy_ok")})
        _keep(rooms.drop("occupancy_ok"), cfg, f"rooms_{name}")
        n = n_issues.get | n_hotels.get | n_rooms.get
        counts[name] = {"hotels": n["valid_hotels"] + n.pop("bad_hotels"), **n}
    return counts


def type_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Room types of a JSON file."""
    recs = src.read_records(spark, path)
    fields = ["code", "codeDescription", "type"]
    return enrich.catalog(recs.selectExpr("ord", *[f"try_variant_get(rec, '$.{f}', 'string') AS {f}" for f in fields], "CASE WHEN schema_of_variant(try_variant_get(rec, '$.occupancies', 'variant')) LIKE 'ARRAY%' THEN 1 END AS occupancies"))


def enrich_rooms(spark: SparkSession, cfg: Config) -> dict:
    """The first side's rooms with descriptions of the room-type catalog."""
    found = enrich.enrich(spark.read.parquet(cfg.path("rooms_hotelbeds")), type_catalog(spark, cfg.catalog), "hotel_ord")
    found, seen = _observed(found, enrich.counters())
    tables.write_rows(_keep(found, cfg, "enriched_hotelbeds"), cfg.path("enriched_hotelbeds_rows"))
    n = seen.get
    return n | {"missed": n["attempts"] - n["enriched"], "rate": 100.0 * n["enriched"] / n["attempts"] if n["attempts"] else 0.0}


def normalize(spark: SparkSession, cfg: Config) -> dict:
    """Normalized rooms and hotels of both sides, with their metadata."""
    out = {}
    for name, provider in SIDES:
        flat = _read(spark, cfg, f"enriched_{name}") if name == "hotelbeds" and cfg.catalog and not cfg.skip_enrichment else None
        flat = spark.read.parquet(cfg.path(f"rooms_{name}")) if flat is None else flat
        rooms = _keep(src.normalized_rooms(flat, provider), cfg, f"normalized_rooms_{name}")
        hotels = src.nested_hotels(rooms, spark.read.parquet(cfg.path(f"hotels_{name}")))
        tables.write_rows(hotels, cfg.path(f"normalized_{name}"))
        meta = summary.normalization_metadata(hotels).withColumn("source", F.lit(name))
        tables.write_document(meta, cfg.path(f"normalized_{name}_metadata"))
        out[name] = meta.first().asDict()
        if cfg.document:
            more = {k: v for k, v in out[name].items() if k != "total_count"}
            tables.write_document(tables.enveloped(hotels, "hotels", ["hotel_ord"], **more), cfg.path(f"normalized_{name}_document"))
    return out


def embed_rooms(spark: SparkSession, cfg: Config) -> dict:
    """Embeddings of the rooms of both sides; with ``document`` also as an envelope with metadata. Texts of earlier runs aren't embedded again."""
    out = {}
    model = cfg.model or f"{cfg.embedder.__module__}.{cfg.embedder.__qualname__}"
    cache = embed.Cache(cfg.path("embedding_cache"), model) if cfg.cache else None
    for name, _ in SIDES:
        rooms = spark.read.parquet(cfg.path(f"normalized_rooms_{name}"))
        texts = embed.described_texts(rooms, name) if cfg.method == "validated" else embed.plain_texts(rooms)
        found = embed.embed(texts.withColumn("ord", F.col("room_ord")), cfg.embedder, cfg.dimensions, cfg.batch_size, cfg.pause, cache)
        found, seen = _observed(found, {"rooms": F.count(F.lit(1)), "failed": F.count("embedding_error")})
        kept = _keep(found, cfg, f"embeddings_{name}")
        if n := seen.get["failed"]:
            settings.logger().warning("%d rooms of %s have no embedding", n, name)
        out[name] = seen.get["rooms"]
        if cfg.document:
            _export_embeddings(spark, cfg, name, kept, model)
    return out


def _export_embeddings(spark: SparkSession, cfg: Config, name: str, rooms: DataFrame, model: str) -> None:
    """Envelopes {metadata, embeddings} of a side's rooms and hotels, in the order of the input."""
    meta = {"provider": name, "model": model, "embedding_dim": cfg.dimensions}
    common = F.struct("occupancy.max_occupancy", "occupancy.max_adults", "occupancy.max_children")
    described = ["base_description", "occupancy_text"] if cfg.method == "validated" else []
    with shared.scratch(spark):
        some = F.count_if(F.greatest(*[F.col(f"occupancy.{c}").isNotNull() for c in ("max_occupancy", "max_adults", "max_children")]))
        own = rooms.select("hotel_ord", "ord", "room_id", "hotel_code", "room_code", F.lit(name).alias("provider"), "text_for_embedding", *described, common.alias("occupancy"), "embedding")
        tables.write_document(tables.enveloped(own, "embeddings", ["hotel_ord", "ord"], **meta, rooms_with_occupancy=some, includes_occupancy=bool(described)), cfg.path(f"room_embeddings_{name}"))
        hotels = spark.read.parquet(cfg.path(f"hotels_{name}"))
        texts = embed.hotel_texts(hotels, lower=cfg.method == "validated").where("text_for_embedding <> ''")
        cache = embed.Cache(cfg.path("embedding_cache"), model) if cfg.cache else None
        found = embed.embed(texts, cfg.embedder, cfg.dimensions, cfg.batch_size, cfg.pause, cache)
        own = found.select("hotel_ord", "hotel_code", "place_id", "hotel_name", F.lit(name).alias("provider"), "text_for_embedding", "embedding")
        tables.write_document(tables.enveloped(own, "embeddings", ["hotel_ord"], **meta), cfg.path(f"hotel_embeddings_{name}"))


def match(spark: SparkSession, cfg: Config) -> dict:
    """Hotel pairs with matched and unmatched rooms, from embeddings and hotels."""
    side = {name: (spark.read.parquet(cfg.path(f"hotels_{name}")).select("hotel_ord", "place_id", "hotel_code", "hotel_name"), spark.read.parquet(cfg.path(f"embeddings_{name}"))) for name, _ in SIDES}
    (hb_hotels, hb_emb), (ad_hotels, ad_emb) = side["hotelbeds"], side["axisdata"]
    pairs = matching.hotel_pairs(hb_hotels, ad_hotels).withColumn("pair", F.struct("hb_hotel_ord", "ad_hotel_ord").cast("string"))
    room = ["hotel_ord", "ord", "room_code", "room_id", "text_for_embedding", "embedding", F.col("text_for_embedding").alias("text"), F.struct("occupancy.max_occupancy", "occupancy.max_adults", "occupancy.max_children").alias("occupancy")]
    hb_rooms, ad_rooms = (emb.select(*room).join(pairs.select("pair", F.col(f"{p}_hotel_ord").alias("hotel_ord")), "hotel_ord") for emb, p in ((hb_emb, "hb"), (ad_emb, "ad")))
    if cfg.method == "validated":
        threshold = cfg.threshold or matching.GM_THRESHOLD
        assigned = matching.match_rooms_validated(hb_rooms, ad_rooms, "pair", "embedding", threshold, cfg.penalties)
    else:
        threshold = cfg.threshold or matching.ST_THRESHOLD
        assigned = matching.match_rooms(hb_rooms, ad_rooms, "pair", "embedding", threshold)
    assigned, n_assigned = _observed(assigned, {"matches": F.count("ad_ord")})
    assigned = _keep(assigned, cfg, "assigned")
    unmatched, n_unmatched = _observed(matching.unmatched_rooms(hb_rooms, ad_rooms, assigned, "pair"), {f"unmatched_{p}_rooms": F.count_if(F.col("side") == p) for p in ("hb", "ad")})
    unmatched = _keep(unmatched, cfg, "unmatched")
    settings.logger().info("matched: %s", n_assigned.get | n_unmatched.get)
    report = results.pair_report(pairs, hb_rooms, ad_rooms, assigned, unmatched)
    tables.write_rows(report, cfg.path("hotel_pairs"))
    ad_unmatched = unmatched.where("side = 'ad'")
    if cfg.document:
        tables.write_document(results.mapped_document(report, assigned, ad_unmatched, similarity_threshold=threshold, strategy="rank_1_greedy", method=cfg.method), cfg.path("mapped"))
    tables.audit(pairs.select("place_id", "hb_hotel_code", "ad_hotel_code"), "hotel_match", cfg.path("audit"))
    tables.audit(assigned.where("ad_ord is not null"), "room_match", cfg.path("audit"))
    return summary.match_summary(assigned, ad_unmatched, "pair").first().asDict()


STAGES = {"load": load, "enrich": enrich_rooms, "normalize": normalize, "embed": embed_rooms, "match": match}


def _content(spark: SparkSession, path: str | None) -> list:
    """A digest of a file's text, or of a folder's, worked out where it lies; its order within a file counts for little."""
    if not path:
        return []
    h = F.xxhash64("value")
    return list(spark.read.text(path).agg(F.count("*"), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string"), F.bit_xor(h), F.sum(F.xxhash64("value", F.length("value")).cast("decimal(38,0)")).cast("string")).first())


def fingerprint(spark: SparkSession, cfg: Config, stage: str, before: str) -> str:
    """What a stage's result depends on: its inputs, its parameters and the stages before it."""
    model = cfg.model or f"{cfg.embedder.__module__}.{cfg.embedder.__qualname__}"
    own = {
        "load": lambda: [_content(spark, cfg.hotelbeds), _content(spark, cfg.axisdata), cfg.strict, cfg.lines],
        "enrich": lambda: _content(spark, cfg.catalog),
        "normalize": lambda: [cfg.document, cfg.skip_enrichment or not cfg.catalog],
        "embed": lambda: [cfg.method, cfg.dimensions, model, cfg.document],
        "match": lambda: [cfg.method, cfg.threshold, cfg.penalties, cfg.document],
    }
    return hashlib.sha256(json.dumps([stage, before, own[stage]()], default=repr).encode()).hexdigest()


def _done(spark: SparkSession, cfg: Config, stage: str) -> dict:
    """The note that a finished stage left: its fingerprint and what it returned."""
    try:
        return json.loads(spark.read.text(cfg.path(f"done_{stage}")).first()["value"])
    except AnalysisException:
        return {}


def _note(spark: SparkSession, path: str, what: dict) -> None:
    spark.createDataFrame([(json.dumps(what, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def run(spark: SparkSession, cfg: Config, stage: str | None = None) -> dict:
    """Run all stages, or one; returns the report, which is also written beside the results.

    With ``reuse``, a stage whose inputs, parameters and earlier stages are those of its last finished run isn't run again.
    """
    began = datetime.now(timezone.utc)
    skip = {"enrich": cfg.skip_enrichment or not cfg.catalog, "normalize": cfg.skip_normalization, "embed": cfg.skip_embeddings}
    steps, out, mark = [], {}, ""
    log = settings.logger()
    tables.audit_event(spark, "pipeline_start", {"method": cfg.method, "stage": stage or "all"}, cfg.path("audit"))
    for name, work in STAGES.items():
        if stage not in (None, name):
            continue
        if stage is None and skip.get(name):
            steps.append(f"{name}_skipped")
            continue
        try:
            if stage is None:
                mark = fingerprint(spark, cfg, name, mark)
                if cfg.reuse and (last := _done(spark, cfg, name)).get("fingerprint") == mark:
                    out[name] = last["result"]
                    steps.append(f"{name}_reused")
                    log.info("%s reused", name)
                    continue
            _note(spark, cfg.path(f"done_{name}"), {})  # not done until it is
            with shared.scratch(spark):
                out[name] = work(spark, cfg)
            _note(spark, cfg.path(f"done_{name}"), {"fingerprint": mark if stage is None else None, "result": out[name]})
            steps.append(name)
        except Exception as e:
            log.error("%s failed: %s", name, e)
            tables.audit_event(spark, "error", {"stage": name, "message": str(e)[:1000]}, cfg.path("audit"))
            if name != "enrich" or stage is not None:
                raise
            steps.append("enrich_failed")
            cfg = replace(cfg, skip_enrichment=True)
        log.info("%s done", steps[-1])
    ended = datetime.now(timezone.utc)
    report = {"start": began.isoformat(), "end": ended.isoformat(), "duration_seconds": (ended - began).total_seconds(), "steps": steps}
    if "load" in out:
        report["total_hotels"] = sum(c["valid_hotels"] for c in out["load"].values())
    report |= {"summary": out["match"]} if "match" in out else {}
    report["stages"] = {k: v for k, v in out.items() if k != "match"}
    _note(spark, cfg.path("report" if stage is None else f"report_{stage}"), report)
    tables.audit_event(spark, "pipeline_complete", {"duration_seconds": str(report["duration_seconds"])}, cfg.path("audit"))
    return report


def main(argv: list[str] | None = None) -> int:
    given = settings.Settings.from_env()
    p = argparse.ArgumentParser(description="Match the rooms of two suppliers' hotels.")
    p.add_argument("hotelbeds")
    p.add_argument("axisdata")
    p.add_argument("--catalog")
    p.add_argument("--output-dir", default=given.output_dir)
    p.add_argument("--method", choices=["plain", "validated"], default="plain")
    p.add_argument("--threshold", type=float, default=given.room_threshold if "INNKEEP_ROOM_THRESHOLD" in os.environ else None)
    p.add_argument("--strict", action="store_true")
    p.add_argument("--lines", action="store_true", help="one hotel per line")
    p.add_argument("--skip-enrichment", action="store_true")
    p.add_argument("--skip-normalization", action="store_true", help="use that of an earlier run")
    p.add_argument("--skip-embeddings", action="store_true", help="use those of an earlier run")
    p.add_argument("--no-document", action="store_true", help="rows only, no documents")
    p.add_argument("--reuse", action="store_true", help="leave out stages whose inputs and parameters have not changed")
    p.add_argument("--no-cache", action="store_true", help="embed all texts anew")
    p.add_argument("--stage", choices=list(STAGES), help="only this stage, on what earlier ones wrote")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("innkeep").getOrCreate()
    try:
        cfg = Config(
            a.hotelbeds, a.axisdata, a.output_dir, a.catalog, a.method, a.threshold, strict=a.strict, lines=a.lines, skip_enrichment=a.skip_enrichment,
            skip_embeddings=a.skip_embeddings, skip_normalization=a.skip_normalization, document=not a.no_document, reuse=a.reuse, cache=not a.no_cache, batch_size=given.batch_size,
        )
        print(json.dumps(run(spark, cfg, a.stage), default=str))
    except KeyboardInterrupt:
        return 130
    except Exception as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
