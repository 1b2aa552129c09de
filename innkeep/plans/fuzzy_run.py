"""The fuzzy mapping program and its command line: two room lists to mappings, statistics, tiers and simplified mappings.

Mappings are scored once and written; everything after that reads them back. With ``--from`` an earlier run's mappings
are filtered anew. Room lists are JSON arrays, or, with ``lines``, one room per line.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.operators import fuzzy, learn, tiers
from innkeep.sources import hotels as src
from innkeep.sources import tables

FIELDS = ("code", "name", "description", "type")


def read_rooms(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """ord, code, name, description and type of a flat list of rooms; what is missing or null is null."""
    recs = src.read_records(spark, path, lines)
    return recs.selectExpr("ord", *[f"try_variant_get(rec, '$.{f}', 'string') AS {f}" for f in FIELDS])


def read_mappings(spark: SparkSession, path: str) -> DataFrame:
    """Mappings of an earlier run: the table it wrote, or a JSON document whose ``mappings`` hold source_room and target_room."""
    if not path.endswith(".json"):
        return spark.read.parquet(path)
    room = "struct<code:string,name:string,description:string>"
    kind = f"mappings array<struct<source_room:{room},target_room:{room},match_score:double,match_type:string,confidence:double>>"
    rows = spark.read.json(path, multiLine=True, schema=kind).select(F.posexplode("mappings").alias("ord", "m"))
    side = lambda p, c, name: F.col(f"m.{p}_room.{c}").alias(name)
    return rows.select(
        F.col("ord").cast("long").alias("ord"), side("source", "code", "code"), side("source", "name", "name"), side("source", "description", "description"), side("target", "code", "target_code"), side("target", "name", "target_name"),
        F.when(F.col("m.target_room").isNotNull(), F.col("ord").cast("long")).alias("target_ord"), "m.match_score", "m.match_type", "m.confidence",
    )


def learned(rooms: DataFrame) -> dict[str, DataFrame]:
    """All patterns of a room list, by name."""
    texts = rooms.withColumn("text", F.lower(F.coalesce(F.nullif("name", F.lit("")), F.nullif("description", F.lit("")), F.lit(""))))
    top = learn.category_tokens(texts)
    return {
        "tokens": learn.token_counts(texts), "bigrams": learn.ngram_counts(texts, 2), "trigrams": learn.ngram_counts(texts, 3), "numbers": learn.numeric_counts(texts),
        "code_prefixes": learn.code_prefixes(texts), "type_categories": learn.type_categories(texts), "categories": learn.category_rooms(texts, top), "word_clusters": learn.word_clusters(texts),
    }


def map_rooms(spark: SparkSession, source: str, target: str, output_dir: str, first: int | None = None, patterns: bool = False, lines: bool = False) -> DataFrame:
    """Write the mappings of the source rooms (only the ``first`` so many, if given) and return them."""
    rooms, targets = read_rooms(spark, source, lines), read_rooms(spark, target, lines)
    rooms = rooms if first is None else rooms.where(F.col("ord") < first)
    fuzzy.best_matches(rooms, targets).write.mode("overwrite").parquet(f"{output_dir}/mappings")
    if patterns:
        for name, found in learned(rooms.unionByName(targets.withColumn("ord", F.col("ord") + F.lit(1 << 62)))).items():
            tables.write_rows(found, f"{output_dir}/patterns/{name}")
    return spark.read.parquet(f"{output_dir}/mappings")


def post_filter(mappings: DataFrame, output_dir: str, strict: bool = False) -> dict:
    """Write filtered and simplified mappings, best first, and the statistics before and after the filter, which are returned."""
    tiers.tiered(mappings, strict).write.mode("overwrite").parquet(f"{output_dir}/tiers")
    kept = mappings.sparkSession.read.parquet(f"{output_dir}/tiers")
    tables.write_rows(kept.orderBy(F.desc("match_score"), "tier", "ord"), f"{output_dir}/filtered")
    tables.write_rows(tiers.simplified(mappings), f"{output_dir}/simplified")
    before, after = fuzzy.statistics(mappings), tiers.tier_statistics(mappings, kept)
    both = before.select(F.struct("*").alias("mapping")).join(F.broadcast(after.select(F.struct("*").alias("filter"))))
    tables.write_document(both, f"{output_dir}/statistics")
    return both.first().asDict(recursive=True)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Map each room of a list to its most similar room of another.")
    p.add_argument("source", nargs="?")
    p.add_argument("target", nargs="?")
    p.add_argument("--from", dest="earlier", help="mappings of an earlier run (its table, or a .json document), to filter anew")
    p.add_argument("--output-dir", default="out")
    p.add_argument("--first", type=int, help="only so many source rooms")
    p.add_argument("--patterns", action="store_true", help="also write the patterns of all rooms")
    p.add_argument("--strict", action="store_true", help="no low-tier row beside a high-tier one of the same code")
    p.add_argument("--lines", action="store_true", help="one room per line")
    a = p.parse_args(argv)
    if not a.earlier and not (a.source and a.target):
        p.error("two room lists or --from are needed")
    spark = SparkSession.builder.appName("innkeep").getOrCreate()
    try:
        m = read_mappings(spark, a.earlier) if a.earlier else map_rooms(spark, a.source, a.target, a.output_dir, a.first, a.patterns, a.lines)
        print(json.dumps(post_filter(m, a.output_dir, a.strict)))
    except KeyboardInterrupt:
        return 130
    except Exception as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
