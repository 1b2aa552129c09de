"""A corpus pipeline: language ID, near-dedup, mixing by source, packing.

Every stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of documents. Nulls,
empty and very long texts, repeated rows and extra columns go through each operator as its module says; an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.llm import langid, mixing, neardup, packing, store

#: A document is rejected if it has no letters, or if no language has at least this share of its letters.
MIN_LANGUAGE_SHARE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents with a main language; fills in missing values of lang."""
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))), "text", "lang", "doc_id")
    mark = "_" * (1 + max(map(len, docs.columns)))  # longer than any column's name
    lang, share, spans = (mark + c for c in ("lang", "share", "spans"))
    found = langid.identify(docs, model, "text", names=(lang, share, spans))
    found = found.where((F.col(lang) != langid.UND) & (F.col(share) >= MIN_LANGUAGE_SHARE))
    return found.select(*[F.coalesce("lang", lang).alias("lang") if c == "lang" else F.col(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates (five-word shingles, similarity 0.8): that with the smallest id.

    Of rows that repeat this id one stays; rows without an id stay.
    """
    found = neardup.near_duplicates(docs, "doc_id", "text", shingle=5, similarity=(80, 100))
    kept = found.where("kept and id is not null").select(F.col("id").alias("kept_id")).distinct()
    with_id = docs.where("doc_id is not null")
    one = with_id.join(kept, with_id["doc_id"] == kept["kept_id"], "left_semi").dropDuplicates(["doc_id"])
    return one.unionByName(docs.where("doc_id is null"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or thins out documents so that sources come near their target weights."""
    return mixing.mix(docs, "doc_id", "source", mixing.word_count(F.col("text")), else_col="text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of at most 2048 tokens; a row per piece."""
    return packing.pack(store.cut(packing.tokenize(docs, "doc_id", "text"), "pieces"))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("mix_sources", mix_sources), ("pack", pack)]

#: Models and tokenizers can't be expressed in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with store.scratch(spark) as own:
        for name, stage in STAGES[:-1]:
            docs = store.cut(stage(spark, docs, sf_dir), f"stage-{name}")
        return own.keep(STAGES[-1][1](spark, docs, sf_dir), "packed")
