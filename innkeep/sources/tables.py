"""Embedding tables, the driver's tables and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.operators.tiers import last_by
from innkeep.sources import documents


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hotel_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """Hotels of an embedding envelope; of equal hotel codes the last. Their vectors are never compared, so they aren't read."""
    env = spark.read.json(path, multiLine=True, schema="embeddings array<struct<hotel_code:string,place_id:string,hotel_name:string,provider:string,text_for_embedding:string>>")
    return last_by(env.select(F.posexplode("embeddings").alias("ord", "e")).select("ord", "e.*"), ["hotel_code"])


def room_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """Rooms of an embedding envelope in file order; absent texts are empty."""
    room = "room_id:string,hotel_code:string,room_code:string,provider:string,text_for_embedding:string,base_description:string,occupancy_text:string,occupancy:struct<max_occupancy:int,max_adults:int,max_children:int>,embedding:array<double>"
    env = spark.read.json(path, multiLine=True, schema=f"embeddings array<struct<{room}>>")
    rooms = env.select(F.posexplode("embeddings").alias("ord", "e")).select("ord", "e.*")
    return rooms.fillna("", ["text_for_embedding", "base_description", "occupancy_text"])


def load_embeddings(spark: SparkSession, hotels_hb: str, rooms_hb: str, hotels_ad: str, rooms_ad: str) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Hotels and rooms of both suppliers from their embedding envelopes."""
    return {"hotelbeds": (hotel_embeddings(spark, hotels_hb), room_embeddings(spark, rooms_hb)), "axisdata": (hotel_embeddings(spark, hotels_ad), room_embeddings(spark, rooms_ad))}


def write_document(doc: DataFrame | documents.Document, path: str) -> None:
    """One row as one JSON document, or a document with a list of any length."""
    if isinstance(doc, documents.Document):
        documents.write_document(doc, path)
    else:
        doc.coalesce(1).write.mode("overwrite").json(path)


def write_rows(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def enveloped(rows: DataFrame, name: str, order: list[str], **metadata) -> documents.Document:
    """The document {metadata, <name>: [rows in order]}; values of metadata may be aggregates of the rows."""
    head = rows.agg(F.count("*").alias("total_count"), *[v.alias(k) for k, v in metadata.items() if isinstance(v, Column)])
    meta = [F.col(k) if isinstance(v, Column) else F.lit(v).alias(k) for k, v in metadata.items()]
    return documents.document(head.select(F.struct(*meta, "total_count").alias("metadata")), name, rows, [F.col(c).asc() for c in order], tuple(order))


def audit(df: DataFrame, event: str, path: str) -> None:
    """Append an event per row: timestamp, event_type and data."""
    df.select(F.current_timestamp().cast("string").alias("timestamp"), F.lit(event).alias("event_type"), F.struct(*df.columns).alias("data")).write.mode("append").json(path)


def audit_event(spark: SparkSession, event: str, data: dict[str, str], path: str) -> None:
    """Append one event of the pipeline itself: start, completion, an error."""
    audit(spark.createDataFrame([tuple(str(v) for v in data.values())], ", ".join(f"{k} string" for k in data)), event, path)
