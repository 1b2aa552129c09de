"""JSON documents of any size: members of a head, then a list of elements in order, written by many tasks.

A document is text in parts: the head, elements by ranges of their places, the end of the list. Read one after the other
in the order of their names they are one valid JSON document; a small document is one part and one line. Beside them
``<path>_parts`` lists the parts in order and how many elements there are.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innkeep.operators.positions import with_places


@dataclass
class Document:
    head: DataFrame  # one row: the members before the list
    name: str  # of the list
    rows: DataFrame  # place (from 0) and the elements' members

    @property
    def members(self) -> set[str]:
        return {*self.head.columns, self.name}


def document(head: DataFrame, name: str, rows: DataFrame, order: list[Column], drop: tuple[str, ...] = ()) -> Document:
    """A document of ``rows`` in an order that tells them apart; ``drop`` names columns that only serve the order.

    The rows' places are worked out by ranges, and the rows are written once in the shared folder.
    """
    return Document(head, name, with_places(rows, order, None, "place").drop(*drop))


def write_document(doc: Document, path: str) -> None:
    """Write a document, null members left out."""
    spark = doc.head.sparkSession
    cols = [c for c in doc.rows.columns if c != "place"]
    start = F.regexp_replace(F.to_json(F.struct(*doc.head.columns)), r"\}$", "")
    start = F.concat(start, F.when(start != "{", ",").otherwise(""), F.lit(json.dumps(doc.name) + ":["))
    part = lambda df, rank, place, value: df.select(F.lit(rank).alias("rank"), place.cast("long").alias("place"), value.alias("value"))
    body = part(doc.rows, 1, F.col("place"), F.concat(F.when(F.col("place") > 0, ",").otherwise(""), F.to_json(F.struct(*cols))))
    lines = part(doc.head, 0, F.lit(0), start).unionByName(body).unionByName(part(doc.head, 2, F.lit(0), F.lit("]}")))
    lines = lines.repartitionByRange("rank", "place").sortWithinPartitions("rank", "place").select("value")
    lines.write.mode("overwrite").option("lineSep", " ").text(path)  # a part is one line
    parts = {"parts": part_names(spark, path), "elements": doc.rows.count()}
    spark.createDataFrame([(json.dumps(parts),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}_parts")


def part_names(spark, path: str) -> list[str]:
    """The files of a written text, in order."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    names = [f.getPath().getName() for f in found]
    return sorted((n for n in names if n.startswith("part-")), key=lambda n: int(re.match(r"part-(\d+)", n)[1]))
