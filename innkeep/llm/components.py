"""Connected components of an undirected graph.

Edges are contracted to spanning forests in chunks of at most CHUNK edges, wherever they lie, without a shuffle. If the
rest fits one chunk, one more contraction ends it. Otherwise a large-star and a small-star step follow: each is a minimum
per node (combined before the shuffle) and a join back on the node, which Spark may split for nodes with very many edges;
then forests again. Edges never go to the driver. Self-loops are allowed; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.llm import store

CHUNK = 500_000


def roots(n: int, a: np.ndarray, b: np.ndarray) -> list[int]:
    """The least member of the component of each of 0 .. n - 1, for edges a[i], b[i]."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        i, j = find(i), find(j)
        if i != j:
            root[max(i, j)] = min(i, j)
    return [find(i) for i in range(n)]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """u, v: each node of a chunk with the least node of its component there; least nodes with themselves."""
    us: list[np.ndarray] = []
    vs: list[np.ndarray] = []
    size = 0

    def contracted() -> pa.RecordBatch:
        nodes, place = np.unique(np.concatenate([*us, *vs]), return_inverse=True)
        half = len(place) // 2
        low = nodes[roots(len(nodes), place[:half], place[half:])]
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(low)], ["u", "v"])

    for b in batches:
        for i in range(0, b.num_rows, CHUNK):
            part = b.slice(i, CHUNK)
            if us and size + part.num_rows > CHUNK:
                yield contracted()
                us.clear()
                vs.clear()
                size = 0
            us.append(part.column("u").to_numpy())
            vs.append(part.column("v").to_numpy())
            size += part.num_rows
    if size:
        yield contracted()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (the smallest node) for every node of an edge."""
    spark = edges.sparkSession
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u is not null and v is not null")
    e, path = store.materialize(e.mapInArrow(_forest, "u long, v long"), "cc")
    while e.count() > CHUNK:
        e = e.distinct()
        both = e.where("u <> v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large, large_path = store.materialize(both.join(low, "u").where("v >= u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc")
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v"))).distinct()
        before = path
        e, path = store.materialize(small, "cc")
        if not e.where("u <> v").join(e.select(F.col("u").alias("v"), F.col("v").alias("w")), "v").where("v <> w").limit(1).count() and not e.where("u <> v").groupBy("u").count().where("count > 1").limit(1).count():
            store.remove(spark, before, large_path)
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
        e, forest = store.materialize(e.mapInArrow(_forest, "u long, v long"), "cc")
        store.remove(spark, before, large_path, path)
        path = forest
    return e.coalesce(1).mapInArrow(_forest, "u long, v long").select(F.col("u").alias("node"), F.col("v").alias("component"))
