"""JSON arrays of any size, cut into records in parallel.

A file is read in blocks by Spark's text source, with the closing brace as the line end, so that it splits anywhere and
order within a block is kept. What a block means depends on how it begins: inside a string or not, and how deep. The first pass
works out both cases per block (how it ends, by how much it goes deeper, how many commas lie at each depth); one row per block
is then folded in the order of the blocks; the second pass knows each block's beginning, cuts records at the commas of the
top level and numbers them. Only records that lie in several blocks are put together by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.sources import shared

#: Blocks of all files, at most: their beginnings (a row each) are broadcast.
MAX_BLOCKS = 200_000
_QUOTE, _BACK, _COMMA = b'"\\,'
_OPEN, _CLOSE = np.zeros(256, bool), np.zeros(256, bool)
_OPEN[list(b"[{")] = _CLOSE[list(b"]}")] = True
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\r\n")] = True


class ArrayError(ValueError):
    """Text that is no JSON array."""


def _inside(data: np.ndarray) -> np.ndarray:
    """Whether each byte lies inside a string (its closing quote: no), if the first one doesn't."""
    at = np.arange(len(data))
    other = np.maximum.accumulate(np.where(data != _BACK, at, -1))
    escaped = np.append(False, ((at - other) % 2 == 1)[:-1])
    return np.cumsum((data == _QUOTE) & ~escaped) % 2 == 1


def _steps(data: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """How much deeper the text is after each byte."""
    return np.cumsum((_OPEN[data].astype(np.int64) - _CLOSE[data]) * ~inside)


def _buffers(batches: Iterator[pa.RecordBatch], *cols: str) -> Iterator[tuple]:
    """(file, block, other columns, bytes with the braces back) of neighbouring rows of a block."""
    for b in batches:
        keys = list(zip(*(b.column(c).to_pylist() for c in ("file", "block")), strict=True))
        edges = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            if s < e:
                text = b"}".join([*b.column("value").slice(s, e - s).to_pylist(), b""])
                yield *keys[s], *(b.column(c)[s].as_py() for c in cols), np.frombuffer(text, np.uint8)


class _Case:
    """What a block does if it begins outside a string, or inside one."""

    def __init__(self, inside: bool):
        self.inside, self.depth, self.commas = inside, 0, {}

    def take(self, data: np.ndarray, inside: np.ndarray) -> None:
        inside = inside ^ self.inside
        deep = self.depth + _steps(data, inside)
        levels, n = np.unique(deep[(data == _COMMA) & ~inside], return_counts=True)
        for level, k in zip(levels.tolist(), n.tolist(), strict=True):
            self.commas[level] = self.commas.get(level, 0) + k
        self.inside, self.depth = bool(inside[-1]), int(deep[-1])


_CASES = pa.schema([("file", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("bytes", pa.int64()), ("ends", pa.list_(pa.bool_())), ("depths", pa.list_(pa.int64())), ("levels", pa.list_(pa.list_(pa.int64()))), ("commas", pa.list_(pa.list_(pa.int64())))])
_STARTS = pa.schema([("file", pa.string()), ("block", pa.int64()), ("inside", pa.bool_()), ("depth", pa.int64()), ("commas", pa.int64())])
_PIECES = pa.schema([("file", pa.string()), ("ord", pa.int64()), ("block", pa.int64()), ("whole", pa.bool_()), ("text", pa.binary())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, cases, n = None, [], 0

    def row() -> pa.RecordBatch:
        return _batch([(*now, n, [c.inside for c in cases], [c.depth for c in cases], [list(c.commas) for c in cases], [list(c.commas.values()) for c in cases])], _CASES)

    for file, block, size, data in _buffers(batches, "size"):
        if (file, block, size) != now:
            if now:
                yield row()
            now, cases, n = (file, block, size), [_Case(False), _Case(True)], 0
        n += len(data)
        inside = _inside(data)
        for c in cases:
            c.take(data, inside)
    if now:
        yield row()


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a file in order: how each begins (inside a string, depth, commas of the top level so far)."""
    file, inside, depth, commas = None, False, 0, 0
    for b in batches:
        out = []
        for name, block, ends, depths, levels, n in zip(*(b.column(c).to_pylist() for c in ("file", "block", "ends", "depths", "levels", "commas")), strict=True):
            if name != file:
                file, inside, depth, commas = name, False, 0, 0
            out.append((name, block, inside, depth, commas))
            k = int(inside)
            commas += dict(zip(levels[k], n[k], strict=True)).get(1 - depth, 0)
            inside, depth = ends[k], depth + depths[k]
        if out:
            yield _batch(out, _STARTS)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of records: file, ord, block, whole (all of the record), text. Record -1 is what lies outside the array."""
    now, inside, depth, order, began, held = None, False, 0, 0, False, []

    def rest() -> list[tuple]:
        return [(*now[:1], order if depth > 0 else -1, now[1], False, b"".join(held))] if held else []

    for file, block, at_inside, at_depth, commas, data in _buffers(batches, "inside", "depth", "commas"):
        out = []
        if (file, block) != now:
            out += rest()
            now, inside, depth, order, began, held = (file, block), at_inside, at_depth, commas, False, []
        within = _inside(data) ^ inside
        deep = depth + _steps(data, within)
        before = np.append(depth, deep[:-1])
        comma = (data == _COMMA) & ~within & (deep == 1)
        edge = comma | (~within & (before == 0) & (deep == 1)) | (~within & (before == 1) & (deep == 0))
        raw, s = data.tobytes(), 0
        for e in np.flatnonzero(edge).tolist():
            held.append(raw[s:e])
            out.append((file, -1 if before[e] == 0 else order, block, began and before[e] == 1, b"".join(held)))
            if before[e] == 0:
                out.append((file, -1, block, False, raw[e : e + 1]))
            elif not comma[e] and raw[e : e + 1] != b"]":
                out.append((file, -1, block, False, b"!"))
            order += int(comma[e])
            held, s, began = [], e + 1, True
        held.append(raw[s:])
        inside, depth = bool(within[-1]), int(deep[-1])
        if out:
            yield _batch(out, _PIECES)
    if now and (out := rest()):
        yield _batch(out, _PIECES)


def _ddl(schema: pa.Schema) -> str:
    sql = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean", pa.binary(): "binary", pa.list_(pa.bool_()): "array<boolean>", pa.list_(pa.int64()): "array<long>", pa.list_(pa.list_(pa.int64())): "array<array<long>>"}
    return ", ".join(f"{f.name} {sql[f.type]}" for f in schema)


def read_array(spark: SparkSession, path: str) -> DataFrame:
    """file, ord (place in its file's array, from 0), text (binary) of each element of the JSON arrays at ``path``.

    ArrayError for a file that is no array or has text outside it; elements are cut, not parsed, so a broken one has to be
    found by its reader. An empty array has no rows, nor has an empty
    file, which Spark doesn't read. Pieces are written in the shared folder.
    """
    blocks = spark.read.option("lineSep", "}").text(path)
    blocks = blocks.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("value"))
    cases = shared.cut(blocks.mapInArrow(_summaries, _ddl(_CASES)), "blocks")
    starts = shared.cut(cases.repartition("file").sortWithinPartitions("file", "block").mapInArrow(_folded, _ddl(_STARTS)), "beginnings")
    if starts.count() > MAX_BLOCKS:  # broadcast, as a shuffle would lose the order within blocks
        raise ArrayError(f"more than {MAX_BLOCKS} blocks: give one record per line")
    pieces = shared.cut(blocks.join(F.broadcast(starts), ["file", "block"]).mapInArrow(_cut, _ddl(_PIECES)), "pieces")
    text = F.trim(F.regexp_replace(F.col("text").cast("string"), r"\s+", " "))
    is_ = lambda x: F.count_if((F.col("ord") < 0) & (text == x))
    files = pieces.groupBy("file").agg(is_("[").alias("opened"), is_("{").alias("other"), F.count_if((F.col("ord") < 0) & (text != "")).alias("all"), is_("}").alias("end"), F.max("ord").alias("last"))
    bad = files.where("opened <> 1 OR all <> 2 OR end <> 1").limit(1).collect()
    if bad:
        raise ArrayError("Top level must be a list" if bad[0]["other"] or not bad[0]["opened"] else "text outside the list")
    sizes = cases.groupBy("file").agg(F.sum("bytes").alias("bytes"), F.max("size").alias("size"))
    if not sizes.where("bytes <> size + 1").isEmpty():  # the brace that each line gets back; the file's last line had none
        raise ArrayError("a brace after the list")
    parts = pieces.where("ord >= 0 AND NOT whole").groupBy("file", "ord").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("x"))
    parts = parts.select("file", "ord", F.aggregate("x", F.lit(b""), lambda s, p: F.concat(s, p["text"])).alias("text"))
    every = pieces.where("whole").select("file", "ord", "text").unionByName(parts)
    empty = files.where("last = 0").select(F.col("file").alias("f_"))  # a list of nothing, or of one element
    blank = every.where(text == "").join(empty, F.col("file") == F.col("f_"), "left_anti")
    return every.where(text != "").unionByName(blank)
