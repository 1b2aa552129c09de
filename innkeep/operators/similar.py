"""Pairs of similar vectors within blocks, by whole arrays.

Both sides of a block meet in cells: a cell holds up to TILE vectors of the second side and a share of the first side's, so
that a hot block becomes many cells. A cell screens its pairs by one matrix product and works out the similarity of those near
or above the threshold again, one component after the other: so equal vectors have equal similarities to the last bit,
wherever they lie, and results equal those of the expression ``scoring.cosine``.

Assignment needs no list of all pairs: in blocks of one cell rooms choose where they meet (:func:`chosen`), and of larger ones
each room leaves its cell with its best few (:func:`best`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TILE = 4096
#: Pairs of a cell, about.
CELL_PAIRS = 1 << 26
#: Rows of a batch that meet a tile at once.
_ROWS = 256
#: Pairs that are looked at together where rooms choose: fewer rows meet more places.
_AT_ONCE = 1 << 21
_MARGIN = 1e-9


def _vectors(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(matrix of doubles padded with zeros, lengths, norms); the norm is 0 where no similarity exists."""
    size = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = col.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    out = np.zeros((len(col), int(size.max(initial=0))))
    owner = np.repeat(np.arange(len(col)), size)
    out[owner, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    square = np.zeros(len(col))
    for c in out.T:
        square += c * c
    norm = np.sqrt(square)
    norm[~np.isfinite(norm)] = 0.0
    return out, size, norm


def _numbers(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Doubles, NaN where null."""
    return (col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col).to_numpy(zero_copy_only=False)


def _wide(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


class _Tile:
    """Vectors of the second side in one cell."""

    def __init__(self, batches: list[pa.RecordBatch], keep: list[str]):
        table = pa.Table.from_batches(batches)
        self.n = table.num_rows
        self.rows = pa.StructArray.from_arrays([table.column(c).combine_chunks() for c in ("ord", *keep)], ["ord", *keep]) if self.n else None
        self.x, self.size, self.norm = _vectors(table.column("vec").combine_chunks()) if self.n else (np.zeros((0, 0)), np.zeros(0, np.int64), np.zeros(0))
        self.facts = {c: _numbers(table.column(c)) for c in keep if pa.types.is_floating(table.schema.field(c).type)} if self.n else {}
        self.ords = table.column("ord").to_numpy() if self.n else np.zeros(0, np.int64)
        self.unit = self.x / np.where(self.norm > 0, self.norm, 1.0)[:, None]

    def screened(self, x: np.ndarray, size: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs have a similarity, and all similarities up to _MARGIN."""
        width = max(x.shape[1], self.x.shape[1])
        known = (norm > 0)[:, None] & (self.norm > 0)[None, :] & (size[:, None] == self.size[None, :])
        return known, (_wide(x, width) / np.where(norm > 0, norm, 1.0)[:, None]) @ _wide(self.unit, width).T

    def exact(self, x: np.ndarray, norm: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        width = max(x.shape[1], self.x.shape[1])
        x, tile = _wide(x, width), _wide(self.x, width)
        dot = np.zeros(len(i))
        for c in range(width):
            dot += x[i, c] * tile[j, c]
        return dot / (norm[i] * self.norm[j])

    def met(self, x: np.ndarray, size: np.ndarray, norm: np.ndarray, threshold: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(rows, places, similarities) of the pairs that reach the threshold, and which rows have a pair without similarity."""
        known, about = self.screened(x, size, norm)
        i, j = np.nonzero(known if threshold is None else known & (about >= threshold - _MARGIN))
        sim = self.exact(x, norm, i, j)
        if threshold is not None:
            near = sim >= threshold
            i, j, sim = i[near], j[near], sim[near]
        return i, j, sim, ~known.all(axis=1)


def block_sizes(hb: DataFrame, ad: DataFrame, block: str) -> DataFrame:
    """b_, n_, m_: blocks with the rows of the first side and of the second, counted in one pass."""
    one = lambda df, first: df.select(F.col(block).alias("b_"), F.lit(int(first)).alias("f_"))
    return one(hb, True).unionByName(one(ad, False)).groupBy("b_").agg(F.sum("f_").alias("n_"), F.count_if(F.col("f_") == 0).alias("m_"))


def candidates(hb: DataFrame, ad: DataFrame, block: str, vec: str, threshold: float | None, keep: tuple[str, ...] = (), even: bool = False) -> DataFrame:
    """block, ord, ``keep`` of each first-side row, met: array of (ord, ``keep``, sim) of the second side's that reach the threshold, unknown.

    A row per first-side row whose block the second side has. unknown: with some row there is no similarity (a null,
    zero, not finite or differently long vector). threshold None: all pairs that have one. Rows need ``ord``; null blocks
    meet nothing. even: it is known that no block is above TILE or CELL_PAIRS.
    """
    spark = hb.sparkSession
    sizes = block_sizes(hb, ad, block)
    tiles, parts = F.ceil(F.col("m_") / TILE).cast("int"), F.ceil(F.col("n_") * F.least(F.col("m_"), F.lit(TILE)) / CELL_PAIRS).cast("int")
    large = sizes.select(F.col("b_"), tiles.alias("tiles_"), parts.alias("parts_")).where("tiles_ > 1 or parts_ > 1")
    # at most one block in TILE rows of the second side is large, or one in CELL_PAIRS / TILE of the first
    large = F.broadcast(large) if (n := 0 if even else large.limit(100_001).count()) <= 100_000 else large
    share = lambda n: F.pmod(F.xxhash64("ord"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    cells = []
    for df, second in ((ad, True), (hb, False)):
        rows = df.where(F.col(block).isNotNull()).select(F.col(block).alias("block"), F.lit(not second).alias("first"), F.col("ord").cast("long").alias("ord"), F.col(vec).alias("vec"), *keep)
        one = F.lit(1)
        if n:
            rows = rows.join(large, F.col("block") == F.col("b_"), "left")
            tiles, parts = F.coalesce("tiles_", one), F.coalesce("parts_", one)
            rows = rows.withColumn("tile", share(tiles) if second else every(tiles)).withColumn("part", every(parts) if second else share(parts))
        else:
            rows = rows.withColumn("tile", F.lit(0)).withColumn("part", F.lit(0))
        cells.append(rows.select("block", "tile", "part", "first", "ord", "vec", *keep))
    met = cells[0].unionByName(cells[1])
    kept = [T.StructField(c, cells[1].schema[c].dataType) for c in keep]
    pair = T.StructType([T.StructField("ord", T.LongType()), *kept, T.StructField("sim", T.DoubleType())])
    schema = T.StructType([T.StructField("block", met.schema["block"].dataType), T.StructField("ord", T.LongType()), *kept, T.StructField("met", T.ArrayType(pair)), T.StructField("unknown", T.BooleanType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, tile = None, [], None
        for b in batches:
            at = [b.column(c) for c in ("block", "tile", "part", "first")]
            keys = list(zip(*(c.to_pylist() for c in at), strict=True))
            edges = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                if s == e:
                    continue
                *now, first = keys[s]
                if now != cell:
                    cell, held, tile = now, [], None
                if not first:
                    held.append(b.slice(s, e - s))
                    continue
                if not held:
                    continue  # the other side lacks the block
                tile = tile or _Tile(held, list(keep))
                for o in range(s, e, _ROWS):
                    rows = b.slice(o, min(_ROWS, e - o))
                    i, j, sim, unknown = tile.met(*_vectors(rows.column("vec")), threshold)
                    found = tile.rows.take(pa.array(j))
                    found = pa.StructArray.from_arrays([*found.flatten(), pa.array(sim)], fields=[*[pa.field(f.name, f.type) for f in found.type], pa.field("sim", pa.float64())])
                    offsets = np.append(0, np.cumsum(np.bincount(i, minlength=rows.num_rows))).astype(np.int32)
                    cols = [rows.column("block"), rows.column("ord"), *[rows.column(c) for c in keep], pa.ListArray.from_arrays(pa.array(offsets), found), pa.array(unknown)]
                    yield pa.RecordBatch.from_arrays(cols, ["block", "ord", *keep, "met", "unknown"])

    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    out = met.repartition(count, "block", "tile", "part").sortWithinPartitions("block", "tile", "part", "first").mapInArrow(work, schema)
    if n:  # rows of large blocks met several tiles
        key = F.col("block"), F.col("ord")
        out = out.groupBy(*key).agg(*[F.first(c).alias(c) for c in keep], F.flatten(F.collect_list("met")).alias("met"), F.max("unknown").alias("unknown"))
    return out.withColumnRenamed("block", block)


#: From the similarities of pairs and the facts of both sides (by name, NaN where null) to the adjusted similarities.
Adjust = Callable[[np.ndarray, dict[str, np.ndarray], dict[str, np.ndarray]], np.ndarray]


def _sorted_cells(hb: DataFrame, ad: DataFrame, cell: list[str], seats_first: bool, cols: list[str]) -> DataFrame:
    """Rows of both sides (first: of hb) together by cell, a side after the other, each by ord."""
    spark = hb.sparkSession
    met = hb.select(*cell, F.lit(True).alias("first"), *cols).unionByName(ad.select(*cell, F.lit(False).alias("first"), *cols))
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return met.repartition(count, *cell).sortWithinPartitions(*cell, F.col("first") if seats_first else ~F.col("first"), "ord")


def _runs(batches: Iterator[pa.RecordBatch], cell: list[str]) -> Iterator[tuple[list, bool, pa.RecordBatch]]:
    """(cell, first, rows) of runs of rows, none of them across two batches."""
    for b in batches:
        keys = list(zip(*(b.column(c).to_pylist() for c in (*cell, "first")), strict=True))
        edges = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            if s < e:
                yield list(keys[s][:-1]), keys[s][-1], b.slice(s, e - s)


def _order(i: np.ndarray, adj: np.ndarray, sim: np.ndarray, ords: np.ndarray) -> np.ndarray:
    """Pairs by row, the best first."""
    return np.lexsort((ords, -sim, -adj, i))


class _Seats:
    """Places of a block, and which of them are taken. Only pairs that may decide a room's choice are worked out exactly."""

    def __init__(self, tile: _Tile, threshold: float, facts: tuple[str, ...], adjust: Adjust | None):
        self.tile, self.threshold, self.facts, self.adjust = tile, threshold, facts, adjust
        self.names, self.place = np.unique(tile.ords, return_inverse=True)
        self.columns = np.argsort(self.place, kind="stable")
        self.starts = np.searchsorted(self.place[self.columns], np.arange(len(self.names) + 1))
        self.free = np.ones(tile.n, bool)

    def _adjusted(self, sim: np.ndarray, rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return self.adjust(sim, {c: rows[c][i] for c in self.facts}, {c: self.tile.facts[c][j] for c in self.facts}) if self.adjust else sim

    def taken(self, batch: pa.RecordBatch) -> list[tuple]:
        """(ord, similarity, adjusted one, reason) of each row's choice, a row after the other."""
        x, size, norm = _vectors(batch.column("vec"))
        facts = {c: _numbers(batch.column(c)) for c in self.facts}
        known, about = self.tile.screened(x, size, norm)
        reach = known & (about >= self.threshold - _MARGIN)
        worth = np.full(about.shape, -np.inf)
        i, j = np.nonzero(reach & self.free)
        rough = self._adjusted(about[i, j], facts, i, j)
        fine = rough >= self.threshold - 2 * _MARGIN
        worth[i[fine], j[fine]] = rough[fine]

        def exact(r: int, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            i = np.full(len(j), r)
            sim = self.tile.exact(x, norm, i, j)
            return sim, self._adjusted(sim, facts, i, j)

        out = []
        for r in range(len(worth)):
            row, hit = worth[r], None
            while hit is None and (top := row.max()) > -np.inf:
                j = np.flatnonzero(row >= top - 2 * _MARGIN)
                sim, adj = exact(r, j)
                good = np.flatnonzero((sim >= self.threshold) & (adj >= self.threshold))
                if len(good):
                    k = good[np.lexsort((self.tile.ords[j[good]], -sim[good], -adj[good]))[0]]
                    hit = int(self.place[j[k]])
                    out.append((int(self.names[hit]), float(sim[k]), float(adj[k]), None))
                    gone = self.columns[self.starts[hit] : self.starts[hit + 1]]
                    self.free[gone] = False
                    worth[r:, gone] = -np.inf
                row[j] = -np.inf
            if hit is None:
                out.append((None, None, None, self._reason(r, reach[r], about[r], known[r], exact)))
        return out

    def _reason(self, r: int, reach: np.ndarray, about: np.ndarray, known: np.ndarray, exact: Callable) -> str:
        if self.adjust and len(j := np.flatnonzero(reach & self.free)):
            sim, adj = exact(r, j)
            if ((sim >= self.threshold) & ~(adj >= self.threshold)).any():
                return "failed_validation_checks"
        if not known.all() or (reach & (about > self.threshold + _MARGIN)).any():
            return "no_match_found"
        return "no_match_found" if (exact(r, np.flatnonzero(reach))[0] >= self.threshold).any() else "below_threshold"


def chosen(hb: DataFrame, ad: DataFrame, block: str, vec: str, threshold: float, facts: tuple[str, ...] = (), adjust: Adjust | None = None) -> DataFrame:
    """block, hb_ord, ad_ord, sim, adjusted, reason: the greedy assignment in blocks of one cell, made where the rooms meet."""
    cols = ["ord", "vec", *facts]
    hb, ad = (df.where(F.col(block).isNotNull()).select(F.col(block).alias("block"), F.col("ord").cast("long").alias("ord"), F.col(vec).alias("vec"), *facts) for df in (hb, ad))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, seats = None, [], None
        for now, first, run in _runs(batches, ["block"]):
            if now != cell:
                cell, held, seats = now, [], None
            if not first:
                held.append(run)
                continue
            if seats is None and not held:
                continue  # the other side lacks the block
            if seats is None:
                seats, held = _Seats(_Tile(held, list(facts)), threshold, facts, adjust), []
            step = max(1, min(_ROWS, _AT_ONCE // seats.tile.n))
            for o in range(0, run.num_rows, step):
                rows = run.slice(o, step)
                out = seats.taken(rows)
                kinds = [pa.int64(), pa.float64(), pa.float64(), pa.string()]
                yield pa.RecordBatch.from_arrays([rows.column("block"), rows.column("ord"), *[pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]], ["block", "hb_ord", "ad_ord", "sim", "adjusted", "reason"])

    kind = hb.schema["block"].dataType.simpleString()
    return _sorted_cells(hb, ad, ["block"], True, cols).mapInArrow(work, f"block {kind}, hb_ord long, ad_ord long, sim double, adjusted double, reason string")


def best(hb: DataFrame, ad: DataFrame, k: int, threshold: float, facts: tuple[str, ...] = (), adjust: Adjust | None = None) -> DataFrame:
    """block, hb_ord, ords, sims, adjs: each room's best k candidates, best first; more: it has others; near, failed, unknown.

    hb: block, ord, vec, part and facts; ad: the same with a row for each part of hb's in the block, and by: the room that holds the place. Who holds
    a place keeps later rooms from it. near: a similarity of an open place reaches the threshold; failed: one does, but not the adjusted one;
    unknown: there is a pair without similarity. A cell holds the rooms of a part, and the places pass by.
    """
    cols = ["ord", "vec", "by", *facts]
    cell = ["block", "part"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, waiting, n, rooms, lists, flags = None, [], [], 0, None, [], {}

        def meet() -> None:
            nonlocal waiting, n
            tile = _Tile(waiting, list(facts))
            by = np.concatenate([w.column("by").to_numpy() for w in waiting])
            waiting, n = [], 0
            for at, o in enumerate(range(0, rooms.n, _ROWS)):
                s = slice(o, min(o + _ROWS, rooms.n))
                x, norm = rooms.x[s], rooms.norm[s]
                known, about = tile.screened(x, rooms.size[s], norm)
                flags["unknown"][s] |= ~known.all(axis=1)
                i, j = np.nonzero(known & (about >= threshold - _MARGIN))
                is_open = by[j] > rooms.ords[i + o]
                i, j = i[is_open], j[is_open]
                adjusted = lambda sim, i, j: adjust(sim, {c: rooms.facts[c][i] for c in facts}, {c: tile.facts[c][j] for c in facts}) if adjust else sim
                about = about[i, j]
                rough = adjusted(about, i + o, j)
                sure = (np.abs(about - threshold) > 2 * _MARGIN) & (np.abs(rough - threshold) > 2 * _MARGIN)
                flags["near"][i[sure & (about > threshold)] + o] = True
                flags["failed"][i[sure & (about > threshold) & (rough < threshold)] + o] = True
                kept = ~sure | ((about > threshold) & (rough > threshold))
                i, j, rough = i[kept], j[kept], rough[kept]
                # what is worse than k others of the tile by more than the margin isn't worked out
                order = np.lexsort((-rough, i))
                i, j, rough = i[order], j[order], rough[order]
                last = np.searchsorted(i, i) + k - 1
                far = np.arange(len(i)) > last
                far[far] = rough[far] < rough[last[far]] - 2 * _MARGIN
                flags["more"][i[far] + o] = True
                i, j = i[~far], j[~far]
                sim = tile.exact(x, norm, i, j)
                i = i + o
                reached = sim >= threshold
                i, j, sim = i[reached], j[reached], sim[reached]
                flags["near"][i] = True
                adj = adjusted(sim, i, j)
                good = adj >= threshold
                flags["failed"][i[~good]] = True
                i, ords, sim, adj = (np.concatenate([x, y[good]]) for x, y in zip(lists[at], (i, tile.ords[j], sim, adj), strict=True))
                order = _order(i, adj, sim, ords)
                i, ords, sim, adj = i[order], ords[order], sim[order], adj[order]
                kept = np.arange(len(i)) - np.searchsorted(i, i) < k
                flags["more"][i[~kept]] = True
                lists[at] = (i[kept], ords[kept], sim[kept], adj[kept])

        def done() -> Iterator[pa.RecordBatch]:
            if waiting:
                meet()
            for at, o in enumerate(range(0, rooms.n if rooms is not None else 0, _ROWS)):
                i, *found = lists[at]
                size = min(_ROWS, rooms.n - o)
                offsets = pa.array(np.searchsorted(i, np.arange(o, o + size + 1)).astype(np.int32))
                each = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in found]
                of_block = pa.array([now[0]] * size, block_type)
                yield pa.RecordBatch.from_arrays([of_block, pa.array(rooms.ords[o : o + size]), *each, *[pa.array(flags[f][o : o + size]) for f in ("more", "near", "failed", "unknown")]], ["block", "hb_ord", "ords", "sims", "adjs", "more", "near", "failed", "unknown"])

        block_type = None
        for key, first, run in _runs(batches, cell):
            block_type = run.schema.field("block").type
            if key != now:
                yield from done()
                now, held, waiting, n, rooms = key, [], [], 0, None
            if first:
                held.append(run)
                continue
            if not held:
                continue
            if rooms is None:
                rooms = _Tile(held, list(facts))
                lists = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)) for _ in range(0, rooms.n, _ROWS)]
                flags = {f: np.zeros(rooms.n, bool) for f in ("more", "near", "failed", "unknown")}
            waiting.append(run)
            n += run.num_rows
            if n >= TILE:
                meet()
        yield from done()

    kind = hb.schema["block"].dataType.simpleString()
    out = f"block {kind}, hb_ord long, ords array<long>, sims array<double>, adjs array<double>, more boolean, near boolean, failed boolean, unknown boolean"
    return _sorted_cells(hb.withColumn("by", F.lit(0).cast("long")), ad.withColumn("by", F.coalesce("by", F.lit((1 << 63) - 1))), cell, False, cols).mapInArrow(work, out)
