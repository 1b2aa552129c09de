"""Approximate nearest neighbours: an NN-descent graph and greedy search on it.

Nodes are the distinct vectors; copies hang on their node, and only the smallest k + 1 ids of a node can be results, so
no group of copies is ever gathered. Distances inside the graph come from half precision, after centring and scaling by
the whole table's spread; the results are measured on the original vectors in double precision.

The first lists come from blocks of vectors that lie together in the order of random sign codes, several codes at once.
Each round joins neighbours of neighbours: a node sends itself to a sample of its list, entries that are new since its
last round before older ones, and nodes that meet at a neighbour are compared if one of them came by a new entry. Nodes
that meet in very great numbers at one neighbour are dealt over several tasks and meet in parts. What is nearer than the
last of a list is proposed to it. Rounds end when at most DELTA of all entries changed. Lists only get nearer and a pair
of old entries isn't met again, so rounds grow cheaper and come to an end.

A query starts from its own node and its list, and expands its best unexpanded candidates, many at a time, until its beam
holds no unexpanded one. The beam grows with the square root of the nodes. Queries go in blocks of at most QUERY_BYTES; what a round gathers on the driver is two numbers
for each query of the block. Joins with the graph broadcast a side only if its size stays below BROADCAST_BYTES.

Every row is indexed; the figures that trade recall for work are parameters, and the tests hold recall at 10 against
brute force.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part; shorter vectors are
padded with zeros; ties go to the smaller id; rows with the query's id are its own; rows that repeat an id and its vector
count once; fewer candidates than k give as many rows; an empty table gives no rows; other columns are ignored. Vectors
whose 64-bit hashes collide are one node (a chance of 3 in 10^8 among a million).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innkeep.llm import store
from innkeep.llm.vectors import matrix

NEIGHBOURS = 24
NEW, OLD = 12, 5
DELTA = 0.005
STARTS = 6
START_BLOCK = 2048
MEET = 64
HUB = 65_536
BEAM = 300
BEAM_GROWTH = 1.35
QUERY_BYTES = 32 << 20
BROADCAST_BYTES = 16 << 20

_GRAPH = "id long, code binary, nb binary, nd binary, fresh binary, changed int"


def _blobs(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Runs of flat as binary values; run i has counts[i] numbers."""
    ends = (np.cumsum(np.append(0, counts)) * flat.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(flat))])


def _flat(col: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers, how many each value holds); null values hold none."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    counts = pc.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) // np.dtype(dtype).itemsize
    return np.frombuffer(b"".join(col.drop_null().to_pylist()), dtype), counts


def _codes(col: pa.Array) -> np.ndarray:
    flat, counts = _flat(col, np.float16)
    return flat.reshape(len(counts), -1).astype(np.float32)


def _square_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(-1)[..., :, None] + (y * y).sum(-1)[..., None, :] - 2 * (x @ np.swapaxes(y, -1, -2)), 0)


def _hash(number: int, *parts: np.ndarray) -> np.ndarray:
    h = np.full(1, 0x9E3779B97F4A7C15 ^ number, np.uint64)
    for p in parts:
        h = (h ^ p.astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
        h = h ^ (h >> np.uint64(32))
    return h


def _rank(owner: np.ndarray) -> np.ndarray:
    """0, 1, .. among equal neighbouring values."""
    at = np.arange(len(owner))
    return at - np.maximum.accumulate(np.where(np.append(True, owner[1:] != owner[:-1]), at, 0)) if len(owner) else at


def _whole(batches: Iterator[pa.RecordBatch], key: str, size: int) -> Iterator[pa.Table]:
    """Tables of about ``size`` rows or more, from batches sorted by key, which is never cut."""
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n >= size and held[0].column(key)[0] != b.column(key)[-1]:
            t = pa.Table.from_batches(held)
            k = t.column(key).to_numpy()
            cut = int(np.argmax(k == k[-1]))
            yield t.slice(0, cut).combine_chunks()
            t = t.slice(cut)
            held, n = t.to_batches(), t.num_rows
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _usable(vectors: DataFrame, id_col: str, vec_col: str, is_query: Column) -> DataFrame:
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where("id is not null and v is not null").where(~bad & F.exists("v", lambda x: x != 0)).withColumn("node", F.xxhash64("v"))


def encode(nodes: DataFrame) -> tuple[DataFrame, int]:
    """(id and code of nodes (id, v), the width): code is the vector in half precision, centred and scaled by its spread."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, square, n = np.zeros(0), np.zeros(0), 0
        for b in batches:
            _, x = matrix(b.column("v"))
            more = max(0, x.shape[1] - len(total))
            total, square = np.pad(total, (0, more)), np.pad(square, (0, more))
            total[: x.shape[1]] += x.sum(axis=0)
            square[: x.shape[1]] += (x * x).sum(axis=0)
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(total)), pa.int32()), pa.array(np.append(n, total)), pa.array(np.append(0.0, square))], ["place", "total", "square"])

    found = nodes.select("v").mapInArrow(sums, "place int, total double, square double").groupBy("place").agg(F.sum("total"), F.sum("square")).orderBy("place").collect()  # a row for each place of a vector
    width, n = max(0, len(found) - 1), max(1.0, found[0][1] if found else 0.0)
    mean = np.array([r[1] for r in found[1:]]) / n
    spread = float(np.sqrt(max(sum(r[2] for r in found[1:]) / n - (mean * mean).sum(), 0) / max(1, width))) or 1.0

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, x = matrix(b.column("v"), width)
            half = np.clip((x - mean) / spread, -60_000, 60_000).astype(np.float16)
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(at)), _blobs(half.ravel(), np.full(len(at), width))], ["id", "code"])

    return nodes.select("id", "v").mapInArrow(code, "id long, code binary"), width


def _first_lists(nodes: DataFrame, width: int, keep: int, starts: int = STARTS, size: int = START_BLOCK) -> DataFrame:
    """id, nb, nd: nearest nodes within blocks of the orders of random sign codes."""
    planes = np.random.default_rng(1).standard_normal((starts, width, 17)).astype(np.float32)

    def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _codes(b.column("code"))
                for s in range(starts):
                    p = x @ planes[s]
                    bits = ((p[:, :16] > 0) @ (1 << np.arange(15, -1, -1))).astype(np.int64) + (s << 16)
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bits), pa.array(p[:, 16])], ["id", "code", "place", "along"])

    def compared(ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        d = _square_distances(x, x)
        np.fill_diagonal(d, np.inf)
        m = min(keep, len(ids) - 1)
        best = np.argpartition(d, max(m - 1, 0), axis=1)[:, :m]
        counts = np.full(len(ids), m)
        return pa.RecordBatch.from_arrays([pa.array(ids), _blobs(ids[best].ravel(), counts), _blobs(np.take_along_axis(d, best, 1).astype(np.float32).ravel(), counts)], ["id", "nb", "nd"])

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, x, start = np.empty(0, np.int64), np.empty((0, width), np.float32), -1
        for b in batches:
            s = b.column("place").to_numpy() >> 16
            for i, j in zip(cuts := [0, *(np.flatnonzero(s[1:] != s[:-1]) + 1).tolist()], [*cuts[1:], b.num_rows], strict=True):
                if i == j:
                    continue
                if s[i] != start:
                    if len(ids):
                        yield compared(ids, x)
                    ids, x, start = ids[:0], x[:0], s[i]
                part = b.slice(i, j - i)
                ids, x = np.concatenate([ids, part.column("id").to_numpy()]), np.concatenate([x, _codes(part.column("code"))])
                while len(ids) >= 2 * size:
                    yield compared(ids[:size], x[:size])
                    ids, x = ids[size:], x[size:]
        if len(ids):
            yield compared(ids, x)

    parts = max(1, starts * nodes.count() // (8 * size))
    signed = nodes.mapInArrow(signs, "id long, code binary, place long, along float")
    return signed.repartitionByRange(parts, "place", "along").sortWithinPartitions("place", "along").mapInArrow(block, "id long, nb binary, nd binary")


def _sent(row: np.ndarray, ids: np.ndarray, nb: np.ndarray, fresh: np.ndarray, number: int) -> np.ndarray:
    """Which list entries (of the nodes ids[row]) are in the sample of a round: up to NEW fresh ones and OLD others, by hash."""
    order = np.lexsort((_hash(number, ids[row], nb), fresh == 0, row))
    rank = _rank(row[order] * 2 + (fresh[order] == 0))
    out = np.zeros(len(nb), bool)
    out[order] = rank < np.where(fresh[order] == 0, OLD, NEW)
    return out


def _merged(graph: DataFrame, found: DataFrame, keep: int, number: int) -> DataFrame:
    """The graph with proposals (id, nb, nd) merged into its lists; entries sent in this round are fresh no more."""
    gone = F.lit(None).cast("binary")
    both = graph.select("id", "code", "nb", "nd", "fresh").unionByName(found.select("id", gone.alias("code"), "nb", "nd", gone.alias("fresh")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole(batches, "id", 20_000):
            every = t.column("id").to_numpy()
            node = t.column("code").is_valid().to_numpy()
            (nb, counts), (nd, _) = _flat(t.column("nb"), np.int64), _flat(t.column("nd"), np.float32)
            row = np.repeat(np.arange(len(every)), counts)
            listed = node[row]
            fresh = np.ones(len(nb), np.uint8)
            fresh[listed] = _flat(t.column("fresh"), np.uint8)[0]
            if listed.any():
                fresh[np.flatnonzero(listed)[_sent(row[listed], every, nb[listed], fresh[listed], number)]] = 0
            owner = np.cumsum(np.append(False, every[1:] != every[:-1]))[row]
            n = int(node.sum())
            order = np.lexsort((~listed, nb, owner))
            order = order[(nb[order] != every[row[order]])]
            once = np.append(True, (owner[order][1:] != owner[order][:-1]) | (nb[order][1:] != nb[order][:-1]))[: len(order)]
            order = order[once]
            order = order[np.lexsort((nb[order], nd[order], owner[order]))]
            order = order[_rank(owner[order]) < keep]
            own, size = owner[order], np.bincount(owner[order], minlength=n)
            changed = np.bincount(own, ~listed[order], minlength=n).astype(np.int32)
            at = pa.array(np.flatnonzero(node))
            cols = [t.column("id").take(at).combine_chunks(), t.column("code").take(at).combine_chunks(), _blobs(nb[order], size), _blobs(nd[order], size), _blobs(fresh[order], size), pa.array(changed)]
            yield pa.RecordBatch.from_arrays(cols, ["id", "code", "nb", "nd", "fresh", "changed"])

    return both.repartition("id").sortWithinPartitions("id").mapInArrow(work, _GRAPH)


def _messages(graph: DataFrame, number: int, neighbours: int, hubs: dict[int, int]) -> DataFrame:
    """host, salt, id, last, fresh, code: the nodes that meet at each host; a host meets those who list it."""
    hub_ids = np.array(sorted(hubs), np.int64)
    parts = np.array([hubs[h] for h in hub_ids.tolist()], np.uint64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for s in range(0, big.num_rows, 4096):
                b = big.slice(s, 4096)
                ids = b.column("id").to_numpy()
                (nb, counts), (nd, _), (fresh, _) = _flat(b.column("nb"), np.int64), _flat(b.column("nd"), np.float32), _flat(b.column("fresh"), np.uint8)
                row = np.repeat(np.arange(len(ids)), counts)
                last = np.full(len(ids), np.inf, np.float32)
                full = counts >= neighbours
                last[full] = nd[(np.cumsum(counts) - 1)[full]]
                sent = _sent(row, ids, nb, fresh, number)
                who = np.concatenate([np.arange(len(ids)), row[sent]])
                host = np.concatenate([ids, nb[sent]])
                new = np.concatenate([np.zeros(len(ids), bool), fresh[sent] != 0])
                salt = np.zeros(len(host), np.int32)
                if len(hub_ids):
                    at = np.minimum(np.searchsorted(hub_ids, host), len(hub_ids) - 1)
                    hub = hub_ids[at] == host
                    salt[hub] = (_hash(number, ids[who[hub]]) % parts[at[hub]]).astype(np.int32)
                who = pa.array(who)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(host), pa.array(salt), b.column("id").take(who), pa.array(last).take(who), pa.array(new), b.column("code").take(who)], ["host", "salt", "id", "last", "fresh", "code"]
                )

    return graph.select("id", "code", "nb", "nd", "fresh").mapInArrow(work, "host long, salt int, id long, last float, fresh boolean, code binary")


def _proposals(messages: DataFrame, keep: int) -> DataFrame:
    """id, nb, nd: for the nodes that met, what is nearer than the last of their lists."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole(batches, "host", 40_000):
            host, salt, ids, last, new = (t.column(c).to_numpy() for c in ("host", "salt", "id", "last", "fresh"))
            x = _codes(t.column("code"))
            other = np.append(True, (host[1:] != host[:-1]) | (salt[1:] != salt[:-1]))
            group = np.cumsum(other) - 1
            group = np.cumsum(other | (_rank(group) % MEET == 0)) - 1
            size = np.bincount(group)
            first = np.cumsum(size) - size
            useful = (size > 1) & (np.bincount(group, new) > 0)
            found: list[tuple[np.ndarray, ...]] = []
            for m in np.unique(size[useful]).tolist():  # meetings of one size go side by side
                at = first[useful & (size == m)]
                step = max(1, 1_000_000 // (m * (m + x.shape[1])))
                for s in range(0, len(at), step):
                    i = at[s : s + step, None] + np.arange(m)
                    d = _square_distances(x[i], x[i])
                    met = (new[i][:, :, None] | new[i][:, None, :]) & (ids[i][:, :, None] != ids[i][:, None, :]) & (d < last[i][:, :, None])
                    g, a, b = np.nonzero(met)
                    found.append((ids[i[g, a]], ids[i[g, b]], d[g, a, b].astype(np.float32)))
            if not found:
                continue
            a, c, d = (np.concatenate(f) for f in zip(*found, strict=True))
            order = np.lexsort((d, c, a))
            order = order[np.append(True, (a[order][1:] != a[order][:-1]) | (c[order][1:] != c[order][:-1]))[: len(order)]]
            order = order[np.lexsort((d[order], a[order]))]
            order = order[_rank(a[order]) < keep]
            if len(order):
                names, counts = np.unique(a[order], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(names), _blobs(c[order], counts), _blobs(d[order], counts)], ["id", "nb", "nd"])

    dealt = messages.repartition("host", "salt").sortWithinPartitions("host", "salt", F.xxhash64("id", "host"))
    return dealt.mapInArrow(work, "id long, nb binary, nd binary")


def _hubs(graph: DataFrame) -> dict[int, int]:
    """The hosts that more than HUB lists hold, and the number of parts that they meet in; at most 100,000 hosts."""
    whole = graph.agg(F.count("*").alias("nodes"), F.sum(F.octet_length("nb")).alias("size")).first()
    most = max(HUB, (whole["size"] or 0) // 800_000)
    if whole["nodes"] <= most:
        return {}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, n = np.unique(_flat(b.column("nb"), np.int64)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(n)], ["host", "n"])

    sums = graph.select("nb").mapInArrow(work, "host long, n long").groupBy("host").agg(F.sum("n").alias("n"))
    return {r["host"]: -(-r["n"] // most) for r in sums.where(F.col("n") > most).collect()}


def build_graph(nodes: DataFrame, width: int, neighbours: int = NEIGHBOURS, delta: float = DELTA) -> DataFrame:
    """id, code, nb (int64, nearest first) and nd (float32, squared distances) of every node (id, code)."""
    spark, empty = nodes.sparkSession, F.lit(b"")
    with store.scratch(spark) as own:
        graph = nodes.select("id", "code", empty.alias("nb"), empty.alias("nd"), empty.alias("fresh"))
        graph, path = store.materialize(_merged(graph, _first_lists(nodes, width, neighbours), neighbours, 0), "ann-graph")
        number = 0
        while True:
            number += 1
            found = _proposals(_messages(graph, number, neighbours, _hubs(graph)), neighbours)
            before = path
            graph, path = store.materialize(_merged(graph, found, neighbours, number), "ann-graph")
            store.remove(spark, before)
            sums = graph.agg(F.sum(F.octet_length("nb") / 8).alias("n"), F.sum("changed").alias("changed")).first()
            if (sums["changed"] or 0) <= delta * (sums["n"] or 0):
                own.kept.append(path)
                return graph.drop("fresh", "changed")


def _ranked(rows: DataFrame, beam: int, expand: int) -> DataFrame:
    """q, c, d, done, r, go: the beams (the nearest of each q, r from 1) of candidates, and which are expanded next."""
    near = Window.partitionBy("q").orderBy("d", "c")
    once = rows.repartition("q").groupBy("q", "c").agg(F.min("d").alias("d"), F.max("done").alias("done"))
    kept = once.withColumn("r", F.row_number().over(near)).where(F.col("r") <= beam)
    waiting = F.sum(F.when(F.col("done"), 0).otherwise(1)).over(near.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return kept.withColumn("go", ~F.col("done") & (waiting <= expand))


def _runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The rows in tables of about ``size``."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if b.num_rows:
            held.append(b)
        if sum(x.num_rows for x in held) >= size:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _search_block(graph: DataFrame, asked: DataFrame, beam: int, expand: int, small: bool) -> DataFrame | None:
    """q, c, d, r: the beams of a block of query nodes; small: whether all codes together stay below BROADCAST_BYTES."""
    spark = graph.sparkSession

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("id").to_numpy()
            (nb, counts), (nd, _) = _flat(b.column("nb"), np.int64), _flat(b.column("nd"), np.float32)
            cols = [np.append(ids, np.repeat(ids, counts)), np.append(ids, nb), np.append(np.zeros(len(ids), np.float32), nd), np.arange(len(ids) + len(nb)) < len(ids)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["q", "c", "d", "done"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _runs(batches, 20_000):
            nb, counts = _flat(t.column("nb"), np.int64)
            both = np.stack([nb, np.repeat(t.column("q").to_numpy(), counts)])
            both = both[:, np.lexsort((both[1], both[0]))]
            both = both[:, np.append(True, (both[:, 1:] != both[:, :-1]).any(axis=0))[: both.shape[1]]]
            names, counts = np.unique(both[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(names), _blobs(both[1], counts)], ["c", "qs"])

    starts = graph.join(asked, "id", "left_semi")
    known = starts.select("id", "code").toArrow()  # at most QUERY_BYTES of codes
    qs = known["id"].to_numpy()
    if not len(qs):
        return None
    query_codes = spark.sparkContext.broadcast((np.sort(qs), _codes(known["code"])[np.argsort(qs)]))
    codes = graph.select(F.col("id").alias("c"), "code")
    codes = F.broadcast(codes) if small else codes
    first = starts.select("id", "nb", "nd").mapInArrow(begin, "q long, c long, d float, done boolean")
    state, path = store.materialize(_ranked(first, beam, expand), "ann-beam")
    while True:
        limits = state.groupBy("q").agg(F.count("*").alias("n"), F.max("d").alias("worst"), F.count_if("go").alias("go")).toArrow()  # of the block's queries
        if not pc.sum(limits["go"]).as_py():
            break
        at = np.argsort(limits["q"].to_numpy())
        worst = spark.sparkContext.broadcast(np.where(limits["n"].to_numpy() < beam, np.inf, limits["worst"].to_numpy())[at].astype(np.float32))

        def measure(batches: Iterator[pa.RecordBatch], worst=worst) -> Iterator[pa.RecordBatch]:
            names, x = query_codes.value
            for t in _runs(batches, 20_000):
                q, counts = _flat(t.column("qs"), np.int64)
                at = np.searchsorted(names, q)
                row = np.repeat(np.arange(t.num_rows), counts)
                y = _codes(t.column("code"))
                d = np.empty(len(q), np.float32)
                for s in range(0, len(q), 65_536):
                    diff = x[at[s : s + 65_536]] - y[row[s : s + 65_536]]
                    d[s : s + 65_536] = np.einsum("ij,ij->i", diff, diff)
                c = t.column("c").to_numpy()[row]
                near = np.flatnonzero(d < worst.value[at])
                near = near[np.lexsort((c[near], d[near], at[near]))]
                near = near[_rank(at[near]) < beam]
                yield pa.RecordBatch.from_arrays([pa.array(q[near]), pa.array(c[near]), pa.array(d[near])], ["q", "c", "d"])

        go = state.where("go").select("q", "c")
        go = F.broadcast(go) if 16 * len(qs) * expand <= BROADCAST_BYTES else go
        lists = graph.select(F.col("id").alias("c"), "nb").join(go, "c").select("q", "nb").mapInArrow(spread, "c long, qs binary")
        found = lists.join(codes, "c").mapInArrow(measure, "q long, c long, d float")
        both = state.select("q", "c", "d", (F.col("done") | F.col("go")).alias("done")).unionByName(found.withColumn("done", F.lit(False)))
        before = path
        state, path = store.materialize(_ranked(both, beam, expand), "ann-beam")
        store.remove(spark, before)
    return state.select("q", "c", "d", "r")


def search(graph: DataFrame, asked: DataFrame, beam: int | None = None, expand: int | None = None) -> DataFrame:
    """q, c, d, r: the nearest found of each query node, itself included, with d the squared distance in the graph; asked: the ids of the queries."""
    whole = graph.agg(F.max(F.octet_length("code")).alias("width"), F.count("*").alias("n")).first()
    beam = beam or max(BEAM, int(BEAM_GROWTH * whole["n"] ** 0.5))
    expand = expand or beam // 2
    width = whole["width"] or 1
    blocks = max(1, -(-asked.count() * (width + 16) // QUERY_BYTES))
    small = whole["n"] * (width + 16) <= BROADCAST_BYTES
    out = None
    for n in range(blocks):
        one = _search_block(graph, asked.where(F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(blocks)) == n), beam, expand, small)
        out = one if out is None else out if one is None else out.unionByName(one)
    return graph.sparkSession.createDataFrame([], "q long, c long, d float, r int") if out is None else out


def nearest(vectors: DataFrame, id_col: str, vec_col: str, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row the k nearest found of the other rows, by Euclidean distance."""
    spark = vectors.sparkSession
    with store.scratch(spark) as own:
        usable = _usable(vectors, id_col, vec_col, is_query)
        rows = store.cut(usable.groupBy("id", "node").agg(F.max("q").alias("q")), "ann-rows")
        exact = store.cut(usable.select(F.col("node").alias("id"), "v").dropDuplicates(["id"]), "ann-vectors")
        members = rows.select("node", "id").withColumn("r", F.row_number().over(Window.partitionBy("node").orderBy("id"))).where(F.col("r") <= k + 1)
        members = store.cut(members.select("node", "id"), "ann-members")
        coded, width = encode(exact)
        graph = build_graph(store.cut(coded, "ann-codes"), width)
        queries = rows.where("q").select("id", "node")
        beam = search(graph, queries.select(F.col("node").alias("id")).distinct())
        pairs = queries.join(beam.where(F.col("r") <= 4 * k + 10).select(F.col("q").alias("node"), "c"), "node")
        pairs = pairs.join(exact.select(F.col("id").alias("node"), "v"), "node").join(exact.select(F.col("id").alias("c"), F.col("v").alias("w")), "c")
        zero = F.lit(0.0)
        diff = F.zip_with("v", "w", lambda a, b: (F.coalesce(a, zero) - F.coalesce(b, zero)) * (F.coalesce(a, zero) - F.coalesce(b, zero)))
        scored = pairs.select(F.col("id").alias("query_id"), "c", F.sqrt(F.aggregate(diff, zero, lambda s, x: s + x)).alias("score"))
        listed = scored.join(members.select(F.col("node").alias("c"), F.col("id").alias("vec_id")), "c").where("vec_id <> query_id")
        out = listed.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))).where(F.col("rank") <= k)
        return own.keep(out.select("query_id", "rank", "vec_id", "score"), "ann-nearest")
