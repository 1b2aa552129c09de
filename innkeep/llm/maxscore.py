"""Exact top-k search by inner product, with MaxScore over blocks of vectors.

Components are terms. For a query, a block's extremes bound what each term can add; with the query's threshold (its k-th
best score so far in the task) the terms split into essential ones and non-essential ones, whose bounds together can't
lift a vector over the threshold. The essential terms are traversed for the whole block; the others are probed, the
largest bounds first, only for vectors that are still competitive. Bounds are exact, so results are: vectors are dropped
only if their bound is below the threshold.

Sums of products are exact. Where they may pass 2^53, vectors are screened in doubles, with a floor lowered by the
largest rounding error, and what stays is measured in whole numbers of any size; ranks go by these.

Queries are a stated set and go against all rows in blocks: at most QUERY_BYTES of them at a time are broadcast, and every
task keeps k results for each. Tasks are shards; their results are merged by a window with a limit per query before the
shuffle.

Defined results: vectors that are null or hold null or non-finite components (also after preparation) take no part;
shorter ones are padded with zeros; a query's own row is every row with its id; a repeated query id is searched once, for
the largest of its usable vectors; repeated candidates are listed each; ties go to the smaller id; a score beyond 64 bits is
ranked by its exact value and shown as the nearest 64-bit number; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innkeep.llm.vectors import matrix

QUERY_BYTES = 64 << 20
BLOCK = 4096
PROBE = 8
_LONG = (1 << 63) - 1


def quantize(x: np.ndarray, scale: float = 256.0) -> np.ndarray:
    return np.floor(x * scale)


def _order(score: int) -> bytes:
    """Bytes in the order of whole numbers of any size."""
    body = abs(score).to_bytes((abs(score).bit_length() + 7) // 8, "big")
    body = len(body).to_bytes(2, "big") + body
    return b"\x01" + body if score >= 0 else b"\x00" + bytes(255 - x for x in body)


def search_block(q: np.ndarray, x: np.ndarray, low: np.ndarray, high: np.ndarray, floor: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the rows of x that may score ``floor`` or more (all, if None); low, high: x's extremes by term."""
    if floor is None:
        return np.arange(len(x)), x @ q
    most = np.maximum(q * low, q * high)
    order = np.argsort(-np.abs(q) * (high - low), kind="stable")
    # what all terms from place i on can add at most, and at least
    rest = np.append(np.cumsum(most[order][::-1])[::-1], 0.0)
    if rest[0] < floor:
        return np.empty(0, np.int64), np.empty(0)
    least = np.minimum(q * low, q * high)[order]
    start = np.append(0.0, np.cumsum(least))  # the essential terms at their least
    essential = int(np.argmax(np.append(start[:-1] + rest[:-1] < floor, True)))
    e = order[:essential]
    score = x[:, e] @ q[e]
    at = np.flatnonzero(score + rest[essential] >= floor)
    score = score[at]
    for i in range(essential, len(q), PROBE):
        if not len(at):
            break
        t = order[i : i + PROBE]
        score = score + x[np.ix_(at, t)] @ q[t]
        keep = score + rest[min(i + PROBE, len(q))] >= floor
        at, score = at[keep], score[keep]
    return at, score


class Wide:
    """A block of vectors and a query whose inner products may pass 2^53: screened in doubles, then exact."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.shift = int(np.frexp(np.abs(x).max(initial=1.0))[1])
        self.small = np.ldexp(x, -self.shift)  # at most 1
        self.low, self.high = self.small.min(axis=0), self.small.max(axis=0)

    def search(self, q: np.ndarray, mine: np.ndarray, floor: int | None, k: int) -> tuple[np.ndarray, list[int]]:
        """Places (none of ``mine``) and exact scores of all rows that score ``floor`` or more; of the k best, at least, if None."""
        shift = int(np.frexp(np.abs(q).max(initial=1.0))[1])
        small = np.ldexp(q, -shift)
        error = (len(q) + 4) ** 2 * 2.0**-52
        least = None
        if floor is not None:
            drop = max(0, abs(floor).bit_length() - 53)
            least = float(np.clip(np.ldexp(float(abs(floor) >> drop), min(drop - shift - self.shift, 2000)), 0, 1e300)) * (1 if floor >= 0 else -1) - 2 * error
        at, about = search_block(small, self.small, self.low, self.high, least)
        at, about = at[~mine[at]], about[~mine[at]]
        if floor is None and len(at) > k:
            keep = about >= np.partition(about, len(about) - k)[len(about) - k] - 2 * error
            at = at[keep]
        whole = [int(v) for v in q]
        return at, [sum(a * int(b) for a, b in zip(whole, row, strict=True) if a) for row in self.x[at]]


def top_k(vectors: DataFrame, id_col: str, vec_col: str, is_query: Column, k: int, prepare: Callable[[np.ndarray], np.ndarray] = quantize) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the k rows with the highest integer inner products."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"), is_query.alias("q")).where("id is not null and v is not null")

    def usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, x = matrix(b.column("v"))
            yield b.take(pa.array(at[np.isfinite(prepare(x)).all(axis=1)]))

    queries = rows.where("q").select("id", "v").mapInArrow(usable, "id long, v array<double>").groupBy("id").agg(F.max("v").alias("v"))
    size = queries.agg(F.coalesce(F.sum(F.size("v")), F.lit(0)) * 8).first()[0]
    blocks = max(1, -(-size // QUERY_BYTES))

    def searcher(held) -> Callable:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            qid, qs = held.value
            best: list[list[tuple[int, int]]] = [[] for _ in qid]  # of each query: (-score, id), in order
            floor: list[int | None] = [None] * len(qid)
            for big in batches:
                for s in range(0, big.num_rows, BLOCK):
                    b = big.slice(s, BLOCK)
                    at, x = matrix(b.column("v"))
                    ids = b.column("id").to_numpy()[at]
                    x = prepare(x)
                    fine = np.isfinite(x).all(axis=1)
                    ids, x = ids[fine], x[fine]
                    if not len(ids):
                        continue
                    width = max(x.shape[1], qs.shape[1])
                    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
                    q2 = np.pad(qs, ((0, 0), (0, width - qs.shape[1])))
                    far = float(np.abs(x).max(initial=0))
                    exact = np.abs(q2).max(axis=1, initial=0) < 2.0**53 / max(1.0, far) / max(1, width)  # sums of doubles are exact
                    wide = None if exact.all() else Wide(x)
                    low, high = x.min(axis=0), x.max(axis=0)
                    for i in range(len(qid)):
                        if exact[i]:
                            found, score = search_block(q2[i], x, low, high, None if floor[i] is None else max(-1e300, min(1e300, floor[i])))
                            other = ids[found] != qid[i]
                            found, score = found[other], score[other]
                            if len(found) > 4 * k:
                                cut = np.partition(score, len(score) - k)[len(score) - k]
                                found, score = found[score >= cut], score[score >= cut]
                        else:
                            found, score = wide.search(q2[i], ids == qid[i], floor[i], k)
                        more = [(-int(v), int(d)) for v, d in zip(score, ids[found], strict=True)]
                        if more:
                            best[i] = sorted(best[i] + more)[:k]
                            if len(best[i]) == k:
                                floor[i] = -best[i][-1][0]
            flat = [(int(qid[i]), d, max(-_LONG - 1, min(_LONG, -v)), _order(-v)) for i, found in enumerate(best) for v, d in found]
            for s in range(0, len(flat), 50_000):
                a, d, v, o = zip(*flat[s : s + 50_000], strict=True)
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in (a, d, v)], pa.array(o, pa.binary())], ["query_id", "vec_id", "score", "exact"])

        return work

    shards = None
    for n in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == n).toArrow()
        at, q = matrix(part["v"])
        q = prepare(q)
        fine = np.isfinite(q).all(axis=1)
        if not fine.any():
            continue
        held = spark.sparkContext.broadcast((part["id"].to_numpy()[at][fine], q[fine]))
        found = rows.select("id", "v").mapInArrow(searcher(held), "query_id long, vec_id long, score long, exact binary")
        shards = found if shards is None else shards.unionByName(found)
    if shards is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("exact"), "vec_id"))
    return shards.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
