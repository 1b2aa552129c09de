"""Exact removal of repeated passages: bytes covered by a string that also starts in a document with a smaller id.

1. Documents that repeat a whole text of a smaller id go at once. All others are packed into shards of SHARD_BYTES,
   written once and compressed; from then on a shard is known by its name.
2. Which strings can repeat at all: each string of ``length`` bytes has a least gram (by a hash of GRAM bytes), and equal
   strings have the same one. Each shard sends the sorted distinct least grams of its documents, by ranges of the hash; a
   range's task tells which of them other shards have too. Nothing is lost by that: hashes that happen to be equal only add work.
3. Each shard sorts the suffixes of its suspect text (Larsson and Sadakane: by seven bytes, then only groups that are still
   tied, by the ranks of what follows, so that the sorted length doubles) and takes common prefixes from Kasai's recurrence, in many
   stretches of the text at once. Neighbours that share ``length`` bytes are one string; its smallest id in the shard
   settles all others there.
4. What is left and may lie in other shards is sent by its least gram, neighbouring strings as one passage. A range's task
   sorts the strings of all shards by their hash, once; where hashes are equal, the bytes are compared. Strings around a gram
   that very many shards hold are dealt by a second gram too, the least by another hash, so that no range holds them all.
5. Verdicts return to the shards, which cut the covered bytes.

A string that is repeated thousands of times is sent once per shard. No task holds more than a shard, or a range of
what shards sent; ranges grow in number with the text.

Defined results: null text is empty and comes back empty; texts shorter than ``length`` are kept; of rows with the same id
none counts as smaller, each gives a row; rows without an id count as larger than all others, and as equal to each other; an empty
table gives no rows; other columns are ignored. A document is held whole by one task, however long; its suspect text is sorted
in parts of PART_BYTES.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.llm import store

#: Shards and ranges meet in a row each, so both are as large as a task's memory allows: their rows grow with the product.
SHARD_BYTES = 1 << 22
PART_BYTES = 1 << 19
#: Bytes of text whose grams a range holds, about.
RANGE_BYTES = 1 << 24
#: Stretches of a shard that are sent together, about.
HELD_STRETCHES = 1 << 19
#: Shards that hold a gram before the strings around it are dealt by a second gram too.
HOT_SHARDS = 64
#: Texts with whole copies whose digests (a row each) are broadcast; more of them are joined.
BROADCAST_ROWS = 100_000
#: Strings that a range's task compares at once.
SHARE_STRINGS = 1 << 19
GRAM = 24
_BLOCK = 1 << 15
_LAST = np.iinfo(np.int64).max
_U = np.uint64
_SHARD_CODEC = pa.Codec("zstd", compression_level=6)
_MULT, _MIX = 0x9E3779B97F4A7C15, _U(0xD6E8FEB86659FD93)


def hashes(data: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all strings of ``width`` bytes."""
    n = len(data) - width + 1
    if n <= 0:
        return np.empty(0, _U)
    h, w, power, out, have = data.astype(_U) + _U(1), 1, _MULT, None, 0
    while True:
        if width & w:
            out = h[:n] if out is None else out[:n] * _U(power) + h[have : have + n]
            have += w
        if 2 * w > width:
            break
        h = h[:-w] * _U(power) + h[w:]
        w, power = 2 * w, power * power % (1 << 64)
    out = (out ^ (out >> _U(32))) * _MIX
    return out ^ (out >> _U(29))


def _least(a: np.ndarray, w: int) -> np.ndarray:
    """The minimum of each w neighbours."""
    n, have = len(a) - w + 1, 1
    while 2 * have <= w:
        a, have = np.minimum(a[:-have], a[have:]), 2 * have
    return a if have == w else np.minimum(a[:n], a[w - have : w - have + n])


def window_runs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, count, least gram) of runs of strings that share their least gram; strings lie inside documents."""
    change = np.zeros(len(data) + 1, np.int8)
    long = sizes >= length
    change[starts[long]] += 1
    change[starts[long] + sizes[long] - length + 1] -= 1
    inside = np.cumsum(change[:-1], dtype=np.int8).astype(bool)
    first, count, value = [], [], []
    for s in range(0, len(data) - length + 1, _BLOCK):
        low = _least(hashes(data[s : s + _BLOCK + length - 1], gram), length - gram + 1)
        ok = inside[s : s + len(low)]
        new = np.append(True, (low[1:] != low[:-1]) | (ok[1:] != ok[:-1]))
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(low)))
        real = ok[at]
        first.append(at[real] + s)
        count.append(size[real])
        value.append(low[at[real]])
    if not first:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, _U)
    return np.concatenate(first), np.concatenate(count), np.concatenate(value)


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, int]:
    """Suffixes sorted by some bytes, ``depth`` at least, then by place; and by how many (Larsson and Sadakane's refinement, by whole arrays)."""
    n = len(data)
    padded = np.append(data, np.zeros(8, np.uint8))
    key = np.zeros(n, _U)
    for k in range(7):
        key = (key << _U(8)) | padded[k : k + n]
    key <<= _U(8)
    key |= np.minimum(np.arange(n, 0, -1), 7).astype(_U)  # the end of the text is less than any byte
    sa = np.argsort(key).astype(np.int32)
    key = key[sa]
    new = np.append(True, key[1:] != key[:-1])
    del key
    rank = np.empty(n, np.int32)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), 0))

    def ranked(at: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes at some places of sa by their rank and what comes after, and these two as one number."""
        i = sa[at]
        both = (rank[i].astype(np.int64) << 32) | after(i)
        order = np.argsort(both)
        return i[order], both[order]

    tied = lambda: np.flatnonzero(~(new & np.append(new[1:], True))).astype(np.int32)
    h = 7
    while h < depth:
        at = tied()
        i, both = ranked(at, lambda i: np.where(i < n - h, rank[np.minimum(i, n - 1 - min(h, n - 1)) + min(h, n - 1)] + 1, 0))  # noqa: B023
        sa[at] = i
        first = np.append(True, both[1:] != both[:-1])[: len(at)]
        new[at] |= first
        rank[i] = np.maximum.accumulate(np.where(first, at, 0))
        h *= 2
    at = tied()
    sa[at] = ranked(at, lambda i: i)[0]
    return sa, h


def common_prefixes(data: np.ndarray, sa: np.ndarray, most: int, stretch: int = 128) -> np.ndarray:
    """Bytes (at most ``most``, by which they are sorted) that each suffix shares with the one before it in order.

    Kasai's recurrence (a suffix shares at least one byte less than the suffix before it in the text did) runs along
    stretches of the text, all of them at once. Where that one shared ``most`` bytes, so that their order tells nothing of
    what follows, it holds only if the same place precedes both.
    """
    n = len(data)
    padded = np.append(data, np.zeros(most + 16, np.uint8))
    word = np.zeros(n + most + 8, _U)
    for k in range(8):
        word |= padded[k : k + len(word)].astype(_U) << _U(8 * k)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    out = np.zeros(n, np.int32)
    at = np.arange(0, n, stretch)
    shared, last = np.zeros(len(at), np.int64), np.full(len(at), -2)
    for _ in range(min(stretch, n)):
        p = before[at]
        shared = np.where((shared < most) | (p == last + 1), shared, 0)
        limit = np.where(p < 0, 0, np.minimum(most, n - np.maximum(at, p)))
        shared = np.minimum(np.maximum(shared - 1, 0), limit)
        todo = np.flatnonzero(shared < limit)
        while len(todo):
            x = word[at[todo] + shared[todo]] ^ word[p[todo] + shared[todo]]
            same = x == 0
            lowest = (x & (~x + _U(1))).astype(np.float64)
            shared[todo] = np.minimum(shared[todo] + np.where(same, 8, (np.frexp(lowest)[1] - 1) >> 3), limit[todo])
            todo = todo[same & (shared[todo] < limit[todo])]
        out[at] = shared
        at, last = at + 1, p
        if at[-1] >= n:
            at, shared, last = at[:-1], shared[:-1], last[:-1]
        if not len(at):
            break
    return out[sa]


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of stretches, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers in few bytes: planes of equal weight lie together."""
    out = [np.array([len(a) for a in arrays], np.int64).tobytes()]
    for a in arrays:
        a = a.astype(np.int64)
        out.append(np.ascontiguousarray(np.diff(a, prepend=0).view(np.uint8).reshape(-1, 8).T).tobytes())
    return pa.compress(b"".join([len(arrays).to_bytes(8, "little"), *out]), codec="zstd", asbytes=True)


def _unpacked(data: bytes, size: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(data, size, codec="zstd", asbytes=True), np.uint8)
    n = int(raw[:8].view(np.int64)[0])
    sizes, at, out = raw[8 : 8 + 8 * n].view(np.int64), 8 + 8 * n, []
    for m in sizes.tolist():
        out.append(np.cumsum(np.ascontiguousarray(raw[at : at + 8 * m].reshape(8, m).T).view(np.int64).ravel()))
        at += 8 * m
    return out


def _packed_size(*arrays: np.ndarray) -> int:
    return 8 + 8 * len(arrays) + 8 * sum(len(a) for a in arrays)


def _shards(batches: Iterator[pa.RecordBatch], shard_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, text) packed: shard, ids, sizes, bytes, data (compressed)."""
    task, n = TaskContext.get().partitionId(), 0
    ids, texts, size = [], [], 0

    def one() -> pa.RecordBatch:
        whole = b"".join(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array([(task << 33) + n]), pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([len(whole)], pa.int64()), pa.array([_SHARD_CODEC.compress(whole, asbytes=True)], pa.binary())],
            ["shard", "ids", "sizes", "bytes", "data"],
        )

    for b in batches:
        for i, t in zip(b.column("id").to_pylist(), b.column("text"), strict=True):
            t = t.as_py()
            if size + len(t) > shard_bytes and ids:
                yield one()
                n, ids, texts, size = n + 1, [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t)
    if ids:
        yield one()


class _Shard:
    """A shard's text with its runs of strings and their least grams."""

    def __init__(self, ids: list, sizes: list[int], raw: int, data: bytes, length: int, gram: int, bits: int):
        self.ids, self.width = ids, gram
        self.order = np.array([_LAST if i is None else i for i in ids], np.int64)
        self.sizes = np.array(sizes, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(pa.decompress(data, raw, codec="zstd", asbytes=True), np.uint8) if raw else np.empty(0, np.uint8)
        self.first, self.count, value = window_runs(self.data, self.starts, self.sizes, length, gram)
        value = value * _U(_MULT)  # least hashes are small: hashed anew, ranges are even
        self.gram = ((value ^ (value >> _U(31))) * _MIX) >> _U(64 - bits)
        self.doc = self.order[np.searchsorted(self.starts, self.first, "right") - 1] if len(self.first) else np.empty(0, np.int64)

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct least grams in order, and whether several documents here hold them."""
        if not len(self.gram):
            return np.empty(0, _U), np.empty(0, bool)
        order = np.argsort(self.gram, kind="stable")
        g, d = self.gram[order], self.doc[order]
        new = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
        return g[new], np.minimum.reduceat(d, new) != np.maximum.reduceat(d, new)


def _cuts(grams: np.ndarray, shift: int) -> Iterator[tuple[int, slice]]:
    """Ranges of sorted grams and where they lie."""
    if len(grams):
        of = (grams >> _U(shift)).astype(np.int64)
        at = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        for a, b in zip(at.tolist(), [*at[1:].tolist(), len(grams)], strict=True):
            yield int(of[a]), slice(a, b)


def _rows_of(batch: pa.RecordBatch, *cols: str) -> Iterator[tuple]:
    """Rows one by one: a batch's data isn't copied at once."""
    held = [batch.column(c) for c in cols]
    return (tuple(c[i].as_py() for c in held) for i in range(batch.num_rows))


def _grouped(batches: Iterator[pa.RecordBatch], key: str, *cols: str) -> Iterator[tuple[int, list[tuple]]]:
    """(key, rows) of neighbouring rows with the same key, also across batches."""
    now, held = None, []
    for b in batches:
        for k, *row in _rows_of(b, key, *cols):
            if k != now and held:
                yield now, held
                held = []
            now = k
            held.append(tuple(row))
    if held:
        yield now, held


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Record batches of some MB."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes)) + 64
        if size > 1 << 23:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


_GRAMS = pa.schema([("range", pa.int64()), ("shard", pa.int64()), ("n", pa.int64()), ("grams", pa.binary())])
_MASKS = pa.schema([("shard", pa.int64()), ("range", pa.int64()), ("n", pa.int64()), ("mask", pa.binary())])
_PARTS = pa.schema([("range", pa.int64()), ("shard", pa.int64()), ("part", pa.int64()), ("size", pa.int64()), ("runs", pa.binary()), ("n", pa.int64()), ("text", pa.binary())])
_FOUND = pa.schema([("shard", pa.int64()), ("part", pa.int64()), ("range", pa.int64()), ("size", pa.int64()), ("runs", pa.binary()), ("mask", pa.binary())])
_SQL = {pa.int64(): "long", pa.binary(): "binary"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_SQL[f.type]}" for f in schema)


def _met(rows: list[tuple], hot_shards: int) -> Iterator[tuple]:
    """Of a range: for each shard's grams, which ones other shards hold, and which very many do."""
    each = [_unpacked(g, _packed_size(range(n)))[0] for _, n, g in rows]
    sizes = [len(g) for g in each]
    all_ = np.concatenate(each)
    order = np.argsort(all_, kind="stable")
    g = all_[order]
    at = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
    n = np.diff(np.append(at, len(g)))
    held = np.empty(len(g), np.int64)
    held[order] = np.repeat(n, n)
    for (shard, _, _), part in zip(rows, np.split(held, np.cumsum(sizes)[:-1]), strict=True):
        yield shard, len(part), np.packbits(part > 1).tobytes() + np.packbits(part > hot_shards).tobytes()


def _bits_of(mask: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    m = np.frombuffer(mask, np.uint8)
    half = len(m) // 2
    return np.unpackbits(m[:half], count=n).astype(bool), np.unpackbits(m[half:], count=n).astype(bool)


def _local(s: _Shard, runs: np.ndarray, length: int, part_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of parts of the suspect runs: the places of their strings, their runs, and which a smaller id in the part settles."""
    size = s.count[runs] + length - 1
    part = (np.cumsum(size) - size) // part_bytes
    for p in np.unique(part):
        own = runs[part == p]
        first, count = s.first[own], s.count[own]
        joined = np.flatnonzero(np.append(True, first[1:] != first[:-1] + count[:-1]))  # neighbouring runs are one segment
        total = np.add.reduceat(count, joined) + length - 1
        places = _spread(first[joined], total)
        text = s.data[places]
        real = np.ones(len(text), bool)
        real[_spread(np.cumsum(total) - length + 1, np.full(len(total), length - 1))] = False  # a segment's last bytes begin no string of it
        sa, depth = suffix_array(text, length)
        kind = np.cumsum(common_prefixes(text, sa, depth) < length)
        sa, kind = sa[real[sa]], kind[real[sa]]
        doc = np.zeros(len(text), np.int64)
        doc[real] = np.repeat(s.doc[own], count)
        doc = doc[sa]
        new = np.flatnonzero(np.append(True, kind[1:] != kind[:-1]))
        least = np.repeat(np.minimum.reduceat(doc, new), np.diff(np.append(new, len(kind))))
        settled = np.zeros(len(text), bool)
        settled[sa] = doc > least
        yield places[real], np.repeat(own, count), settled[real]


def _stretches(places: np.ndarray, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(first, count) of neighbouring ascending places; ``breaks`` tells where one begins in any case."""
    if not len(places):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.append(True, places[1:] != places[:-1] + 1)
    at = np.flatnonzero(new if breaks is None else new | breaks)
    return places[at], np.diff(np.append(at, len(places)))


def _suspects(s: _Shard, shard: int, masks: list[tuple], length: int, bits: int, shift: int, part_bytes: int) -> Iterator[tuple]:
    """Rows of _PARTS: what is sent, by range, and (range -1) what is settled here and where the sent strings lie."""
    grams, several = s.grams()
    there, hot = np.zeros(len(grams), bool), np.zeros(len(grams), bool)
    given = {r: (n, m) for r, n, m in masks}
    for r, at in _cuts(grams, shift):
        there[at], hot[at] = _bits_of(given[r][1], given[r][0])
    of = np.searchsorted(grams, s.gram)
    there, several, hot = there[of], several[of], hot[of]
    run_at = np.zeros(len(s.data) + 1, bool)
    run_at[s.first] = True
    runs = np.flatnonzero(there | several)
    if (s.count[runs] + length - 1).sum() > part_bytes:
        there = there | several  # the parts of the shard meet like those of others
    held: list[tuple] = []
    size = n = 0

    def sent_rows() -> Iterator[tuple]:
        """What the parts since the last call leave: a row per range, however many parts they are."""
        gone, times, first, count, run, to = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.argsort(to, kind="stable")
        first, count, run, to = first[order], count[order], run[order], to[order]
        home = gone, times, first, count, to
        yield -1, shard, n, _packed_size(*home), _packed(*home), 0, b""
        for r, at in _cuts(to.astype(_U), 0):
            text = s.data[_spread(first[at], count[at] + length - 1)].tobytes()
            found = s.doc[run[at]], count[at]
            yield r, shard, n, _packed_size(*found), _packed(*found), len(text), pa.compress(text, codec="zstd", asbytes=True)

    for places, run, settled in _local(s, runs, length, part_bytes):
        gone = _stretches(places[settled])
        sent = ~settled & there[run]
        places, run = places[sent], run[sent]
        spot, twice = s.gram[run], hot[run]
        if twice.any():  # strings around a gram that very many shards hold go by a second gram too
            spot[twice] = _second(s, places[twice], spot[twice], length, bits)
        breaks = run_at[places] | (twice & np.append(True, spot[1:] != spot[:-1]))
        first, count = _stretches(places, breaks)
        at = np.searchsorted(places, first)
        run, spot = run[at], spot[at]
        to = (spot >> _U(max(0, shift - 1))).astype(np.int64)  # passages are longer than grams, so their ranges are finer
        held.append((*gone, first, count, run, to))
        size += len(gone[0]) + len(first)
        if size > HELD_STRETCHES:
            yield from sent_rows()
            held, size, n = [], 0, n + 1
    if held:
        yield from sent_rows()


def _second(s: _Shard, places: np.ndarray, spot: np.ndarray, length: int, bits: int) -> np.ndarray:
    """Hashes of strings' least grams with their least grams by another hash: alike strings mostly stay together."""
    first, count = _stretches(places)
    total = count + length - 1
    h = hashes(s.data[_spread(first, total)], s.width)
    low = _least((h ^ (h >> _U(31))) * _U(_MULT), length - s.width + 1)[_spread(np.cumsum(total) - total, count)]
    low = (low ^ spot) * _MIX
    return ((low ^ (low >> _U(29))) * _U(_MULT)) >> _U(64 - bits)


def _differ(words: np.ndarray, p: np.ndarray, q: np.ndarray, length: int) -> np.ndarray:
    """Whether the strings at places p and q differ. words: what begins at each byte, eight bytes or one."""
    step = words.dtype.itemsize
    out = np.zeros(len(p), bool)
    for o in [*range(0, length - step + 1, step), length - step]:
        out |= words[p + o] != words[q + o]
    return out


def _merged(rows: list[tuple], length: int) -> Iterator[tuple]:
    """Of a range: for each shard's strings, whether a smaller id elsewhere holds them. Strings are sorted by their hash and compared a share at a time."""
    docs, runs, places, texts, sizes, begin, n_runs = [], [], [], [], [], 0, 0
    for _, _, size, packed, n, text in rows:
        doc, count = _unpacked(packed, size)
        total = count + length - 1
        places.append((_spread(np.cumsum(total) - total, count) + begin).astype(np.int64 if begin + n >= 1 << 31 else np.int32))
        docs.append(doc)
        runs.append(np.repeat(np.arange(n_runs, n_runs + len(doc), dtype=np.int32), count))
        sizes.append(int(count.sum()))
        texts.append(np.frombuffer(pa.decompress(text, n, codec="zstd", asbytes=True), np.uint8))
        begin, n_runs = begin + n, n_runs + len(doc)
    whole, doc, run, place = np.concatenate(texts), np.concatenate(docs), np.concatenate(runs), np.concatenate(places)
    del texts, docs, runs, places
    strings = np.lib.stride_tricks.sliding_window_view(whole, length)
    words = np.ndarray((len(whole) - 7,), np.uint64, whole.data, strides=(1,)) if length >= 8 else whole
    keys = np.empty(len(place), _U)
    edges = np.append(np.searchsorted(place, np.arange(0, len(strings), _BLOCK)), len(place))  # places ascend
    for k, (s, e) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        if s < e:
            keys[s:e] = hashes(whole[k * _BLOCK : (k + 1) * _BLOCK + length - 1], length)[place[s:e] - k * _BLOCK]
    order = np.argsort(keys)
    keys = keys[order]
    later = np.zeros(len(keys), bool)
    s = 0
    while s < len(keys):
        e = int(np.searchsorted(keys, keys[min(s + SHARE_STRINGS, len(keys)) - 1], "right"))  # equal hashes stay together
        k, own = keys[s:e], order[s:e]
        s = e
        new = np.append(True, k[1:] != k[:-1])
        tied = ~(new & np.append(new[1:], True))
        own, new = own[tied], new[tied]  # a string that comes once stays
        if not len(own):
            continue
        at = np.flatnonzero(new)
        slot = np.cumsum(new) - 1
        d, p = doc[run[own]], place[own]
        one = p[at][slot]
        out = d > np.minimum.reduceat(d, at)[slot]
        odd = np.zeros(len(at), bool)  # equal hashes of different strings
        for m in range(0, len(p), 1 << 14):
            m = slice(m, m + (1 << 14))
            odd[slot[m][_differ(words, p[m], one[m], length)]] = True
        exact: dict[bytes, int] = {}
        unclear = np.flatnonzero(odd[slot]).tolist()
        for i in unclear:
            key = strings[p[i]].tobytes()
            exact[key] = min(exact.get(key, _LAST), int(d[i]))
        for i in unclear:
            out[i] = int(d[i]) > exact[strings[p[i]].tobytes()]
        later[own] = out
    ends = np.cumsum(sizes).tolist()
    for (shard, part, *_), n, e in zip(rows, sizes, ends, strict=True):
        yield shard, part, np.packbits(later[e - n : e]).tobytes()


def _covered(n: int, parts: dict[int, tuple], verdicts: dict[tuple[int, int], bytes], length: int) -> np.ndarray:
    """Which bytes of a shard go."""
    begins = np.zeros(n + 1, bool)
    for part, (size, home) in parts.items():
        gone, times, first, count, to = _unpacked(home, size)
        begins[_spread(gone, times)] = True
        for r, at in _cuts(to.astype(_U), 0):
            places = _spread(first[at], count[at])
            begins[places[np.unpackbits(np.frombuffer(verdicts[part, r], np.uint8), count=len(places)).astype(bool)]] = True
    so_far = np.cumsum(begins[:n], dtype=np.int64)
    so_far[length:] -= so_far[:-length].copy()
    return so_far > 0


def _kept(ids: list, sizes: np.ndarray, data: np.ndarray, gone: np.ndarray) -> pa.RecordBatch:
    ends = np.cumsum(sizes)
    edge = np.zeros(len(data) + 1, bool)
    edge[ends - sizes] = True
    at = np.flatnonzero(gone)
    first, count = _stretches(at, edge[at])
    of = np.searchsorted(ends, first, "right")
    spans = pa.StructArray.from_arrays([pa.array(first - (ends - sizes)[of]), pa.array(count)], ["start", "length"])
    offsets = np.append(0, np.cumsum(np.bincount(of, minlength=len(sizes)))).astype(np.int32)
    left = np.append(0, np.cumsum(~gone))[np.append(0, ends)]
    kept = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(left.astype(np.int64).tobytes()), pa.py_buffer(data[~gone].tobytes())]).cast(pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), spans), kept], ["id", "n_bytes", "spans", "kept"])


def _whole_copies(rows: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """rows (id, text) apart: those that repeat the whole text of a smaller id, as results, and all others."""
    digest = F.when(F.octet_length("text") >= length, F.sha2("text", 256))
    order = F.coalesce(F.col("id"), F.lit(_LAST))
    met = rows.select(digest.alias("whole"), order.alias("order")).where("whole is not null").groupBy("whole").agg(F.min("order").alias("least"), F.max("order").alias("most"))
    met = store.cut(met.where("least < most").select("whole", "least"), "copies")
    few = met.count() <= BROADCAST_ROWS
    marked = rows.withColumn("whole", digest).join(F.broadcast(met) if few else met, "whole", "left")
    copy = F.coalesce(order > F.col("least"), F.lit(False))
    size = F.octet_length("text").cast("long")
    gone = marked.where(copy).select("id", size.alias("n_bytes"), F.array(F.struct(F.lit(0).cast("long").alias("start"), size.alias("length"))).alias("spans"), F.lit(b"").alias("kept"))
    return gone, marked.where(~copy).select("id", "text")


def without_repeats(docs: DataFrame, id_col: str, text_col: str, length: int = 50, shard_bytes: int = SHARD_BYTES, part_bytes: int = PART_BYTES, range_bytes: int = RANGE_BYTES, hot_shards: int = HOT_SHARDS) -> DataFrame:
    """id, n_bytes, spans (start and length of what goes, by byte), kept (the bytes that stay): a row per document.

    Tables are written in the caller's scratch.
    """
    if length < 2:
        raise ValueError("strings of two bytes or more")
    gram = min(GRAM, max(1, length // 2))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    gone, rows = _whole_copies(rows, length)
    shards = store.cut(rows.mapInArrow(lambda batches: _shards(batches, shard_bytes), "shard long, ids array<long>, sizes array<long>, bytes long, data binary"), "shards")
    total = shards.agg(F.sum("bytes")).first()[0] or 0
    bits = min(56, max(32, total.bit_length() + 8))
    shift = bits - max(0, (total // range_bytes).bit_length())
    cols = ("shard", "ids", "sizes", "bytes", "data")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for b in batches:
                for shard, *rest in _rows_of(b, *cols):
                    g, _ = _Shard(*rest, length, gram, bits).grams()
                    for r, at in _cuts(g, shift):
                        yield r, shard, at.stop - at.start, _packed(g[at].astype(np.int64) - (r << shift))

        return _batched(each(), _GRAMS)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(((shard, r, n, mask) for r, part in _grouped(batches, "range", "shard", "n", "grams") for shard, n, mask in _met(part, hot_shards)), _MASKS)

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for b in batches:
                for shard, *rest, masks in _rows_of(b, *cols, "masks"):
                    yield from _suspects(_Shard(*rest, length, gram, bits), shard, [(m["range"], m["n"], m["mask"]) for m in masks], length, bits, shift, part_bytes)

        return _batched(each(), _PARTS)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for r, of in _grouped(batches, "range", "shard", "part", "size", "runs", "n", "text"):
                if r < 0:
                    yield from ((shard, part, r, size, runs, None) for shard, part, size, runs, _, _ in of)
                else:
                    yield from ((shard, part, r, None, None, mask) for shard, part, mask in _merged(of, length))

        return _batched(each(), _FOUND)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, ids, sizes, raw, data, found in _rows_of(b, *cols, "found"):
                text = np.frombuffer(pa.decompress(data, raw, codec="zstd", asbytes=True), np.uint8) if raw else np.empty(0, np.uint8)
                home = {x["part"]: (x["size"], x["runs"]) for x in found or [] if x["range"] < 0}
                verdicts = {(x["part"], x["range"]): x["mask"] for x in found or [] if x["range"] >= 0}
                yield _kept(ids, np.array(sizes, np.int64), text, _covered(len(text), home, verdicts, length))

    sent = shards.mapInArrow(grams, _ddl(_GRAMS)).repartition("range").sortWithinPartitions("range")
    masks = store.cut(sent.mapInArrow(met, _ddl(_MASKS)), "masks")
    masks = masks.groupBy(F.col("shard").alias("s_")).agg(F.collect_list(F.struct("range", "n", "mask")).alias("masks"))
    parts = shards.join(masks, F.col("shard") == F.col("s_")).select(*cols, "masks").mapInArrow(suspects, _ddl(_PARTS))
    # passages meet by range; what stays at home passes through
    key = F.when(F.col("range") >= 0, F.col("range")).otherwise(-1 - F.pmod(F.xxhash64("shard", "part"), F.lit(1 << 40)))
    met_again = parts.withColumn("key", key).repartition("key").sortWithinPartitions("key").drop("key")
    found = store.cut(met_again.mapInArrow(merged, _ddl(_FOUND)), "found")
    found = found.groupBy(F.col("shard").alias("s_")).agg(F.collect_list(F.struct("part", "range", "size", "runs", "mask")).alias("found"))
    kept_rows = shards.join(found, F.col("shard") == F.col("s_"), "left").select(*cols, "found").mapInArrow(kept, "id long, n_bytes long, spans array<struct<start:long,length:long>>, kept binary")
    return kept_rows.unionByName(gone)
