"""Near duplicates by circulant MinHash, with exact verification.

Signatures: one permutation spreads shingles over POSITIONS places (a mixed 64-bit hash), a second one gives each place
its value, and coordinate k is the least value over the set after shifting the second permutation by k places. Bands of
coordinates are bucket keys.

A bucket is never expanded into pairs. Its members are linked to one leader, picked by a hash of bucket and member.
Signature distance is a metric, so if all members are within LINK of the leader, any two similar members share that
leader's *family*; where some are not, the bucket goes into another round without its leader and without members so close
to it that nobody outside can be similar to them. Families are connected components of these links, and every similar
pair that shares a bucket lies within a family.

Within a family links are confirmed on full sets: all pairs of a small family, in one task; in a large one, members are
first confirmed against their best leaders. A family that this leaves in several components is split into finer ones by
the shingles that similar sets must share among their rarest, and only members outside the largest component of a finer
family are compared with all others of it, block by block. Members with equal sets count once throughout. No cap drops a pair: past ROUNDS rounds a bucket's
rest joins its leader's family as it is.

The chance that two sets of similarity 0.8 share no bucket is 7e-6 with BANDS x ROWS = 30 x 5. LINK and CLOSE are decided
on SKETCH of the coordinates, with margins that make a further loss of about that size; all else is exact up to collisions
of 64-bit hashes. Rows of hot buckets, leaders and classes are dealt over several tasks.

Defined results: null and empty texts have 0 shingles and are linked with nothing; fewer words than a shingle make one
shingle; rows with shingles that share an id are linked, whatever their texts; rows without an id are unlinked, kept and
have a null component; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from innkeep.llm import skew, store
from innkeep.llm.components import components, roots

BANDS, ROWS = 30, 5
POSITIONS = 1 << 18
SKETCH = 64
LINK, CLOSE = 0.3, 0.7
ROUNDS = 3
SMALL_FAMILY = 400
SAMPLE = 256
RUN_BYTES = 1_000_000
BROADCAST_IDS = 500_000
_BLOCK_A, _BLOCK_B = 256, 1024

_K = BANDS * ROWS
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SECOND = _rng.permutation(POSITIONS).astype(np.uint32)
_WINDOWS = np.lib.stride_tricks.sliding_window_view(np.concatenate([_SECOND, _SECOND[:_K]]), _K)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, p in enumerate((_P, _P_INV)):
            a = np.full(n, p, np.uint64)
            a[0] = 1
            _POWERS[i] = np.cumprod(a)
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased, and the number of words of each text."""
    low = [(t or b"").lower() for t in texts]
    b = np.frombuffer(b" " + b" ".join(low) + b" ", np.uint8)
    space = _SPACE[b]
    start = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    end = np.flatnonzero(~space[:-1] & space[1:]) + 1
    up, down = _powers(len(b) + 1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE[b] * up[:-1], out=sums[1:])
    h = _mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    at = np.cumsum([1] + [len(t) + 1 for t in low])
    return h, np.diff(np.searchsorted(start, at))


def shingle_sets(texts: list[bytes | None], n: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's n-word shingles."""
    h, counts = word_hashes(texts)
    mult = [_mix(np.array([k + 1], np.uint64))[0] | np.uint64(1) for k in range(n)]
    out, at = [], 0
    rolled = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for k in range(n):
        rolled += h[k : len(h) - n + 1 + k] * mult[k]
    rolled = _mix(rolled)
    for c in counts.tolist():
        if c >= n:
            out.append(np.unique(rolled[at : at + c - n + 1]))
        elif c:
            short = np.zeros(1, np.uint64)
            for k in range(c):
                short += h[at + k : at + k + 1] * mult[k]
            out.append(_mix(short + np.uint64(c)))
        else:
            out.append(np.empty(0, np.uint64))
        at += c
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    place = (shingles >> np.uint64(46)).astype(np.int64)
    least = np.full(_K, POSITIONS, np.uint32)
    for i in range(0, len(place), 2048):
        np.minimum(least, _WINDOWS[place[i : i + 2048]].min(axis=0), out=least)
    return least


def _slices(b: pa.RecordBatch, column: str) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most about RUN_BYTES of text."""
    size = pc.binary_length(b.column(column)).fill_null(0).to_numpy(zero_copy_only=False).cumsum()
    i = 0
    while i < b.num_rows:
        j = int(np.searchsorted(size, (size[i - 1] if i else 0) + RUN_BYTES, "right"))
        j = min(max(j, i + 1), b.num_rows)
        yield i, j
        i = j


def features(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """id, n_shingles, digest (of the set; null if empty), sketch and bands of each row."""
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        band = _mix(np.arange(1, BANDS + 1, dtype=np.uint64))
        for b in batches:
            for i, j in _slices(b, "text"):
                part = b.slice(i, j - i)
                cols: list[list] = [part.column("id").to_pylist(), [], [], [], []]
                for s in shingle_sets(part.column("text").to_pylist(), n):
                    cols[1].append(len(s))
                    if not len(s):
                        for c in cols[2:]:
                            c.append(None)
                        continue
                    sig = signature(s)
                    keys = band.copy()
                    for k in range(ROWS):
                        keys = _mix(keys * np.uint64(3) + sig[k::ROWS])
                    cols[2].append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    cols[3].append(sig[:SKETCH].astype(np.uint8).tobytes())
                    cols[4].append(keys.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["id", "n_shingles", "digest", "sketch", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")).mapInArrow(
        work, "id long, n_shingles long, digest binary, sketch binary, bands array<long>"
    )


def _estimates(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Adds est, the share of equal coordinates, to pairs (leader, id)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                one, two = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, SKETCH) for c in ("s1", "s2"))
                same = ((one == two).mean(axis=1) - 1 / 256) * (256 / 255)
                yield pa.RecordBatch.from_arrays([b.column("leader"), b.column("id"), pa.array(same)], ["leader", "id", "est"])

    one = sketches.select(F.col("id").alias("leader"), F.col("sketch").alias("s1"))
    return skew.spread_join(pairs, one, ["leader"], F.xxhash64("id")).join(sketches.select("id", F.col("sketch").alias("s2")), "id").mapInArrow(work, "leader long, id long, est double")


def family_links(classes: DataFrame) -> DataFrame:
    """leader, id, est: links whose components are the families. classes: id, sketch, bands; written tables."""
    spark = classes.sparkSession
    entries = classes.select("id", F.explode("bands").alias("key"))
    sketches = classes.select("id", "sketch")
    links: DataFrame | None = None
    for number in range(ROUNDS):
        lead = entries.groupBy("key").agg(F.min(F.struct(F.xxhash64("key", "id").alias("h"), F.col("id").alias("leader"))).alias("m"), F.count("*").alias("n"))
        lead = store.cut(lead.where("n > 1").select("key", F.col("m.leader").alias("leader"), "n"), "nd-leaders")
        sizes = lead.select("key", "n")
        led = store.cut(skew.spread_join(entries, lead.drop("n"), ["key"], F.xxhash64("id"), sizes).where("id <> leader"), "nd-buckets")
        est = store.cut(_estimates(store.cut(led.select("leader", "id").distinct(), "nd-pairs"), sketches), "nd-estimates")
        last = number == ROUNDS - 1
        good = est if last else est.where(F.col("est") >= LINK)
        links = good if links is None else links.unionByName(good)
        if last or est.where(F.col("est") < LINK).isEmpty():
            break
        led = led.join(est, ["leader", "id"])
        torn = led.where(F.col("est") < LINK).select("key").distinct()
        entries = store.cut(skew.spread_join(led.where(F.col("est") < CLOSE), torn, ["key"], F.xxhash64("id"), sizes).select("id", "key"), "nd-rest")
        if entries.isEmpty():
            break
    return links if links is not None else spark.createDataFrame([], "leader long, id long, est double")


def member_sets(docs: DataFrame, id_col: str, text_col: str, n: int, members: DataFrame) -> DataFrame:
    """id, fam, large and set (sorted 64-bit hashes) of the members (id, fam, large), from their texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in _slices(b, "text"):
                part = b.slice(i, j - i)
                sets = [s.tobytes() for s in shingle_sets(part.column("text").to_pylist(), n)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", "fam", "large")), pa.array(sets, pa.binary())], ["id", "fam", "large", "set"])

    if members.count() <= BROADCAST_IDS:
        members = F.broadcast(members)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")).join(members, "id")
    return texts.mapInArrow(work, "id long, fam long, large boolean, set binary")


def intersections(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of one with each of two."""
    out = np.zeros((len(one), len(two)), np.float32)
    h = np.concatenate([*one, *two])
    side = np.repeat([0, 1], [sum(map(len, one)), sum(map(len, two))])
    row = np.concatenate([np.repeat(np.arange(len(x)), list(map(len, x))) for x in (one, two)])
    order = np.argsort(h, kind="stable")
    h, side, row = h[order], side[order], row[order]
    word = np.cumsum(np.append(False, h[1:] != h[:-1])) if len(h) else np.empty(0, np.int64)
    both = (np.bincount(word, side == 0) > 0) & (np.bincount(word, side == 1) > 0) if len(h) else np.empty(0, bool)
    keep = both[word]
    word, side, row = (np.cumsum(both) - 1)[word[keep]], side[keep], row[keep]
    for i in range(0, int(both.sum()), 8192):
        now = (word >= i) & (word < i + 8192)
        a, b = np.zeros((len(one), 8192), np.float32), np.zeros((len(two), 8192), np.float32)
        a[row[now & (side == 0)], word[now & (side == 0)] - i] = 1
        b[row[now & (side == 1)], word[now & (side == 1)] - i] = 1
        out += a @ b.T
    return out


def _linked(one: list[np.ndarray], two: list[np.ndarray], num: int, den: int) -> np.ndarray:
    inter = intersections(one, two)
    size = np.array(list(map(len, one)))[:, None] + np.array(list(map(len, two)))[None] - inter
    return (den * inter >= num * size) & (inter > 0)


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, from batches sorted by it."""
    rest: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = np.stack([b.column(c).to_numpy() for c in keys])
        cuts = np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1
        if rest and any(rest[0].column(c)[0] != b.column(c)[0] for c in keys):
            yield pa.Table.from_batches(rest)
            rest = []
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows], strict=True):
            rest.append(b.slice(i, j - i))
            if j < b.num_rows:
                yield pa.Table.from_batches(rest)
                rest = []
    if rest:
        yield pa.Table.from_batches(rest)


def _sets(t: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in t.column("set").to_pylist()]


def _small_families(sets: DataFrame, num: int, den: int) -> DataFrame:
    """a, b: links that connect the members of each small family, from all its pairs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _grouped(batches, ["fam"]):
            s = _sets(t)
            ids = t.column("id").to_numpy()
            i, j = np.nonzero(np.triu(_linked(s, s, num, den), 1))
            root = roots(len(s), i, j)
            hit = [k for k in range(len(s)) if root[k] != k]
            yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(ids[[root[k] for k in hit]])], ["a", "b"])

    return sets.repartition("fam").sortWithinPartitions("fam").mapInArrow(work, "a long, b long")


def _star(sets: DataFrame, links: DataFrame, num: int, den: int) -> DataFrame:
    """a, b: confirmed links between the members of large families and their three most similar leaders."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (big.slice(i, j - i) for big in batches for i, j in _slices(big, "s2")):
            one, two = ([np.frombuffer(x, np.uint64) for x in b.column(c).to_pylist()] for c in ("s1", "s2"))
            inter = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(one, two, strict=True)])
            size = np.array([len(x) + len(y) for x, y in zip(one, two, strict=True)]) - inter
            ok = pa.array(den * inter >= num * size)
            yield pa.RecordBatch.from_arrays([b.column("leader").filter(ok), b.column("id").filter(ok)], ["a", "b"])

    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("est"), "leader"))
    best = store.cut(links.where(F.col("est") >= 0.6).withColumn("rank", rank).where("rank <= 3").select("leader", "id"), "nd-best")
    joined = skew.spread_join(best, sets.select(F.col("id").alias("leader"), F.col("set").alias("s1")), ["leader"], F.xxhash64("id")).join(sets.select("id", F.col("set").alias("s2")), "id")
    return joined.mapInArrow(work, "a long, b long")


def _refined(rows: DataFrame, num: int, den: int) -> DataFrame:
    """rows (fam, id, set, comp) of families that are torn into several components, with fam replaced by a finer one.

    In any one order of a family's shingles, two sets as similar as asked share one among their first
    n - ceil(num * n / den) + 1. Members are linked through these, so similar ones stay in one family. The order puts
    shingles last that are frequent in a sample of the family, such as those of a passage that all members hold; it is
    only the number of links that depends on the sample.
    """

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _grouped(batches, ["fam"]):
            h, n = np.unique(np.concatenate(_sets(t)), return_counts=True)
            often = n >= 3
            yield pa.RecordBatch.from_arrays([pa.array([t.column("fam")[0].as_py()]), pa.array([h[often].tobytes()], pa.binary()), pa.array([n[often].astype(np.int32).tobytes()], pa.binary())], ["fam", "set", "n"])

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fam, often, counts = None, np.empty(0, np.uint64), np.empty(0, np.int32)
        for b in (big.slice(i, j - i) for big in batches for i, j in _slices(big, "set")):
            ids, nodes = [], []
            for f, i, part, n in zip(*(b.column(c).to_pylist() for c in ("fam", "id", "set", "n")), strict=True):
                h = np.frombuffer(part, np.uint64)
                if n is not None or f != fam:
                    fam = f
                    often, counts = (h, np.frombuffer(n, np.int32)) if n is not None else (often[:0], counts[:0])
                if n is not None:
                    continue
                at = np.minimum(np.searchsorted(often, h), max(len(often) - 1, 0))
                known = often[at] == h if len(often) else np.zeros(len(h), bool)
                first = len(h) - -(-num * len(h) // den) + 1
                order = np.concatenate([h[~known], h[known][np.argsort(counts[at[known]], kind="stable")]]) if first > (~known).sum() else h[~known]
                node = _mix(order[:first] ^ _mix(np.array([f], np.int64).view(np.uint64))).view(np.int64)
                ids.append(np.full(len(node), i, np.int64))
                nodes.append(node)
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(nodes))], ["a", "b"])

    torn = rows.groupBy("fam").agg(F.min("comp").alias("one"), F.max("comp").alias("last"), F.count("*").alias("members")).where("one <> last").select("fam", "members", F.ceil(F.col("members") / 4096).cast("int").alias("parts"))
    torn = store.cut(torn, "nd-torn")
    sizes = torn.select("fam", F.col("members").alias("n"))
    rows = store.cut(skew.spread_join(rows, torn.drop("members"), ["fam"], F.xxhash64("id"), sizes), "nd-torn-rows")
    sample = rows.withColumn("r", F.row_number().over(Window.partitionBy("fam").orderBy(F.xxhash64("id"), "id"))).where(F.col("r") <= SAMPLE)
    often = sample.select("fam", "set").repartition("fam").sortWithinPartitions("fam").mapInArrow(frequent, "fam long, set binary, n binary")
    often = often.join(torn, "fam").select("fam", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).cast("long").alias("id"), "set", "n")
    dealt = rows.select("fam", F.pmod(F.xxhash64(F.lit(9), "id"), "parts").cast("int").alias("part"), "id", "set", F.lit(None).cast("binary").alias("n"))
    met = often.unionByName(dealt).repartition("fam", "part").sortWithinPartitions("fam", "part", F.col("n").isNull())
    # written first: chained Python steps would hold two workers a core
    finer = components(store.cut(met.select("fam", "id", "set", "n").mapInArrow(firsts, "a long, b long"), "nd-firsts"), "a", "b")
    return rows.join(finer, rows["id"] == finer["node"]).select(F.col("component").alias("fam"), "id", "set", "comp")


def _blocks(sets: DataFrame, comp: DataFrame, num: int, den: int) -> DataFrame:
    """a, b: further links of large families. Members outside the family's largest component meet all members, in blocks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _grouped(batches, ["fam", "i", "j"]):
            few = np.array(t.column("few").to_pylist(), bool)
            comp = t.column("comp").to_numpy()
            s = _sets(t)
            at, on = np.flatnonzero(few), np.flatnonzero(~few)
            if not len(at) or not len(on):
                continue
            a, b = np.nonzero(_linked([s[k] for k in at], [s[k] for k in on], num, den))
            a, b = at[a], on[b]
            # one link for each pair of components will do
            pairs = np.unique(np.stack([comp[a], comp[b]]), axis=1) if len(a) else np.empty((2, 0), np.int64)
            pairs = pairs[:, pairs[0] != pairs[1]]
            names, inverse = np.unique(pairs, return_inverse=True)
            inverse = inverse.reshape(pairs.shape)
            root = roots(len(names), inverse[0], inverse[1])
            hit = [k for k in range(len(names)) if root[k] != k]
            yield pa.RecordBatch.from_arrays([pa.array(names[hit].astype(np.int64)), pa.array(names[[root[k] for k in hit]].astype(np.int64))], ["a", "b"])

    rows = sets.join(comp, sets["id"] == comp["node"], "left").select("fam", "id", "set", F.coalesce("component", "id").alias("comp"))
    rows = store.cut(_refined(store.cut(rows, "nd-large"), num, den), "nd-refined")
    sizes = rows.groupBy("fam", "comp").agg(F.count("*").alias("n"))
    most = sizes.groupBy("fam").agg(F.max(F.struct("n", "comp")).alias("m"), F.sum("n").alias("total")).select("fam", F.col("m.comp").alias("main"), "total", (F.col("total") - F.col("m.n")).alias("out"))
    most = store.cut(most, "nd-most")
    rows = skew.spread_join(rows, most, ["fam"], F.xxhash64("id"), most.select("fam", F.col("total").alias("n"))).withColumn("h", F.pmod(F.xxhash64("id"), F.lit(1 << 40)))
    na = F.ceil(F.col("out") / _BLOCK_A).cast("long")
    nb = F.ceil(F.col("total") / _BLOCK_B).cast("long")
    few = rows.where("comp <> main").select("fam", "id", "set", "comp", F.lit(True).alias("few"), F.pmod("h", na).alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), nb - 1)).alias("j"))
    all_ = rows.where("out > 0").select("fam", "id", "set", "comp", F.lit(False).alias("few"), F.explode(F.sequence(F.lit(0).cast("long"), na - 1)).alias("i"), F.pmod("h", nb).alias("j"))
    met = few.unionByName(all_).repartition("fam", "i", "j").sortWithinPartitions("fam", "i", "j")
    return met.mapInArrow(work, "a long, b long")


def _shared_ids(named: DataFrame, classes: DataFrame) -> DataFrame:
    """a, b: links between the representatives of classes that have an id in common."""
    several = named.groupBy("id").agg(F.min("digest").alias("one"), F.max("digest").alias("last")).where("one <> last").select("id", "one")
    pairs = named.select("id", "digest").join(several, "id").where("digest <> one").select("one", "digest")
    rep = classes.select(F.col("id").alias("rep"), F.col("digest").alias("of"))
    pairs = pairs.join(rep.withColumnRenamed("rep", "a"), F.col("one") == F.col("of")).select("a", "digest")
    return pairs.join(rep.withColumnRenamed("rep", "b"), F.col("digest") == F.col("of")).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str, text_col: str, shingle: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """id, n_shingles, component_id (the smallest id that links lead to) and kept for every row."""
    num, den = similarity
    with store.scratch(docs.sparkSession) as own:
        feats = store.cut(features(docs, id_col, text_col, shingle), "nd-features")
        named = feats.where("digest is not null and id is not null")
        # the sketch and the bands follow from the set, so any row of a class will do
        classes = named.groupBy("digest").agg(F.min(F.struct("id", "sketch", "bands")).alias("x"), F.count("*").alias("n")).select("digest", "x.*", "n")
        classes = store.cut(classes, "nd-classes")
        links = store.cut(family_links(classes.select("id", "sketch", "bands")), "nd-links")
        fams = store.cut(components(links, "leader", "id"), "nd-families")
        sizes = store.cut(fams.groupBy("component").agg(F.count("*").alias("n")), "nd-sizes")
        members = skew.spread_join(fams, sizes.select("component", F.col("n").alias("members")), ["component"], F.xxhash64("node"), sizes)
        members = store.cut(members.select(F.col("node").alias("id"), F.col("component").alias("fam"), (F.col("members") > SMALL_FAMILY).alias("large")), "nd-members")
        sets = store.cut(member_sets(docs, id_col, text_col, shingle, members), "nd-sets")
        large_ids = members.where("large").select("id")
        found = _small_families(sets.where("not large"), num, den)
        if not large_ids.isEmpty():
            big = sets.where("large")
            star = store.cut(_star(big, links.join(large_ids, "id", "left_semi"), num, den), "nd-star")
            found = found.unionByName(star).unionByName(_blocks(big, components(star, "a", "b"), num, den))
        found = found.unionByName(_shared_ids(named, classes))
        comp = store.cut(components(store.cut(found, "nd-found"), "a", "b"), "nd-components")
        final = classes.join(comp, classes["id"] == comp["node"], "left").select("digest", F.coalesce("component", "id").alias("component_id"))
        met = skew.spread_join(named.select("id", "n_shingles", "digest"), final, ["digest"], F.xxhash64("id"), classes.select("digest", "n"))
        alone = feats.where("digest is null or id is null").select("id", "n_shingles", F.col("id").alias("component_id"))
        out = met.select("id", "n_shingles", "component_id").unionByName(alone)
        return own.keep(out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))), "near-duplicates")
