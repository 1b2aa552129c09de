"""Conversation structure repair: the cheapest edits that turn each conversation into turns of user and assistant.

Rows carry a role and a text; only the role's first letter counts for the structure, which is (s?(ua)+)? over system, user
and assistant. A row is kept, given another role, or deleted, and rows without text may be inserted anywhere. Blank rows and
rows that repeat an earlier role and text must go; a row whose text is cut short costs extra if it stays.

The dynamic program works on a byte per row (its role's letter and fault), not on texts. Conversations of similar
length form one time-major tensor: costs to go are worked out from the last row to the first for all conversations and the
four states of the structure at once, kept, and then followed from the first row on, all conversations a row at a time, with
the least letter among the cheapest edits. Conversations above CHUNK rows are cut: costs through a chunk are a small matrix,
so that chunks are worked on apart from each other, and only matrices and states pass along a conversation. Their places come from
ranges of rows, so no task holds a conversation. Texts meet their edits in one sorted stream.

Defined results: a null role or text is one space; a null conversation is one of its own; rows are taken by turn, nulls
first, those of the same turn by a digest of role and text; roles without a known letter can't be kept; repeated rows are
duplicates; a row without any character but white space is blank, however long; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from innkeep.llm import skew, store
from innkeep.operators.positions import with_places

DELETE, INSERT, REROLE = 3, 2, 2
CHUNK = 1024
#: Rows of a tensor, at most (it holds a few numbers for each).
TENSOR_ROWS = 1 << 20
#: Faults of a row, the first that fits.
FAULTS = ["", "blank", "duplicate", "truncated"]
_FAR = 1 << 40
#: States: nothing yet, after system, after user, after assistant; the state that an inserted or renamed row leads to.
_NEXT = np.array([2, 2, 3, 2])
#: By letter (other, s, u, a) and state: where a kept row leads, or -1.
_KEPT = np.array([[-1, -1, -1, -1], [1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1]])
_ENDS = np.array([0, 2 * INSERT, INSERT, 0])
_ROLE = {2: "user", 3: "assistant"}
_PAD = 16


def _closed(cost: np.ndarray) -> np.ndarray:
    """Costs (states last) once rows may be inserted before."""
    for _ in range(2):
        cost = np.minimum(cost, INSERT + cost[..., _NEXT])
    return cost


def costs_to_go(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """[time + 1, conversation, state]: the least cost from before each row on. codes: [time, conversation]; ends: [conversation, state]."""
    out = np.empty((len(codes) + 1, *ends.shape), np.int64)
    out[-1] = ends
    for t in range(len(codes) - 1, -1, -1):
        code, after = codes[t], out[t + 1]
        fault, letter = code >> 2, code & 3
        cut = np.where(fault == 3, 1, 0)[:, None]
        to = _KEPT[letter]
        keep = np.where(to >= 0, np.take_along_axis(after, np.maximum(to, 0), axis=1), _FAR)
        stay = np.where(((fault == 0) | (fault == 3))[:, None], np.minimum(keep, REROLE + after[:, _NEXT]) + cut, _FAR)
        out[t] = np.where((code == _PAD)[:, None], after, _closed(np.minimum(DELETE + after, stay)))
    return out


def follow(codes: np.ndarray, cost: np.ndarray, start: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """The cheapest edits from state ``start`` on, the least letters first: [conversation, letters with zeros between], and the last states."""
    t_n, n = codes.shape
    out = np.zeros((t_n + 1, 4, n), np.uint8)
    state, every = start.copy(), np.arange(n)
    for t in range(t_n + 1):
        here, end = cost[t], t == t_n
        if end and not last:
            break
        after = cost[min(t + 1, t_n)]
        real = np.full(n, True) if end else codes[t] != _PAD
        for slot in range(3):
            now = here[every, state]
            stop = (now == _ENDS[state]) & np.isin(state, [0, 3]) if end else now == DELETE + after[every, state]
            put = real & ~stop & (now == INSERT + here[every, _NEXT[state]])
            out[t, slot, put] = ord("I")
            state = np.where(put, _NEXT[state], state)
        if end:
            break
        now, fault, letter = here[every, state], codes[t] >> 2, codes[t] & 3
        cut = np.where(fault == 3, 1, 0)
        to = _KEPT[letter, state]
        drop = now == DELETE + after[every, state]
        keep = ~drop & (to >= 0) & ((fault == 0) | (fault == 3)) & (now == cut + after[every, np.maximum(to, 0)])
        out[t, 3] = np.where(real, np.where(drop, ord("D"), np.where(keep, ord("K"), ord("R"))), 0)
        state = np.where(real & ~drop, np.where(keep, to, _NEXT[state]), state)
    return out.reshape(-1, n).T, state


def _buckets(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Places of conversations of similar length (up to the next power of two), as many as a tensor may hold."""
    wide = np.maximum(1, 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))
    for w in np.unique(wide):
        at = np.flatnonzero(wide == w)
        step = max(1, TENSOR_ROWS // int(w))
        for s in range(0, len(at), step):
            yield at[s : s + step]


def _tensor(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """[time, conversation] of rows that lie one conversation after the other; the ends are padded."""
    t_n = int(lengths.max(initial=0))
    out = np.full((t_n, len(starts)), _PAD, np.int64)
    time = np.arange(t_n)[:, None]
    there = time < lengths[None, :]
    out[there] = flat[(starts[None, :] + time)[there]]
    return out


def _texts(letters: np.ndarray) -> list[str]:
    """Rows of letters with zeros between as strings."""
    there = letters != 0
    flat, size = letters[there].tobytes().decode("ascii"), there.sum(axis=1)
    ends = np.cumsum(size).tolist()
    return [flat[e - n : e] for e, n in zip(ends, size.tolist(), strict=True)]


def _lists(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(size) - size, size


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole conversations: their edits and cost."""
    for b in batches:
        flat, starts, size = _lists(b.column("codes"))
        edits, cost = [""] * b.num_rows, np.zeros(b.num_rows, np.int64)
        for at in _buckets(size):
            codes = _tensor(flat, starts[at], size[at])
            togo = costs_to_go(codes, np.tile(_ENDS, (len(at), 1)))
            for i, s in zip(at.tolist(), _texts(follow(codes, togo, np.zeros(len(at), np.int64), True)[0]), strict=True):
                edits[i] = s
            cost[at] = togo[0, :, 0]
        yield pa.RecordBatch.from_arrays([b.column("key"), b.column("chunk"), pa.array(edits, pa.string()), pa.array(cost)], ["key", "chunk", "edits", "cost"])


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks: the costs from each state before to each state after."""
    for b in batches:
        flat, starts, size = _lists(b.column("codes"))
        out = np.zeros((b.num_rows, 16), np.int64)
        for at in _buckets(size * 4):
            codes = np.repeat(_tensor(flat, starts[at], size[at]), 4, axis=1)
            unit = np.tile(np.where(np.eye(4) > 0, 0, _FAR).astype(np.int64), (len(at), 1))
            # of chunk i, column 4 i + t holds the costs to state t
            out[at] = costs_to_go(codes, unit)[0].reshape(len(at), 4, 4).transpose(0, 2, 1).reshape(len(at), 16)
        yield pa.RecordBatch.from_arrays([b.column("key"), b.column("chunk"), pa.array(out.tolist(), pa.list_(pa.int64()))], ["key", "chunk", "costs"])


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of a conversation from the last to the first: the costs to go behind each."""
    key, now = object(), _ENDS
    for b in batches:
        ends = []
        for k, m in zip(b.column("key").to_pylist(), b.column("costs").to_pylist(), strict=True):
            key, now = k, now if k == key else _ENDS
            ends.append((now.tolist(), bool(now is _ENDS)))
            now = _closed((np.array(m).reshape(4, 4) + now[None, :]).min(axis=1))
        yield pa.RecordBatch.from_arrays([b.column("key"), b.column("chunk"), pa.array([e for e, _ in ends], pa.list_(pa.int64())), pa.array([x for _, x in ends], pa.bool_())], ["key", "chunk", "ends", "last"])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with the costs behind them: edits, last state and cost from each of the four states."""
    for b in batches:
        flat, starts, size = _lists(b.column("codes"))
        ends, last = np.array(b.column("ends").to_pylist(), np.int64).reshape(-1, 4), b.column("last").to_numpy(zero_copy_only=False).astype(bool)
        edits, states, cost = [[""] * 4 for _ in range(b.num_rows)], np.zeros((b.num_rows, 4), np.int64), np.zeros((b.num_rows, 4), np.int64)
        for at in (x[last[x] == final] for x in _buckets(size) for final in (False, True)):
            if not len(at):
                continue
            codes = _tensor(flat, starts[at], size[at])
            togo = costs_to_go(codes, ends[at])
            cost[at] = togo[0]
            for s in range(4):
                letters, states[at, s] = follow(codes, togo, np.full(len(at), s), bool(last[at[0]]))
                for i, x in zip(at.tolist(), _texts(letters), strict=True):
                    edits[i][s] = x
        yield pa.RecordBatch.from_arrays([b.column("key"), b.column("chunk"), pa.array(edits, pa.list_(pa.string())), pa.array(states.tolist(), pa.list_(pa.int64())), pa.array(cost.tolist(), pa.list_(pa.int64()))], ["key", "chunk", "edits", "states", "cost"])


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of a conversation from the first to the last: the edits from the state that the ones before lead to."""
    key, state = object(), 0
    for b in batches:
        edits, cost = [], []
        for k, e, s, c in zip(*(b.column(x).to_pylist() for x in ("key", "edits", "states", "cost")), strict=True):
            key, state = k, state if k == key else 0
            edits.append(e[state])
            cost.append(c[state])
            state = s[state]
        yield pa.RecordBatch.from_arrays([b.column("key"), b.column("chunk"), pa.array(edits, pa.string()), pa.array(cost, pa.int64())], ["key", "chunk", "edits", "cost"])


def initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


def facts(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """key (of the conversation), conv, at (place in it), turn, role, text, fault (number of FAULTS), code; a written table."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    out = rows.select(F.coalesce(F.concat(F.lit("1"), F.col(conv_col).cast("string")), F.lit("0")).alias("key"), F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), some(role_col).alias("role"), some(text_col).alias("text"))
    out = out.withColumn("h", F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    out = store.cut(with_places(out, [F.col("turn").asc_nulls_first(), F.col("h").asc()], ["key"], "at"), "turns")
    seen = store.cut(out.groupBy("key", "h").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1"), "repeats")
    out = skew.spread_join(out, seen.select("key", "h", "first"), ["key", "h"], F.col("at"), seen.select("key", "h", "n"), "left")
    ink = F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", "")
    fault = F.when(ink == "", 1).when(F.col("at") > F.col("first"), 2).when(~F.substring(ink, -1, 1).isin(".", "!", "?"), 3).otherwise(0)
    letter = F.when(initial(F.col("role")) == "s", 1).when(initial(F.col("role")) == "u", 2).when(initial(F.col("role")) == "a", 3).otherwise(0)
    out = out.select("key", "conv", "at", "turn", "role", "text", fault.cast("int").alias("fault"), (fault * 4 + letter).cast("int").alias("code"))
    return store.cut(out, "facts")


def edits(rows: DataFrame) -> DataFrame:
    """key, chunk, edits (letters), cost (of chunk 0: the whole conversation's), from :func:`facts`."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("at", "code"))), lambda x: x["code"])
    chunks = rows.groupBy("key", F.floor(F.col("at") / CHUNK).alias("chunk")).agg(listed.alias("codes"))
    chunks = store.cut(chunks, "chunks")
    short = (F.col("chunk") == 0) & (F.size("codes") < CHUNK)
    kind = "key string, chunk long, edits string, cost long"
    out = chunks.where(short).mapInArrow(_solved, kind)
    long = chunks.where(~short)
    if long.isEmpty():
        return out
    passed = long.mapInArrow(_matrices, "key string, chunk long, costs array<long>").repartition("key").sortWithinPartitions("key", F.desc("chunk"))
    ends = store.cut(passed.mapInArrow(_backward, "key string, chunk long, ends array<long>, last boolean"), "ends")
    ways = long.join(ends, ["key", "chunk"]).mapInArrow(_variants, "key string, chunk long, edits array<string>, states array<long>, cost array<long>")
    chosen = ways.repartition("key").sortWithinPartitions("key", "chunk").mapInArrow(_forward, kind)
    return out.unionByName(chosen)


def _stream(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows and the edits of their chunks, each before the chunk's rows, sorted in one task per conversation."""
    none = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("conv", "turn", "role", "text", "fault")]
    head = found.select("key", (F.col("chunk") * CHUNK).alias("at"), "edits", "cost", *none)
    body = rows.select("key", "at", F.lit(None).cast("string").alias("edits"), F.lit(None).cast("long").alias("cost"), "conv", "turn", "role", "text", "fault")
    return head.unionByName(body).repartition("key").sortWithinPartitions("key", "at", F.col("edits").isNull())


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(key, cost, row, letter, role, text) in order: an edit with what it leaves, or, with an empty letter, a conversation's beginning."""
    key, left, state = None, "", 0

    def inserted(n: int) -> Iterator[tuple]:
        nonlocal state
        for _ in range(n):
            state = int(_NEXT[state])
            yield key, None, None, "I", _ROLE[state], ""

    for b in batches:
        for k, letters, cost, *row in zip(*(b.column(c).to_pylist() for c in ("key", "edits", "cost", "conv", "turn", "role", "text", "fault")), strict=True):
            if letters is not None:
                yield from inserted(len(left))  # at the end of the conversation before
                left = letters
                if k != key:
                    key, state = k, 0
                    yield key, cost, None, "", None, None
                continue
            n = len(left) - len(left.lstrip("I"))
            yield from inserted(n)
            letter, left = left[n], left[n + 1 :]
            role, text = row[2:4]
            if letter == "K":
                state = {"s": 1, "u": 2, "a": 3}[role[:1]]
            elif letter == "R":
                state = int(_NEXT[state])
                role = _ROLE[state]
            yield key, None, row, letter, *((None, None) if letter == "D" else (role, text))
    yield from inserted(len(left))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


class _Report:
    """Counts and digests of one conversation, an edit at a time."""

    def __init__(self, key: str, cost: int):
        self.key, self.cost, self.conv = key, cost, None
        self.turns, self.low, self.high = 0, None, None
        self.faults, self.illegal, self.before = [0] * len(FAULTS), 0, None
        self.audit, self.sha, self.some = [], hashlib.sha256(), False

    def step(self, row: list | None, letter: str, role: str | None, text: str | None) -> None:
        self.audit.append(letter)
        if row is not None:
            self.conv, turn, was, _, fault = row
            if turn is not None and turn != self.high:  # turns ascend
                self.turns, self.high, self.low = self.turns + 1, turn, turn if self.low is None else self.low
            self.faults[fault] += 1
            self.illegal += self.before is not None and self.before + was[:1] not in ("su", "ua", "au")
            self.before = was[:1]
        if letter != "D":
            self.sha.update((("\n" if self.some else "") + f"{role}:{text}").encode())
            self.some = True

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.key, self.conv, gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()


def report(rows: DataFrame, found: DataFrame) -> DataFrame:
    """A row per conversation: key, conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Texts pass by a row at a time: a conversation's repaired text is digested as it comes and never held.
    """
    schema = StructType([StructField(f.name, f.dataType) for f in rows.select("key", "conv").schema])
    for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"):
        schema = schema.add(c, "long")
    schema = schema.add("audit", "string").add("repaired_sha256", "string")
    arrow = to_arrow_schema(schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now = None
        for key, cost, row, letter, role, text in _events(batches):
            if letter:
                now.step(row, letter, role, text)
                continue
            if now is not None:
                yield now.row()
            now = _Report(key, cost)
        if now is not None:
            yield now.row()

    return _stream(rows, found).mapInArrow(lambda batches: _batches(each(batches), arrow), schema)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """A row per edit: key, step (from 0), edit, conv, turn (of the row; null where inserted), role, text (null where deleted)."""
    schema = rows.select("key", F.col("at").alias("step"), F.col("text").alias("edit"), "conv", "turn", "role", "text").schema
    schema = StructType([StructField(f.name, f.dataType) for f in schema])
    arrow = to_arrow_schema(schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        step = 0
        for key, _, row, letter, role, text in _events(batches):
            step = step + 1 if letter else 0
            if letter:
                yield key, step - 1, letter, *(row[:2] if row else (None, None)), role, text

    return _stream(rows, found).mapInArrow(lambda batches: _batches(each(batches), arrow), schema)
