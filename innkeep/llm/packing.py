"""Packing tokenized documents into sequences: hierarchical residual best fit.

Documents are tokenized and cut into pieces of at most ``capacity`` tokens; only longer documents are cut. Each
partition packs its pieces by best fit, longest first, and emits the bins that are nearly full. The others travel on as
items of a next round over fewer partitions, where they are packed again, until one partition has seen the rest or a
round no longer helps. Every task takes at most about ITEMS_PER_TASK items. A bin carries its pieces, at most
``capacity`` of them, so nothing is looked up again.

Tokens come from the tokenizer for each distinct word; its own pre-tokenizer treats words one by one, so words are kept
with their ids. Texts with characters outside ``_PLAIN``, or with a special token's text, go through the tokenizer whole.

Defined results: null and empty texts are the end token alone; ties go by length, then as the rows come; repeated rows
are packed each for itself; an empty table gives no rows; other columns are ignored by ``tokenize``.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.llm import store

CAPACITY = 2048
END_ID = 0
NEARLY_FULL = 0.99
ITEMS_PER_TASK = 100_000
KEPT_WORDS = 400_000

#: Characters for which the fast path below equals the tokenizer: lower-casing is by character, and normal form C holds.
_PLAIN = re.compile(r"[\t\n\v\f\r -~ -įı-ňŊ-ž]*")
_WORDS = re.compile(r"[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)|\d|(?:[^\s\w]|_)+")
_ASCII_WORDS = re.compile(r"[a-z]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\sa-z0-9]+", re.ASCII)
_ODD_NUMBERS = re.compile("[²³¹¼-¾]")
_PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE's letter for each byte: printable Latin-1 stands for itself, the others follow from 256 on."""
    same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in same]
    return {b: chr(b) for b in same} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Words(dict):
    """Word to the bytes of its ids (little-endian unsigned 32-bit). Keeps at most two generations of KEPT_WORDS words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters, self.old = self.tokenizer.model, _byte_letters(), {}

    def __missing__(self, word: str) -> bytes:
        got = self.old.get(word)
        if got is None:
            spelt = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
            got = np.array([t.id for t in self.model.tokenize(spelt)], "<u4").tobytes()
        self[word] = got
        return got

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        plain = text.isascii()
        if "<|" in text or not _PLAIN.fullmatch(text) or not plain and _ODD_NUMBERS.search(text):
            return self.whole(text)
        if len(self) > KEPT_WORDS:
            self.old = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, (_ASCII_WORDS if plain else _WORDS).findall(text.lower())))


@functools.lru_cache(maxsize=1)
def words_of(path: str) -> Words:
    """Kept while a Python worker lives, over its tasks."""
    return Words(path)


def tokenize(docs: DataFrame, id_col: str, text_col: str, tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32. The file must be at ``tokenizer_path`` on every machine."""
    path = tokenizer_path or default_tokenizer()
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(path)
        for b in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                ids = words.ids(text.as_py()) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for col, v in zip(rows, (doc, k, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        col.append(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, _PIECES)


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The bin of each item, by best fit with the longest first."""
    bins = np.empty(len(lengths), np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by room left
    free = 0  # bit r: some bin has room r
    made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = free >> n
        if fits:
            room = n + ((fits & -fits).bit_length() - 1)
            b = open_at[room].pop()
            if not open_at[room]:
                free &= ~(1 << room)
        else:
            room, b = capacity, made
            made += 1
        bins[i] = b
        if room > n:
            open_at[room - n].append(b)
            free |= 1 << (room - n)
    return bins


_BIN = "bin long, length int, full boolean, pieces array<struct<doc_id:long,piece:int,start:long,length:int,ids_crc32:long>>"


def _round(items: DataFrame, number: int, capacity: int, nearly: int) -> DataFrame:
    """Pack the items of each partition; items are bins of pieces."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), arrow) if (first := next(batches, None)) is None else pa.Table.from_batches([first, *batches])
        if not table.num_rows:
            return
        lengths = table.column("length").to_numpy()
        bins = best_fit(lengths, capacity)
        order = np.argsort(bins, kind="stable")
        pieces = table.column("pieces").combine_chunks()
        if isinstance(pieces, pa.ChunkedArray):
            pieces = pieces.chunk(0)
        pieces = pieces.take(pa.array(order))
        starts = np.flatnonzero(np.diff(bins[order], prepend=-1))
        filled = np.add.reduceat(lengths[order], starts).astype(np.int32)
        offsets = np.append(pieces.offsets.to_numpy()[starts], pieces.offsets.to_numpy()[-1]).astype(np.int32)
        merged = pa.ListArray.from_arrays(pa.array(offsets), pieces.values)
        base = (number << 56) | (TaskContext.get().partitionId() << 32)
        out = pa.RecordBatch.from_arrays([pa.array(base + np.arange(len(starts), dtype=np.int64)), pa.array(filled), pa.array(filled >= nearly), merged], ["bin", "length", "full", "pieces"])
        for i in range(0, out.num_rows, 10_000):
            yield out.slice(i, 10_000)

    arrow = pa.schema([("length", pa.int32()), ("pieces", pa.list_(pa.int32()))])
    return items.select("length", "pieces").mapInArrow(work, _BIN)


def pack(pieces: DataFrame, capacity: int = CAPACITY, nearly_full: float = NEARLY_FULL, items_per_task: int = ITEMS_PER_TASK) -> DataFrame:
    """pieces (doc_id, piece, start, length, ids_crc32, with lengths of 1 to capacity) with sequence_id and offset."""
    nearly = int(np.ceil(nearly_full * capacity))
    whole = F.array(F.struct("doc_id", "piece", "start", "length", "ids_crc32")).alias("pieces")
    # the checksum spreads rows that share an id, or have none
    items = pieces.select(F.xxhash64("doc_id", "piece", "ids_crc32").alias("bin"), "length", whole)
    done: list[DataFrame] = []
    tasks = max(1, -(-pieces.count() // items_per_task))
    spark, number, left = pieces.sparkSession, 0, None
    while True:
        last = tasks == 1
        bins = store.cut(_round(items.repartition(tasks, "bin"), number, capacity, nearly), "bins")
        open_bins = bins.where("not full").count()
        done.append(bins if last else bins.where("full"))
        if last:
            break
        next_tasks = max(1, -(-open_bins // items_per_task))
        if left is not None and open_bins > 0.99 * left:  # items too long to share a bin: more rounds can't help
            done[-1] = bins
            break
        items, left, number = bins.where("not full"), open_bins, number + 1
        tasks = min(next_tasks, max(1, tasks // 4))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("bin", "pieces").mapInArrow(_place, _PLACED)


_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per piece, with its place in its sequence."""
    for b in batches:
        pieces = b.column("pieces")
        flat = pieces.flatten()
        count = np.diff(pieces.offsets.to_numpy())
        length = flat.field("length").to_numpy().astype(np.int64)
        before = np.cumsum(length) - length
        first = np.cumsum(count) - count
        offset = before - np.repeat(before[first[count > 0]], count[count > 0]) if len(length) else before
        sequence = np.repeat(b.column("bin").to_numpy(), count)
        cols = [flat.field(n) for n in ("doc_id", "piece", "start")] + [pa.array(length), flat.field("ids_crc32"), pa.array(sequence), pa.array(offset)]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
