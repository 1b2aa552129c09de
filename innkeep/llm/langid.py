"""Language identification with spans of mixed-language text.

Words are maximal runs of letters and the marks that follow them (vowel signs, accents). A word's script, from ranges of code points, narrows the candidates to languages
that use this script in the training text. Each candidate scores a word by the log probabilities of its letter
trigrams; Viterbi over the words with a switching penalty labels spans. The document gets the language with the most
letters in its spans.

The model is fitted on a bounded sample: about ``per_lang`` documents of each language, picked by a hash, and its size
is fixed (``BUCKETS`` hashed trigrams a language). Everything else covers all words of all texts.

Most texts are of one language, and a constant path is then optimal. That is proved at once for a whole batch. Let k be
the language with the best total, and let no stretch of words gain more than half the penalty over k in any one language.
A path with r stretches of other languages gains at most r half penalties: with r of 2 or more it pays at least r - 1
penalties, which is no less; with r of 1 it either pays one or is constant, and k has the best total. Only texts without
that proof go through the Viterbi recursion, many texts side by side.

Defined results: ``und`` with score 0 for null, empty and letterless texts, or if nothing could be learned; words in a
script that no learned language uses fit all languages alike; ties go to the language first in code-point order; an
empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1 << 16
PER_LANG = 2000
SWITCH_PENALTY = 12.0
LETTERS_AT_ONCE = 1 << 18
RUN_LETTERS = 1_000_000
UND = "und"

#: First code points of script ranges (Unicode blocks) and the script that starts there.
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0700, "Other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Other"), (0x0B80, "Tamil"), (0x0C00, "Telugu"),
    (0x0C80, "Other"), (0x0E00, "Thai"), (0x0E80, "Other"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"),
    (0x1380, "Other"), (0x1C80, "Cyrillic"), (0x1C90, "Other"), (0x1D00, "Latin"), (0x1F00, "Greek"), (0x2000, "Latin"),
    (0x2DE0, "Cyrillic"), (0x2E00, "Other"), (0x3040, "Kana"), (0x3100, "Other"), (0x3400, "Han"), (0xA000, "Other"),
    (0xA640, "Cyrillic"), (0xA6A0, "Other"), (0xA720, "Latin"), (0xA800, "Other"), (0xAC00, "Hangul"), (0xD800, "Other"),
    (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "Armenian"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "Other"),
    (0xFE70, "Arabic"), (0xFF00, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0xFFE0, "Other"), (0x20000, "Han"), (0x32000, "Other"),
]
SCRIPT_NAMES = sorted({s for _, s in SCRIPTS})
_STARTS = np.array([a for a, _ in SCRIPTS], dtype=np.int64)
_IDS = np.array([SCRIPT_NAMES.index(s) for _, s in SCRIPTS], dtype=np.int8)
_MARK, _ALPHA = 1, 2
_KIND = np.zeros(0x110000, dtype=np.int8)


def _kinds() -> np.ndarray:
    """Of every code point: 2 for letters, 1 for combining marks, 0 for others."""
    if not _KIND[97]:
        _KIND[:] = [_ALPHA if (x := chr(c)).isalpha() else _MARK if unicodedata.category(x)[0] == "M" else 0 for c in range(0x110000)]
    return _KIND


def codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all texts, 0 for what isn't part of a word and between texts; and where each text starts."""
    low = [(t or "").lower() for t in texts]
    c = np.frombuffer(("\n" + "\n".join(low) + "\n").encode("utf-32-le", "replace"), dtype=np.uint32)
    kind = _kinds()[np.minimum(c, 0x10FFFF)]
    word = kind == _ALPHA
    if (kind == _MARK).any():  # a mark belongs to a word if a letter stands before it there
        place = np.arange(len(c))
        letter, other = (np.maximum.accumulate(np.where(kind == k, place, -1)) for k in (_ALPHA, 0))
        word |= (kind == _MARK) & (letter > other)
    c = np.where(word, c, 0)
    starts = np.cumsum([1] + [len(t) + 1 for t in low])
    return c, starts


def trigrams(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of letters, and the bucket of the trigram around each."""
    at = np.flatnonzero(c)
    h = c[at - 1] * np.uint32(0x9E3779B1) ^ c[at] * np.uint32(0x85EBCA77) ^ c[at + 1] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return at, (h >> np.uint32(16)).astype(np.int32)


class Model:
    """Log probabilities [BUCKETS, languages], the scripts that each language uses, and the order of languages."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.langs = langs
        total = counts.sum(axis=0, keepdims=True)
        self.logp = np.ascontiguousarray(np.log((counts + 0.05) / (total + 0.05 * BUCKETS)), dtype=np.float32)
        share = scripts / np.maximum(1, scripts.sum(axis=0, keepdims=True))
        self.uses = share >= 0.001  # [scripts, languages]


def fit(docs: DataFrame, text_col: str, lang_col: str, key_col: str, per_lang: int = PER_LANG) -> Model:
    """Learn from about ``per_lang`` labelled rows of each language, those with the lowest hashes of ``key_col``."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l"), F.pmod(F.xxhash64(F.lit(7), key_col), F.lit(1 << 30)).alias("h"))
    sizes = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((len(SCRIPT_NAMES), 0)))
    below = F.lit(None).cast("long")
    for lang in langs:
        below = F.when(F.col("l") == lang, F.lit(min(1 << 30, -(-per_lang * (1 << 30) // sizes[lang])))).otherwise(below)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(langs), BUCKETS), dtype=np.int64)
        scripts = np.zeros((len(langs), len(SCRIPT_NAMES)), dtype=np.int64)
        for b in batches:
            by: dict[str, list] = {}
            for t, lang in zip(b.column("t").to_pylist(), b.column("l").to_pylist(), strict=True):
                by.setdefault(lang, []).append(t)
            for lang, texts in by.items():
                c, _ = codes(texts)
                at, h = trigrams(c)
                k = langs.index(lang)
                sums[k] += np.bincount(h, minlength=BUCKETS)
                scripts[k] += np.bincount(_IDS[np.searchsorted(_STARTS, c[at], "right") - 1], minlength=len(SCRIPT_NAMES))
        for k in range(len(langs)):
            both = np.concatenate([sums[k], scripts[k]])
            hit = np.flatnonzero(both)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hit), k, np.int32)), pa.array(hit.astype(np.int32)), pa.array(both[hit])], ["k", "b", "n"])

    sums = rows.where(F.col("h") < below).select("t", "l").mapInArrow(count, "k int, b int, n long").groupBy("k", "b").agg(F.sum("n").alias("n")).toArrow()
    both = np.zeros((len(langs), BUCKETS + len(SCRIPT_NAMES)))
    both[sums["k"].to_numpy(), sums["b"].to_numpy()] = sums["n"].to_numpy()
    return Model(langs, both[:, :BUCKETS].T, both[:, BUCKETS:].T)


def _viterbi(s: np.ndarray, starts: np.ndarray, ends: np.ndarray, penalty: float) -> list[np.ndarray]:
    """Best label paths of several texts side by side; text i has the rows starts[i]..ends[i] of s."""
    order = np.argsort(starts - ends, kind="stable")
    a, n = starts[order], (ends - starts)[order]
    k, longest = s.shape[1], int(n[0])
    back = []
    v = s[a].astype(np.float64)
    final = np.zeros((len(a), k))
    active = len(a)
    every = np.arange(k, dtype=np.int16)
    for t in range(1, longest + 1):
        still = int(np.searchsorted(-n, -t, "left"))  # texts with more than t words
        final[still:active] = v[still:active]
        active = still
        if not active:
            break
        v = v[:active]
        best = v.argmax(axis=1)
        top = v[np.arange(active), best] - penalty
        switch = top[:, None] > v
        back.append(np.where(switch, best[:, None].astype(np.int16), every))
        v = np.where(switch, top[:, None], v) + s[a[:active] + t]
    label = final.argmax(axis=1).astype(np.int16)
    paths = [np.empty(m, np.int16) for m in n]
    for i, m in enumerate(n):
        paths[i][m - 1] = label[i]
    for t in range(longest - 1, 0, -1):
        step = back[t - 1]
        m = len(step)
        label[:m] = step[np.arange(m), label[:m]]
        for i in range(m):
            paths[i][t - 1] = label[i]
    out = [None] * len(a)
    for i, o in enumerate(order):
        out[o] = paths[i]
    return out


def label(model: Model, texts: list[str | None], penalty: float = SWITCH_PENALTY) -> list[dict]:
    """For each text: lang, score (the share of its letters in spans of lang), spans [(from, to, lang)] in characters of the lower-cased text."""
    none = {"lang": UND, "score": 0.0, "spans": []}
    c, text_at = codes(texts)
    at, h = trigrams(c)
    k = len(model.langs)
    if not len(at) or not k:
        return [none] * len(texts)
    first = np.flatnonzero(c[at - 1] == 0)  # of each word, in places of letters
    score = np.empty((len(first), k), np.float32)
    turn = np.append(np.flatnonzero(np.diff(first // LETTERS_AT_ONCE, prepend=-1)), len(first))
    for i, j in zip(turn[:-1].tolist(), turn[1:].tolist(), strict=True):  # some words at a time: a row of scores per letter is large
        last = first[j] if j < len(first) else len(h)
        score[i:j] = np.add.reduceat(model.logp[h[first[i] : last]], first[i:j] - first[i], axis=0)
    script = _IDS[np.searchsorted(_STARTS, c[at[first]], "right") - 1]
    uses = model.uses[script]
    fits_none = ~uses.any(axis=1)
    score = np.where(uses | fits_none[:, None], score, score.min(axis=1, keepdims=True) - 20)
    score[fits_none] = 0
    letters = np.diff(np.append(first, len(at)))
    begin = at[first]
    lo = np.searchsorted(begin, text_at[:-1])
    hi = np.searchsorted(begin, text_at[1:])
    full = np.flatnonzero(hi > lo)
    lo_f, hi_f = lo[full], hi[full]
    total = np.add.reduceat(score.astype(np.float64), lo_f, axis=0)
    total -= np.arange(k) * 1e-6
    best = total.argmax(axis=1)
    # the proof: the largest sum of any stretch of words, for any other language, is below half the penalty
    owner = np.repeat(np.arange(len(full)), hi_f - lo_f)
    lead = score[np.arange(len(score)), best[owner]]
    far = float(np.abs(score).sum() + 1)
    sure = np.ones(len(full), bool)
    for j in range(k):
        sums = np.concatenate([[0.0], np.cumsum(score[:, j].astype(np.float64) - lead)])
        before = sums[:-1] - owner * far  # the least sum before starts anew in each text
        gain = sums[1:] - owner * far - np.minimum.accumulate(before)
        sure &= np.maximum.reduceat(gain, lo_f) < 0.4999 * penalty
    out = [none] * len(texts)
    hard = np.flatnonzero(~sure)
    paths = dict(zip(hard.tolist(), _viterbi(score, lo_f[hard], hi_f[hard], penalty), strict=True)) if len(hard) else {}
    for i, doc in enumerate(full.tolist()):
        a, b, base = lo_f[i], hi_f[i], int(text_at[doc])
        ends = begin[a:b] + letters[a:b] - base
        if i not in paths:
            lang = model.langs[best[i]]
            out[doc] = {"lang": lang, "score": 0.0 if fits_none[a:b].all() else 1.0, "spans": [(int(begin[a]) - base, int(ends[-1]), lang)]}
            continue
        path = paths[i]
        weight = np.bincount(path, weights=letters[a:b], minlength=k)
        lang = int(weight.argmax())
        turn = np.flatnonzero(np.diff(path)) + 1
        froms, tos = np.append(0, turn), np.append(turn, b - a)
        spans = [(int(begin[a + f]) - base, int(ends[t - 1]), model.langs[path[f]]) for f, t in zip(froms, tos, strict=True)]
        out[doc] = {"lang": model.langs[lang], "score": float(weight[lang] / weight.sum()), "spans": spans}
    return out


def identify(docs: DataFrame, model: Model, text_col: str, penalty: float = SWITCH_PENALTY, names: tuple[str, str, str] = ("lang_pred", "score", "spans")) -> DataFrame:
    """All columns of docs, and lang_pred, score and spans (array of struct<from, to, lang>), which replace columns of these names."""
    spark = docs.sparkSession
    docs = docs.select([c for c in docs.columns if c not in names])
    held = spark.sparkContext.broadcast(model)
    span_type = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32()), ("lang", pa.string())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            i = 0
            while i < big.num_rows:  # short runs of rows bound the memory of the arrays above
                n, size = 0, 0
                texts = big.column(text_col)
                while i + n < big.num_rows and n < 2000 and size < RUN_LETTERS:
                    size += len(texts[i + n].as_py() or "")
                    n += 1
                b = big.slice(i, n)
                i += n
                found = label(held.value, b.column(text_col).to_pylist(), penalty)
                spans = pa.array([[{"from": f, "to": t, "lang": x} for f, t, x in r["spans"]] for r in found], span_type)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([r["lang"] for r in found], pa.string()), pa.array([r["score"] for r in found], pa.float64()), spans], [*b.schema.names, *names])

    span = T.StructType([T.StructField("from", T.IntegerType()), T.StructField("to", T.IntegerType()), T.StructField("lang", T.StringType())])
    added = zip(names, (T.StringType(), T.DoubleType(), T.ArrayType(span)), strict=True)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, t) for n, t in added]])
    return docs.mapInArrow(work, schema)


def held_out(key: Column) -> Column:
    """True for the quarter of rows that nothing is learned from."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
