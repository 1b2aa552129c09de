"""Fuzzy room mapping: each source room to its most similar target room, by text alone.

A score depends on the texts only, so distinct texts are scored, not rooms. Many texts are searched by an inverted index
(``inverted``); few ones, and those of which it can't tell, are a set of queries against all targets, in blocks, as the
score has no key that similar rooms must share: targets are dealt into blocks of about BLOCK_TEXTS texts, each source meets each block once, and a block's postings add up its overlaps with all of the block's texts at once.
The costly ratio of texts is worked out best first, only for targets whose bound (from counts of characters) still
reaches the best score so far. No pairs are emitted; a source keeps one row per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.functions import scoring, text
from innkeep.functions.columns import settled
from innkeep.operators import inverted
from innkeep.sources import shared

BLOCK_TEXTS = 20_000
#: Pairs of rooms up to which meeting all targets is cheaper than an index of them.
SCAN_PAIRS = 20_000_000_000
_BUCKETS = 64


def _worded(rooms: DataFrame) -> DataFrame:
    """Adds text and normalized_code to rooms with code, name and description."""
    out = settled(rooms.withColumn("text", text.number_words(F.lower(text.room_text(F.col("name"), F.col("description"))))), "text")
    return out.withColumn("normalized_code", text.trimmed_code(F.col("code")))


def _features(df: DataFrame, with_stems: bool) -> DataFrame:
    """Adds tokens, stems and numeric_features of the column text."""
    out = df.withColumn("tokens", text.kept_tokens(F.col("text")))
    out = out.withColumn("stems", text.stems("tokens") if with_stems else F.array().cast("array<string>"))
    return out.withColumn("numeric_features", text.numeric_features(F.col("text")))


def normalize_rooms(rooms: DataFrame, with_stems: bool = True) -> DataFrame:
    """Adds text, tokens, stems, numeric_features, normalized_code and code_prefix to rooms with code, name and description."""
    return _features(_worded(rooms), with_stems).withColumn("code_prefix", text.code_prefix(F.col("normalized_code")))


def _texts(worded: DataFrame, with_stems: bool, *aggs) -> DataFrame:
    """Distinct texts with ``aggs`` and their features, which are worked out once a text."""
    worded = worded if "text" in worded.columns else _worded(worded)
    each = worded.groupBy("text").agg(*aggs) if aggs else worded.select("text").distinct()
    return _features(each, with_stems)


def _characters(s: str) -> np.ndarray:
    return np.bincount(np.frombuffer(s.encode("utf-32-le"), np.uint32) % _BUCKETS, minlength=_BUCKETS)


class _Block:
    """Targets with postings of their tokens, stems and numbers."""

    def __init__(self, texts: list[str], ords: list[int], lists: list[list[list[str]]]):
        self.texts, self.ords, self.n = texts, np.array(ords), len(texts)
        self.postings: list[dict[str, list[int]]] = []
        self.sizes: list[np.ndarray] = []
        for of_texts in lists:
            sets = [set(x) for x in of_texts]
            postings: dict[str, list[int]] = {}
            for i, keys in enumerate(sets):
                for k in keys:
                    postings.setdefault(k, []).append(i)
            self.postings.append({k: np.array(v) for k, v in postings.items()})
            self.sizes.append(np.array([len(x) for x in sets]))
        self.characters: np.ndarray | None = None

    def _shared(self, kind: int, keys: set[str]) -> np.ndarray:
        found = [p for k in keys if (p := self.postings[kind].get(k)) is not None]
        return np.bincount(np.concatenate(found), minlength=self.n) if found else np.zeros(self.n, np.int64)

    def _jaccard(self, kind: int, keys: set[str]) -> np.ndarray:
        shared = self._shared(kind, keys)
        return shared / np.maximum(1, len(keys) + self.sizes[kind] - shared)

    def _numeric(self, keys: set[str]) -> np.ndarray:
        sizes = self.sizes[2]
        return np.where(sizes == 0, 1.0, 0.0) if not keys else self._shared(2, keys) / np.maximum(len(keys), sizes)

    def best(self, s: str, tokens: list[str], stems: list[str], numbers: list[str], use_fuzzy: bool) -> tuple | None:
        """(ord, score, token, stem, numeric, fuzzy) of the best target; of equal ones that with the smallest ord. None if no score is above 0."""
        token, stem, numeric = self._jaccard(0, set(tokens)), self._jaccard(1, set(stems)), self._numeric(set(numbers))
        w, whole = scoring.WEIGHTS, sum(scoring.WEIGHTS.values())
        base = token * w["token"] + stem * w["stem"] + numeric * w["numeric"]
        score = lambda i, fuzzy: (base[i] + fuzzy * w["fuzzy"]) / whole * 100
        if not use_fuzzy:
            every = score(slice(None), 0.0)
            top = np.flatnonzero(every == every.max())
            at, fuzzy = int(top[self.ords[top].argmin()]), 0.0
            best = float(every[at])
        else:
            at = int(base.argmax())
            fuzzy = scoring.ratio(s, self.texts[at])
            best = score(at, fuzzy)
            near = np.flatnonzero(score(slice(None), 1.0) >= best)
            if self.characters is None:
                self.characters = np.array([_characters(t) for t in self.texts], np.int32)
            common = np.minimum(self.characters[near], _characters(s)).sum(axis=1)
            most = 2 * common / np.maximum(1, len(s) + self.characters[near].sum(axis=1)) + 0.0051  # the ratio is rounded to whole percents
            bound = score(near, most)
            for j in np.argsort(-bound, kind="stable").tolist():
                if bound[j] < best:
                    break
                i = int(near[j])
                f = scoring.ratio(s, self.texts[i])
                x = score(i, f)
                if x > best or (x == best and self.ords[i] < self.ords[at]):
                    at, best, fuzzy = i, x, f
        return (int(self.ords[at]), float(best), float(token[at]), float(stem[at]), float(numeric[at]), float(fuzzy)) if best > 0 else None


def _scored(s: DataFrame, t: DataFrame, use_fuzzy: bool) -> DataFrame:
    """text, t_ord, score and the four parts: each source text's best target text."""
    blocks = max(1, -(-t.count() // BLOCK_TEXTS))
    splits = max(1, s.sparkSession.sparkContext.defaultParallelism // blocks)
    hashed = lambda n: F.pmod(F.xxhash64("text"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cols = ["text", "tokens", "stems", "numeric_features"]
    met = t.select(F.lit(False).alias("source"), hashed(blocks).alias("block"), each(splits).alias("split"), "t_ord", *cols).unionByName(
        s.select(F.lit(True).alias("source"), each(blocks).alias("block"), hashed(splits).alias("split"), F.lit(0).cast("long").alias("t_ord"), *cols)
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, targets, block = None, [], None
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("block", "split", "source", "t_ord", *cols)), strict=True)
            out = []
            for at, split, source, t_ord, *features in rows:
                if (at, split) != cell:
                    cell, targets, block = (at, split), [], None
                if not source:
                    targets.append((t_ord, *features))
                    continue
                if block is None and targets:
                    ords, texts, *lists = (list(x) for x in zip(*targets, strict=True))
                    block = _Block(texts, ords, lists)
                if block is not None and (found := block.best(*features, use_fuzzy)) is not None:
                    out.append((features[0], *found))
            if out:
                names = ["text", "t_ord", "score", "token", "stem", "numeric", "fuzzy"]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names)

    found = met.repartition(blocks * splits, "block", "split").sortWithinPartitions("block", "split", "source")
    found = found.mapInArrow(work, "text string, t_ord long, score double, token double, stem double, numeric double, fuzzy double")
    if blocks == 1:
        return found
    return found.groupBy("text").agg(F.max_by(F.struct("t_ord", "score", *scoring.WEIGHTS), F.struct("score", -F.col("t_ord"))).alias("m")).select("text", "m.*")


def _searched(s: DataFrame, t: DataFrame, use_stems: bool, use_fuzzy: bool) -> DataFrame:
    """The rows of :func:`_scored`, by the index where it can tell and over all targets for the other sources."""
    with shared.scratch(s.sparkSession) as own:
        s, t = shared.cut(s, "source-texts"), shared.cut(t, "target-texts")
        found, unsure, _ = inverted.search(s, t, use_stems, use_fuzzy)
        left = s.join(unsure, "text", "left_semi")
        if not left.isEmpty():
            found = found.unionByName(_scored(left, t, use_fuzzy))
        return own.keep(found, "best-targets")


def best_matches(source: DataFrame, target: DataFrame, use_stems: bool = True, use_fuzzy: bool = True, indexed: bool | None = None) -> DataFrame:
    """Per source room (ord, code, ...): target_ord, target_code, score, match_score, match_type, confidence, matching_features.

    Both sides need ord, code, name and description. No target scores above 0: target columns are null. indexed: search by the
    inverted index (its results are written in the shared folder); by default beyond SCAN_PAIRS pairs of texts. Both ways are exact.
    """
    src, tgt = _worded(source), _worded(target)
    s, t = _texts(src, use_stems), _texts(tgt, use_stems, F.min("ord").cast("long").alias("t_ord"))
    if indexed is None:
        indexed = source.count() * target.count() > SCAN_PAIRS
    found = _searched(s, t, use_stems, use_fuzzy) if indexed else _scored(s, t, use_fuzzy)
    parts = [F.col(c) for c in scoring.WEIGHTS]
    found = found.select(F.col("text").alias("s_text"), "t_ord", "score", scoring.score_features(*parts).alias("features"))
    joined = src.join(found, src["text"] == found["s_text"], "left").drop("s_text")
    joined = joined.join(tgt.select(F.col("ord").alias("t_ord"), F.col("code").alias("target_code"), F.col("name").alias("target_name"), F.col("normalized_code").alias("target_normalized_code")), "t_ord", "left")
    score = F.coalesce(F.col("score"), F.lit(0.0))
    return joined.select(
        "ord", "code", "name", "description", F.col("normalized_code").alias("source_normalized_code"), F.col("t_ord").alias("target_ord"), "target_code", "target_name", F.coalesce("target_normalized_code", F.lit("")).alias("target_normalized_code"),
        score.alias("score"), scoring.half_even(score).alias("match_score"), scoring.band(score).alias("match_type"), scoring.half_even(score / 100).alias("confidence"),
        F.coalesce("features", F.array().cast("array<string>")).alias("matching_features"),
    )


def statistics(mappings: DataFrame) -> DataFrame:
    """One row: counts, rate, average score and recommendations over match_type, match_score and target_ord."""
    n = lambda *kinds: F.count_if(F.col("match_type").isin(*kinds))
    total, mapped = F.count("*"), F.count("target_ord")
    rate = F.when(total > 0, F.concat(F.format_string("%.2f", mapped / total * 100), F.lit("%"))).otherwise("0%")
    return mappings.agg(
        total.alias("total"), mapped.alias("mapped"), (total - mapped).alias("unmapped"), rate.alias("mapping_rate"),
        n("exact").alias("exact"), n("high_confidence").alias("high"), n("medium_confidence").alias("medium"), n("low_confidence").alias("low"), n("none").alias("none"),
        scoring.half_even(F.coalesce(F.avg("match_score"), F.lit(0.0))).alias("average_score"),
        n("exact", "high_confidence").alias("auto_apply"), n("medium_confidence").alias("manual_review"), n("low_confidence", "none").alias("needs_attention"),
    )
