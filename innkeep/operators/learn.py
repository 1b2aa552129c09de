"""Patterns learned from room texts: token, n-gram and number counts, code prefixes, categories and word clusters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innkeep.functions import text
from innkeep.functions.columns import settled


def _counts(rooms: DataFrame, words: Column, name: str) -> DataFrame:
    return rooms.select(F.explode(words).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def token_counts(rooms: DataFrame, text_col: str = "text", stop_words: Iterable[str] = ()) -> DataFrame:
    return _counts(rooms, text.counted_tokens(text.number_words(F.col(text_col)), stop_words), "token")


def ngram_counts(rooms: DataFrame, n: int, text_col: str = "text") -> DataFrame:
    words = settled(rooms.select(text.kept_tokens(text.number_words(F.col(text_col))).alias("words")), "words")
    return _counts(words, text.ngrams(F.col("words"), n), "ngram")


def numeric_counts(rooms: DataFrame, text_col: str = "text") -> DataFrame:
    return _counts(rooms, text.numeric_patterns(text.number_words(F.col(text_col))), "pattern")


def code_prefixes(rooms: DataFrame) -> DataFrame:
    """prefix, text: for prefixes of 2, 3 and 4 characters of trimmed codes, the text of the first room with it. Needs ord, code, text."""
    code = text.trimmed_code(F.col("code"))
    lengths = F.filter(F.array(F.lit(2), F.lit(3), F.lit(4)), lambda n: n <= F.length(code))
    each = rooms.where("code <> ''").select("ord", F.lower("text").alias("text"), F.explode(F.transform(lengths, lambda n: F.substring(code, F.lit(1), n))).alias("prefix"))
    return each.groupBy("prefix").agg(F.min_by("text", "ord").alias("text"))


def type_categories(rooms: DataFrame) -> DataFrame:
    """category, ord, text: a row per room that has a type. Needs ord, type, text."""
    return rooms.where("type <> ''").select(F.col("type").alias("category"), "ord", "text")


def _first_seen(rooms: DataFrame, text_col: str, stop_words: Iterable[str]) -> DataFrame:
    """token, n and where it first occurs: room and place as one number.

    A least struct would have all occurrences sorted in memory; numbers are added up in a map of the tokens.
    """
    words = text.counted_tokens(text.number_words(F.col(text_col)), stop_words)
    at = F.coalesce(F.col("ord"), F.lit(-(1 << 63))).cast("decimal(19,0)") * F.lit(1 << 31).cast("decimal(10,0)") + F.col("pos").cast("decimal(10,0)")
    return rooms.select("ord", F.posexplode(words).alias("pos", "token")).groupBy("token").agg(F.count("*").alias("n"), F.min(at).alias("first"))


def top_tokens(rooms: DataFrame, k: int, text_col: str = "text", stop_words: Iterable[str] = ()) -> DataFrame:
    """The k most frequent tokens with their place (from 0); ties go to the token seen first. Needs ord."""
    top = _first_seen(rooms, text_col, stop_words).orderBy(F.desc("n"), "first").limit(k)
    return top.select("token", "n", (F.row_number().over(Window.orderBy(F.desc("n"), "first")) - 1).alias("place"))


def category_tokens(rooms: DataFrame, text_col: str = "text", share: float = 0.05, k: int = 30, stop_words: Iterable[str] = ()) -> DataFrame:
    """category, n: tokens longer than three that occur more often than ``share`` of the rooms, the k most frequent."""
    total = rooms.agg(F.count("*").alias("total"))
    freq = _first_seen(rooms, text_col, stop_words).where(F.length("token") > 3)
    return freq.join(F.broadcast(total)).where(F.col("n") > share * F.col("total")).orderBy(F.desc("n"), "first").limit(k).select(F.col("token").alias("category"), "n")


def category_rooms(rooms: DataFrame, categories: DataFrame, text_col: str = "text") -> DataFrame:
    """category, ord, text of the rooms whose text contains the category. At most 30 categories are broadcast."""
    return rooms.select("ord", F.col(text_col).alias("text")).join(F.broadcast(categories.select("category")), F.contains("text", "category")).select("category", "ord", "text")


def word_clusters(rooms: DataFrame, k: int = 200, similarity: float = 0.8, text_col: str = "text", stop_words: Iterable[str] = ()) -> DataFrame:
    """leader, words: greedy clusters of the k most frequent tokens by edit distance, in the order of frequency.

    A fold over at most k tokens, in one row: a leader takes the later or earlier words near it that no cluster has.
    """
    top = top_tokens(rooms, k, text_col, stop_words)
    row = top.agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "token"))), lambda x: x["token"]).alias("words"))
    fold = f"""
      aggregate(words, named_struct('taken', CAST(array() AS array<string>), 'out', CAST(array() AS array<struct<leader:string,words:array<string>>>)),
        (s, w) -> CASE WHEN array_contains(s.taken, w) OR length(w) <= 3 THEN s ELSE named_struct(
          'taken', concat(s.taken, filter(words, v -> v <> w AND NOT array_contains(s.taken, v) AND 1 - levenshtein(w, v) / greatest(length(w), length(v)) > {similarity}), array(w)),
          'out', array_append(s.out, named_struct('leader', w, 'words',
             concat(array(w), filter(words, v -> v <> w AND NOT array_contains(s.taken, v) AND 1 - levenshtein(w, v) / greatest(length(w), length(v)) > {similarity}))))) END,
        s -> filter(s.out, c -> size(c.words) > 1))"""
    return row.select(F.explode(F.expr(fold)).alias("c")).select("c.*")
