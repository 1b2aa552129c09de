"""Text functions. All are Column expressions; only NFKD, Porter stems and the fuzzy ratio need a vectorized UDF.

Null input gives the empty text (or the empty list), as a value that isn't text counts as empty.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words that carry no meaning in room texts.
KEY_TERM_STOP_WORDS = [
    "and", "or", "the", "a", "an", "is", "are", "with", "to", "of", "for", "in", "on", "at", "by", "from", "as", "has",
    "have", "be", "bed", "room", "apartment", "suite", "view", "balcony",
]
#: The number words zero to twelve, in order.
NUMBER_WORDS = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve"]

_OTHER = r"[^\x00-\x7F]+"
_SPACE = r"(?U)[\s\x1c-\x1f]+"


@F.pandas_udf(T.StringType())
def _strip_marks(text: pd.Series) -> pd.Series:
    def one(s):
        return s if s is None or s.isascii() else "".join(c for c in unicodedata.normalize("NFKD", s) if unicodedata.category(c) != "Mn")

    return text.map(one, na_action="ignore")


def normalize_unicode(c: Column) -> Column:
    """Compatibility decomposition without combining marks.

    ASCII characters stay and part what they stand between, so only the runs of others go to Python, joined by line feeds.
    """
    c = F.coalesce(c, F.lit(""))
    runs = F.array_join(F.regexp_extract_all(c, F.lit(_OTHER), F.lit(0)), "\n")
    plain = _strip_marks(F.when(F.length(c) != F.octet_length(c), runs))
    whole = F.zip_with(F.split(c, _OTHER, -1), F.concat(F.split(plain, "\n", -1), F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    return F.when(plain.isNull(), c).otherwise(F.array_join(whole, ""))


def normalize_whitespace(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), _SPACE, " "))


def normalize_case(c: Column) -> Column:
    return F.lower(F.coalesce(c, F.lit("")))


def remove_special_characters(c: Column, keep: str = "") -> Column:
    """Drop all but a-z, 0-9, white space and ``keep``; spaces left over stay."""
    return F.regexp_replace(c, "(?U)[^a-z0-9\\s" + re.sub(r"([\\\]\[^&-])", r"\\\1", keep) + "]", "")


def normalize_full(c: Column, remove_special: bool = True, ascii_only: bool = False) -> Column:
    """Unicode, white space and case; then special characters. ``ascii_only`` skips the UDF where the data is known to be ASCII."""
    out = normalize_case(normalize_whitespace(c if ascii_only else normalize_unicode(c)))
    return remove_special_characters(out) if remove_special else out


def key_terms(c: Column, normalized: bool = False) -> Column:
    """Distinct words of four letters or more that aren't stop words, sorted."""
    words = F.regexp_extract_all(c if normalized else normalize_full(c), F.lit(r"(?U)(\w{4,})"))
    return F.array_sort(F.array_except(F.array_distinct(words), F.array(*[F.lit(w) for w in KEY_TERM_STOP_WORDS])))


def safe_int(c: Column) -> Column:
    """A text as an integer; 0 where it isn't one."""
    return F.coalesce(F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(c).try_cast("int")), F.lit(0))


def number_words(c: Column) -> Column:
    """Lower case, with whole number words as digits."""
    out = normalize_case(c)
    for n, word in enumerate(NUMBER_WORDS):
        out = F.regexp_replace(out, rf"(?U)\b{word}\b", str(n))
    return out


def room_text(name: Column, description: Column) -> Column:
    """The name, or the description if there is no name, without outer white space."""
    return F.regexp_replace(F.coalesce(F.nullif(name, F.lit("")), F.nullif(description, F.lit("")), F.lit("")), r"(?U)^\s+|\s+$", "")


def tokens(c: Column) -> Column:
    """Tokens of a normalized text: words split at white space, punctuation apart; empty ones dropped."""
    apart = F.regexp_replace(c, r"(?U)([^\w\s'.-])", " $1 ")
    return F.filter(F.split(F.regexp_replace(apart, r"(?U)\.(?=\s|$)", " ."), r"(?U)\s+"), lambda t: t != "")


def kept_tokens(c: Column) -> Column:
    """Tokens that are longer than two characters or numbers."""
    return F.filter(tokens(c), lambda t: (F.length(t) > 2) | t.rlike("^[0-9]+$"))


def counted_tokens(c: Column, stop_words: Iterable[str] = ()) -> Column:
    """Tokens whose frequency is learned: longer than two and no stop word, or a single digit."""
    stop = sorted(stop_words)
    word = lambda t: (F.length(t) > 2) & ~t.isin(stop) if stop else F.length(t) > 2
    return F.filter(tokens(c), lambda t: word(t) | t.rlike("^[0-9]$"))


def ngrams(words: Column, n: int) -> Column:
    """All runs of n adjacent words of an array, joined by spaces."""
    return F.when(
        F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))
    ).otherwise(F.array().cast("array<string>"))


def numeric_features(c: Column) -> Column:
    """Numbers with the word that follows, as n_word."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"(\d+\s*[a-z]+)")), lambda x: F.regexp_replace(x, r"^(\d+)\s*", "$1_"))


def numeric_patterns(c: Column) -> Column:
    """Numbers and a following word apart from them, as "n word"."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"(\d+\s+[a-z]+)")), lambda x: F.regexp_replace(x, r"\s+", " "))


def trimmed_code(c: Column) -> Column:
    """A room code without its last two characters, if it has more."""
    return F.when(F.length(c) > 2, F.substring(c, F.lit(1), F.length(c) - 2)).otherwise(c)


def code_prefix(c: Column) -> Column:
    """Four characters of a trimmed code, or two of a short one."""
    return F.when(F.length(c) >= 4, F.substring(c, 1, 4)).otherwise(F.substring(c, 1, 2))


def stem(word: str) -> str:
    """Porter's algorithm (An algorithm for suffix stripping, 1980)."""
    if len(word) < 3 or not word.isascii():
        return word

    def shape(w):  # vowels and consonants; y is a vowel after a consonant
        out = ""
        for i, c in enumerate(w):
            out += "v" if c in "aeiou" or c == "y" and i and out[-1] == "c" else "c"
        return out

    def measure(w):
        return len(re.findall("v+c+", shape(w)))

    def ends_double(w):
        return len(w) > 1 and w[-1] == w[-2] and shape(w)[-1] == "c"

    def cvc(w):
        return shape(w)[-3:] == "cvc" and w[-1] not in "wxy"

    def swap(w, table, least):
        for suffix, new in table:
            if w.endswith(suffix):
                base = w[: len(w) - len(suffix)]
                return base + new if measure(base) > least else w
        return w

    w = word
    if w.endswith("sses") or w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    if w.endswith("eed"):
        w = w[:-1] if measure(w[:-3]) > 0 else w
    else:
        base = w[:-2] if w.endswith("ed") else w[:-3] if w.endswith("ing") else None
        if base is not None and "v" in shape(base):
            w = base
            if w.endswith(("at", "bl", "iz")):
                w += "e"
            elif ends_double(w) and w[-1] not in "lsz":
                w = w[:-1]
            elif measure(w) == 1 and cvc(w):
                w += "e"
    if w.endswith("y") and "v" in shape(w[:-1]):
        w = w[:-1] + "i"
    w = swap(w, _STEP2, 0)
    w = swap(w, _STEP3, 0)
    for suffix in _STEP4:
        if w.endswith(suffix):
            base = w[: len(w) - len(suffix)]
            if measure(base) > 1 and (suffix != "ion" or base.endswith(("s", "t"))):
                w = base
            break
    if w.endswith("e") and (measure(w[:-1]) > 1 or measure(w[:-1]) == 1 and not cvc(w[:-1])):
        w = w[:-1]
    return w[:-1] if w.endswith("ll") and measure(w) > 1 else w


#: The suffix tables of the published algorithm.
_STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"), ("alli", "al"),
    ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"),
    ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
]
_STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
_STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]


@F.pandas_udf(T.ArrayType(T.StringType()))
def stems(words: pd.Series) -> pd.Series:
    """Porter stems of an array of words."""
    known: dict[str, str] = {}

    def one(w):
        if w not in known:
            known[w] = stem(w)
        return known[w]

    return words.map(lambda ws: None if ws is None else [one(w) for w in ws])
