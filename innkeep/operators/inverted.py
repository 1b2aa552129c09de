"""Top-1 search by an inverted index: each source text's most similar target text without meeting all of them.

Terms are stems (or tokens, where there are no stems). Two texts that are alike share at least two rare terms, so the index
holds pairs of terms: postings are the targets with a pair, by their number of terms. A source looks up the pairs of its
rarest terms first; the best score found is its threshold. For each number of terms that targets have, a bound then tells how
many of the source's terms, rarest first, a better target could share at most one of; the pairs among these are looked up
too. All others score less than the threshold, so the result is exact. Sources for which no such bound exists (few or
common terms, long targets, pairs that very many targets hold) are returned for a search over all targets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innkeep.functions import scoring
from innkeep.sources import shared

#: Targets with more terms are not in the index.
PAIR_TERMS = 24
#: A pair with more postings isn't looked up.
HOT_POSTINGS = 20_000
#: The rarest terms whose pairs are looked up first.
FIRST_TERMS = 3
#: Different numbers of terms that targets may have.
MAX_SIZES = 512
_SLACK = 1e-6


def _features(df: DataFrame, stems: bool) -> DataFrame:
    sets = [F.array_distinct(c).alias(n) for c, n in (("tokens", "ts"), ("stems", "ss"), ("numeric_features", "ns"))]
    return df.select("text", *[c for c in ("sid", "t_ord") if c in df.columns], *sets).withColumn("terms", F.col("ss" if stems else "ts"))


def _pair(x: Column, y: Column) -> Column:
    return F.xxhash64(F.least(x, y), F.greatest(x, y))


def _pairs(terms: Column, n: Column) -> Column:
    """Keys of all pairs among the first n terms."""
    first = F.slice(terms, 1, n)
    return F.flatten(F.transform(first, lambda x, i: F.transform(F.slice(first, i + 2, F.size(first)), lambda y: _pair(x, y))))


def _bound(shared_terms: Column, z: Column, stems: bool, fuzzy: bool) -> Column:
    """The best score of a target with z terms that shares so many of the source's ``a`` terms (it has ``nt`` tokens)."""
    c = F.least(shared_terms, F.col("a"), z)
    if stems:
        js = c / F.greatest(F.lit(1), F.col("a") + z - c)
        same = F.when(c > 0, F.least(F.col("nt"), c + F.col("nt") - F.col("a"))).otherwise(0)  # several tokens may have one stem
        jt = same / F.greatest(F.lit(1), F.col("nt") + F.greatest(z, same) - same)
    else:
        js, jt = F.lit(0.0), c / F.greatest(F.lit(1), F.col("a") + z - c)
    return scoring.room_score(jt, js, F.lit(1.0), F.lit(1.0 if fuzzy else 0.0))


def _scored(pairs: DataFrame, s: DataFrame, t: DataFrame, fuzzy: bool) -> DataFrame:
    """sid and m: t_ord, score and parts of the best of some pairs (sid, t_ord). The ratio is worked out only where it may matter."""
    rows = pairs.join(s.select("sid", "text", "ts", "ss", "ns"), "sid").join(t.select("t_ord", *[F.col(c).alias(f"t_{c}") for c in ("text", "ts", "ss", "ns")]), "t_ord")
    parts = [scoring.jaccard(F.col("ts"), F.col("t_ts")), scoring.jaccard(F.col("ss"), F.col("t_ss")), scoring.numeric_match(F.col("ns"), F.col("t_ns"))]
    rows = rows.select("sid", "t_ord", "text", "t_text", *[p.alias(n) for p, n in zip(parts, ("token", "stem", "numeric"), strict=True)])
    score = lambda f: scoring.room_score(F.col("token"), F.col("stem"), F.col("numeric"), f)
    if fuzzy:
        rows = shared.cut(rows.withColumn("least", score(F.lit(0.0))), "pairs")
        lengths = F.length("text"), F.length("t_text")
        most = 2 * F.least(*lengths) / F.greatest(F.lit(1), lengths[0] + lengths[1]) + 0.0051  # the ratio is rounded to whole percents
        floor = rows.groupBy("sid").agg(F.max("least").alias("floor"))
        rows = rows.join(floor, "sid").where(score(F.least(most, F.lit(1.0))) >= F.col("floor") - _SLACK)
        rows = rows.withColumn("fuzzy", scoring.fuzzy_ratio("text", "t_text"))
    else:
        rows = rows.withColumn("fuzzy", F.lit(0.0))
    rows = rows.withColumn("score", score(F.col("fuzzy")))
    return rows.groupBy("sid").agg(F.max_by(F.struct("t_ord", "score", *scoring.WEIGHTS), F.struct("score", -F.col("t_ord"))).alias("m"))


def search(s: DataFrame, t: DataFrame, stems: bool, fuzzy: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(found, unsure, pairs): each source's best target where the index can tell, the other sources, and the pairs that were scored.

    s, t: distinct texts with tokens, stems, numeric_features; t with t_ord, an id that ties go by. found: text, t_ord, score and its
    parts. Tables are written in the caller's scratch.
    """
    s = shared.cut(_features(s.withColumn("sid", F.monotonically_increasing_id()), stems), "sources")
    t = shared.cut(_features(t, stems), "targets")
    z = F.size("terms").alias("z")
    sizes = [r["z"] for r in t.select(z).distinct().limit(MAX_SIZES + 1).collect()]
    terms = t.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    postings = t.where(F.size("terms") <= PAIR_TERMS).select("t_ord", z, F.explode(_pairs(F.col("terms"), F.lit(PAIR_TERMS))).alias("key"))
    postings = shared.cut(postings, "postings")
    hot = postings.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT_POSTINGS).select("key")
    ranked = s.select("sid", F.explode("terms").alias("term")).join(terms, "term").groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("df", "term"))).alias("r"))
    ranked = s.select("sid", F.size("terms").alias("a"), F.size("ts").alias("nt")).join(ranked, "sid").select("sid", "a", "nt", F.transform("r", lambda x: x["term"]).alias("r"), F.size("r").alias("k"))
    ranked = shared.cut(ranked, "ranked")
    first = ranked.select("sid", F.explode(_pairs(F.col("r"), F.lit(FIRST_TERMS))).alias("key")).join(hot, "key", "left_anti")
    seeds = shared.cut(first.join(postings, "key").select("sid", "t_ord").distinct(), "seeds")
    best = shared.cut(_scored(seeds, s, t, fuzzy), "best")
    if len(sizes) > MAX_SIZES:
        return _named(best.limit(0), s), s.select("text"), seeds
    # by number of terms z: the fewest terms of which a better target would share two, or null
    each = ranked.join(best.select("sid", F.col("m.score").alias("tau")), "sid").withColumn("z", F.explode(F.array(*[F.lit(x) for x in sizes])))
    enough = F.filter(F.sequence(F.lit(1), F.greatest("k", F.lit(1))), lambda p: _bound(F.col("k") - p + 1, F.col("z"), stems, fuzzy) < F.col("tau") - _SLACK)
    each = shared.cut(each.withColumn("p", F.try_element_at(enough, F.lit(1))), "prefixes")
    open_ = each.where(F.col("p").isNull() | ((F.col("z") > PAIR_TERMS) & (F.col("p") > 1))).select("sid")
    wanted = each.where((F.col("p") > 1) & (F.col("z") <= PAIR_TERMS)).select("sid", "z", F.explode(_pairs(F.col("r"), F.col("p"))).alias("key"))
    wanted = shared.cut(wanted.join(open_.distinct(), "sid", "left_anti"), "wanted")
    open_ = open_.unionByName(wanted.join(hot, "key", "left_semi").select("sid")).distinct()
    more = wanted.join(open_, "sid", "left_anti").join(postings, ["key", "z"]).select("sid", "t_ord").distinct().join(seeds, ["sid", "t_ord"], "left_anti")
    more = shared.cut(more, "candidates")
    both = best.unionByName(_scored(more, s, t, fuzzy))
    sure = both.groupBy("sid").agg(F.max_by("m", F.struct(F.col("m.score"), -F.col("m.t_ord"))).alias("m")).join(open_, "sid", "left_anti")
    found = shared.cut(_named(sure.where(F.col("m.score") > 0), s), "found")
    return found, s.join(found.select("text"), "text", "left_anti").select("text"), seeds.unionByName(more)


def _named(best: DataFrame, s: DataFrame) -> DataFrame:
    return best.join(s.select("sid", "text"), "sid").select("text", "m.*")
