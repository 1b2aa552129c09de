"""Queries over the driver's tables and their DuckDB twins. Even ids play supplier A, odd ones supplier B."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.functions import occupancy, scoring, text
from innkeep.functions.scoring import Penalties
from innkeep.operators import dealt, enrich, fuzzy, learn, matching, summary, tiers
from innkeep.sources.tables import table

T = 0.15
#: Milder penalties, so that some penalized pairs stay above T.
MILD = Penalties(0.15, 0.12, 0.05, 0.12, 0.05, 0.08, 0.25)


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, d, "embeddings").select("label", F.col("vec_id").alias("ord"), "embedding")
    return e.where("ord % 2 = 0"), e.where("ord % 2 = 1")


def _described(df: DataFrame) -> DataFrame:
    """Rooms with texts and occupancies derived from the id."""
    kinds = F.array(*[F.lit(x) for x in ("one bedroom apartment", "2 bedroom suite", "studio apartment", "double room", "studio", "twin room")])
    occ = F.struct((F.col("ord") % 4 + 1).cast("int").alias("max_occupancy"), (F.col("ord") % 3 + 1).cast("int").alias("max_adults"), F.when(F.col("ord") % 5 > 0, F.col("ord") % 5).cast("int").alias("max_children"))
    return df.withColumn("text", F.element_at(kinds, (F.floor(F.col("ord") / 2) % 6 + 1).cast("int"))).withColumn("occupancy", occ)


def hotel_pair_join(spark, d):
    c = table(spark, d, "customer").select("c_nationkey", "c_custkey").withColumnRenamed("c_nationkey", "place_id")
    s = table(spark, d, "supplier").select("s_nationkey", "s_suppkey").withColumnRenamed("s_nationkey", "place_id")
    return matching.hotel_pairs(c, s)


def unmatched_hotels(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("place_id"), "c_name")
    return matching.unmatched_hotels(c, table(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("place_id")))


def _enriched(spark, d):
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("ord"), F.col("p_partkey").cast("string").alias("code"), F.col("p_name").alias("codeDescription"), F.col("p_type").alias("type"), F.when(F.col("p_size") > 20, F.col("p_size")).alias("occupancies"))
    rooms = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit(" "), F.col("l_partkey").cast("string")).alias("room_code"), F.col("l_returnflag").alias("code_description"))
    return enrich.enrich(rooms, enrich.catalog(parts))


def catalog_enrich(spark, d):
    return _enriched(spark, d).select("l_orderkey", "l_linenumber", "code_description", "enriched")


def enrich_stats(spark, d):
    return enrich.enrichment_stats(_enriched(spark, d)).withColumn("rate", F.round("rate", 6))


def keep_last_dedup(spark, d):
    docs = table(spark, d, "documents").select("source", "doc_id", "lang", "n_chars")
    return tiers.last_by(docs, ["source"], "doc_id")


def keep_first_dedup(spark, d):
    docs = table(spark, d, "documents").select("source", "lang", "doc_id", "n_chars")
    return tiers.first_by(docs, ["source", "lang"], "doc_id")


def normalize_text(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" -\t "), "p_type").alias("x"))
    return p.select("p_partkey", text.normalize_full(F.col("x"), ascii_only=True).alias("plain"), text.normalize_full(F.col("x"), remove_special=False, ascii_only=True).alias("kept"))


def normalize_unicode_text(spark, d):
    return table(spark, d, "documents").select("doc_id", text.normalize_full(F.col("text")).alias("normalized"))


def key_terms(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("x"))
    return p.select("p_partkey", F.array_join(text.key_terms(text.normalize_full(F.col("x"), ascii_only=True), normalized=True), ",").alias("terms"))


def safe_int(spark, d):
    e = table(spark, d, "events")
    v = F.get_json_object("props", "$.k")
    odd = F.when(F.col("event_id") % 7 == 0, F.concat(v, F.lit(".0"))).when(F.col("event_id") % 5 == 0, F.concat(F.lit(" +"), v, F.lit(" "))).when(F.col("event_id") % 11 == 0, F.lit("")).otherwise(v)
    return e.select("event_id", text.safe_int(odd).alias("n"))


def occupancy_norm(spark, d):
    s = lambda c: c.cast("string")
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    occ = F.struct(
        s(F.col("l_partkey") % 4).alias("MinOccupancy"), s(F.col("l_partkey") % 7).alias("MaxOccupancy"), s(F.col("l_suppkey") % 3).alias("MinAdultOccupancy"), s(F.col("l_suppkey") % 5).alias("MaxAdultOccupancy"),
        F.lit("4.0").alias("MinChildOccupancy"), F.when(F.col("l_linenumber") > 2, s(F.col("l_linenumber"))).alias("MaxChildOccupancy"), F.when(F.col("l_linenumber") % 2 == 0, "").otherwise("12").alias("MaxChildAge"),
        F.lit(None).cast("string").alias("MinInfantOccupancy"), F.lit("x").alias("MaxInfantOccupancy"), F.lit("0").alias("MaxInfantAge"), s(F.col("l_linenumber")).alias("StandardOccupancy"),
    )
    return x.select("l_orderkey", "l_linenumber", occupancy.from_axisdata(occ).alias("o")).select("l_orderkey", "l_linenumber", "o.*")


def _occ(spark, d):
    n = lambda c, m: F.when(c % m > 0, (c % m)).cast("int")
    p, s, k = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    occ = F.struct(n(p, 3).alias("min_occupancy"), n(p, 5).alias("max_occupancy"), n(s, 3).alias("min_adults"), n(s, 4).alias("max_adults"), (k % 3).cast("int").alias("max_children"), n(k, 2).alias("max_child_age"), (k % 2).cast("int").alias("max_infants"), n(p, 2).alias("max_infant_age"), n(s, 2).alias("standard_occupancy"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", occ.alias("occ"))


def occupancy_text(spark, d):
    return _occ(spark, d).select("l_orderkey", "l_linenumber", occupancy.describe(F.col("occ")).alias("said"))


def cosine_pairs(spark, d):
    p = matching.room_pairs(*_sides(spark, d), "label", "embedding", threshold=T)
    return p.select("label", "hb_ord", "ad_ord", F.round("sim", 6).alias("sim"))


def _st(spark, d):
    hb, ad = _sides(spark, d)
    return hb, ad, matching.match_rooms(hb, ad, "label", "embedding", T)


def greedy_rank1_match(spark, d):
    return _st(spark, d)[2].where("ad_ord is not null").select("label", "hb_ord", "ad_ord", F.round("sim", 6).alias("sim"))


def unmatched_with_reason(spark, d):
    hb, ad, a = _st(spark, d)
    return matching.unmatched_rooms(hb, ad, a, "label")


def _gm(spark, d):
    hb, ad = (_described(x) for x in _sides(spark, d))
    return hb, ad, matching.match_rooms_validated(hb, ad, "label", "embedding", T, MILD)


def penalized_match(spark, d):
    return _gm(spark, d)[2].select("label", "hb_ord", "ad_ord", F.round("sim", 6).alias("sim"), F.round("adjusted", 6).alias("adjusted"), "reason")


def penalized_pairs(spark, d):
    """label, hb_ord, ad_ord, p of the pairs above T. Texts are looked at once a room, not once a pair."""
    hb, ad = (_described(x).withColumn("bedrooms", scoring.bedrooms(F.col("text"))).withColumn("kind", scoring.room_type(F.col("text"))) for x in _sides(spark, d))
    facts = ("bedrooms", "kind", "occupancy")
    p = matching.room_pairs(hb, ad, "label", "embedding", facts, T)
    return p.select("label", "hb_ord", "ad_ord", scoring.penalized_facts(F.col("sim"), *[tuple(F.col(f"{side}_{c}") for c in facts) for side in ("hb", "ad")]).alias("p"))


def penalty_flags(spark, d):
    p = penalized_pairs(spark, d)
    return p.select("label", "hb_ord", "ad_ord", F.round("p.adjusted", 6).alias("adjusted"), "p.flags.bedroom_match", "p.flags.room_type_match", "p.flags.occupancy_match", F.array_join("p.flags.penalties_applied", "; ").alias("penalties"))


def match_summary(spark, d):
    hb, ad, a = _gm(spark, d)
    a = a.cache()  # read for each of the figures
    s = summary.match_summary(a, matching.unmatched_rooms(hb, ad, a, "label").where("side = 'ad'"), "label")
    return s.select("pairs", "matches", "unmatched_hb", "unmatched_ad", *[F.round(f"{p}{c}", 6).alias(f"{p}{c}") for p in ("", "adjusted_") for c in ("mean", "median", "min", "max")])


def hotel_totals(spark, d):
    return summary.hotel_totals(table(spark, d, "lineitem"), "l_orderkey")


def hotel_confidence(spark, d):
    x = table(spark, d, "lineitem").withColumn("matched", F.col("l_returnflag") == "N")
    return summary.hotel_confidence(x, "l_orderkey", "matched").withColumn("confidence", F.round("confidence", 6))


def char_batches(spark, d):
    return summary.char_batches(table(spark, d, "documents").withColumnRenamed("doc_id", "ord"), "text").withColumn("mean_chars", F.round("mean_chars", 6))


def _words(spark, d):
    """Texts with number words and digits in them."""
    x = F.concat_ws(" ", F.lower("p_name"), F.element_at(F.array(*[F.lit(w) for w in text.NUMBER_WORDS]), (F.col("p_size") % 13 + 1).cast("int")), F.lower("p_type"), F.lit("2 beds"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("ord"), F.col("p_brand").alias("code"), F.col("p_type").alias("type"), F.col("p_name").alias("name"), x.alias("text"))


def number_words(spark, d):
    return _words(spark, d).select("ord", text.number_words(F.col("text")).alias("digits"))


def token_freq(spark, d):
    return learn.token_counts(_words(spark, d), stop_words=["beds"])


def bigrams(spark, d):
    return learn.ngram_counts(_words(spark, d), 2)


def trigrams(spark, d):
    return learn.ngram_counts(_words(spark, d), 3)


def numeric_patterns(spark, d):
    return learn.numeric_counts(_words(spark, d))


def code_prefixes(spark, d):
    return learn.code_prefixes(_words(spark, d).select("ord", "code", F.col("name").alias("text")))


def type_categories(spark, d):
    return learn.type_categories(_words(spark, d).select("ord", "type", F.col("name").alias("text"))).groupBy("category").agg(F.count("*").cast("int").alias("n"), F.min_by("text", "ord").alias("first"))


def categories(spark, d):
    return learn.category_tokens(_words(spark, d))


def category_rooms(spark, d):
    w = _words(spark, d)
    return learn.category_rooms(w, learn.category_tokens(w)).groupBy("category").agg(F.count("*").alias("rooms"))


def word_clusters(spark, d):
    return learn.word_clusters(_words(spark, d), similarity=0.5).select("leader", F.array_join("words", ",").alias("words"))


#: Keys of a list of parts span less than this, so that no list is longer.
_KEY_SPAN = 1 << 20
#: Cells of parts are smaller than others by this.
_SHARE = 4


def jaccard_score(spark, d):
    """All pairs of parts of a size. A part meets lists of the parts of one name: scores are worked out once a list, not once a pair.

    The lists that a task goes through again and again are some CELL_ROWS parts, so that their keys stay in the dictionary of a Parquet file.
    """
    p = table(spark, d, "part").where("p_partkey is not null").select("p_partkey", "p_size", F.split(F.lower("p_name"), " ").alias("w"))
    span, most = F.floor(F.col("p_partkey") / _KEY_SPAN).alias("span"), max(1, dealt.CELL_ROWS // _SHARE // 4)
    whole = p.groupBy("p_size", "w", span).agg(F.sort_array(F.collect_list("p_partkey")).alias("keys"))
    lists = whole.select("p_size", "w", F.explode(F.transform(F.sequence(F.lit(1), F.size("keys"), F.lit(most)), lambda i: F.slice("keys", i, most))).alias("p_partkey"))
    q = lists.select(F.col("p_size").alias("q_size"), F.col("w").alias("v"), F.col("p_partkey").alias("keys"), F.element_at("p_partkey", -1).alias("last"))
    met = dealt.dealt_join(lists, q, ("p_size", "q_size"), (F.col("p_partkey"), F.col("keys")), F.col("p_partkey") < F.col("last"), sizes=(F.size("p_partkey"), F.size("keys")), unfold="p_partkey", share=_SHARE)
    scored = met.select("p_partkey", "keys", F.round(scoring.jaccard(F.col("w"), F.col("v")), 6).alias("jaccard"), F.round(scoring.numeric_match(F.slice("w", 1, 1), F.slice("v", 1, 2)), 6).alias("shared"))
    return scored.select("p_partkey", F.explode("keys").alias("q_partkey"), "jaccard", "shared").where("p_partkey < q_partkey")


def _parts(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("ord"), F.concat_ws("", F.lit("C"), F.col("p_partkey") % 50).alias("code"), F.concat_ws(" ", "p_name", (F.col("p_size") % 4).cast("string"), F.lit("room")).alias("name"), F.col("p_type").alias("description"))
    return p.where("ord % 2 = 0"), p.where("ord % 2 = 1")


def _mapped(spark, d):
    return fuzzy.best_matches(*_parts(spark, d), use_stems=False, use_fuzzy=False)


def best_match(spark, d):
    return _mapped(spark, d).select("ord", "target_ord", F.round("score", 6).alias("score"), "match_type")


def indexed_match(spark, d):
    """The same matches by the inverted index."""
    m = fuzzy.best_matches(*_parts(spark, d), use_stems=False, use_fuzzy=False, indexed=True)
    return m.select("ord", "target_ord", F.round("score", 6).alias("score"), "match_type")


def rounded_doubles(spark, d):
    """Doubles rounded by their exact values: prices, ties, and numbers next to ties."""
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_extendedprice").cast("double") / F.col("l_quantity").cast("double") / 8).alias("x"), (F.col("l_partkey") / 8.0 - 100).cast("double").alias("tie"), (F.col("l_suppkey") / 200.0).cast("double").alias("near"))
    return x.select("l_orderkey", "l_linenumber", scoring.half_even(F.col("x")).alias("two"), scoring.half_even(F.col("x"), 0).alias("none"), scoring.half_even(F.col("tie")).alias("tie"), scoring.half_even(F.col("near")).alias("near"))


def fuzzy_score(spark, d):
    m = fuzzy.best_matches(*_parts(spark, d))
    return m.select("ord", "target_ord", F.round("score", 6).alias("score"), "match_type", F.array_join("matching_features", " ").alias("features"))


def _banded(spark, d):
    """Mappings with all bands: scores spread by the id."""
    m = _mapped(spark, d)
    score = F.when(F.col("ord") % 3 == 0, F.lit(95.0) + F.col("ord") % 5).when(F.col("ord") % 3 == 1, F.lit(70.0) + F.col("ord") % 25).otherwise(F.lit(50.0))
    return m.withColumn("match_score", score).withColumn("match_type", scoring.band(score)).withColumn("confidence", F.round(score / 100, 2))


def fuzzy_stats(spark, d):
    return fuzzy.statistics(_banded(spark, d))


def tier_dedup_filter(spark, d):
    return tiers.tiered(_banded(spark, d)).select("tier", "ord", "code", "target_code", "match_score", "match_type", "confidence")


def filter_stats(spark, d):
    m = _banded(spark, d)
    return tiers.tier_statistics(m, tiers.tiered(m))


def simplify_mappings(spark, d):
    return tiers.simplified(_mapped(spark, d).select("code", "name", "target_code", "target_name", F.round("score", 6).alias("match_score"), "match_type"))


QUERIES = {f.__name__: f for f in (
    hotel_pair_join, unmatched_hotels, catalog_enrich, enrich_stats, keep_last_dedup, keep_first_dedup, normalize_text, normalize_unicode_text, key_terms, safe_int,
    occupancy_norm, occupancy_text, cosine_pairs, greedy_rank1_match, unmatched_with_reason, penalized_match, penalty_flags, match_summary,
    hotel_totals, hotel_confidence, char_batches, number_words, token_freq, bigrams, trigrams, numeric_patterns, code_prefixes, type_categories, categories, category_rooms,
    word_clusters, jaccard_score, best_match, indexed_match, rounded_doubles, fuzzy_score, fuzzy_stats, tier_dedup_filter, filter_stats, simplify_mappings,
)}

from innkeep.plans.catalog_sql import ORACLE  # noqa: E402, F401
