"""DuckDB twins of the queries in ``catalog``, written apart from the operators."""

from __future__ import annotations

from innkeep.functions.text import KEY_TERM_STOP_WORDS, NUMBER_WORDS

T = 0.15

_SIM = """
e AS (SELECT label, vec_id AS ord, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
n AS (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS nv FROM e),
p AS (SELECT a.label, a.ord AS hb_ord, b.ord AS ad_ord,
    CASE WHEN a.nv * b.nv > 0 THEN list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) / (a.nv * b.nv) END AS sim
  FROM n a JOIN n b ON a.label = b.label WHERE a.ord % 2 = 0 AND b.ord % 2 = 1)"""

_BED = lambda o: f"CASE ({o} // 2) % 6 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 0 WHEN 4 THEN 0 END"
_KIND = lambda o: f"CASE ({o} // 2) % 6 WHEN 0 THEN 'apartment' WHEN 1 THEN 'suite' WHEN 2 THEN 'apartment' WHEN 3 THEN 'room' WHEN 4 THEN 'studio' ELSE 'room' END"
_FACTS = f"""
f AS (SELECT *, {_BED('hb_ord')} AS bh, {_BED('ad_ord')} AS ba, {_KIND('hb_ord')} AS kh, {_KIND('ad_ord')} AS ka,
    abs(hb_ord % 4 - ad_ord % 4) AS d_occ, abs(hb_ord % 3 - ad_ord % 3) AS d_adults,
    CASE WHEN hb_ord % 5 > 0 AND ad_ord % 5 > 0 THEN abs(hb_ord % 5 - ad_ord % 5) END AS d_children FROM p),
g AS (SELECT *, coalesce(bh <> ba, FALSE) AS bad_bed, coalesce((kh = 'studio' AND ba > 0) OR (ka = 'studio' AND bh > 0), FALSE) AS bad_type FROM f)"""


def _adjusted(bed: float, oh: float, ol: float, ah: float, al: float, ch: float, ty: float) -> str:
    return f"""sim * CASE WHEN bad_bed THEN 1 - {bed}::DOUBLE ELSE 1::DOUBLE END
    * (1 - CASE WHEN d_occ >= 2 THEN {oh}::DOUBLE WHEN d_occ = 1 THEN {ol}::DOUBLE ELSE 0::DOUBLE END)
    * (1 - CASE WHEN d_adults >= 2 THEN {ah}::DOUBLE WHEN d_adults = 1 THEN {al}::DOUBLE ELSE 0::DOUBLE END)
    * (1 - CASE WHEN d_children >= 2 THEN {ch}::DOUBLE ELSE 0::DOUBLE END)
    * CASE WHEN bad_type THEN 1 - {ty}::DOUBLE ELSE 1::DOUBLE END"""


def _fold(source: str) -> str:
    """The greedy assignment over ``source`` (label, hb_ord, ad_ord, sim, adj) as a recursive query."""
    return f"""
r AS (SELECT label, hb_ord,
    coalesce(list(ad_ord ORDER BY -adj, -sim, ad_ord) FILTER (sim >= {T} AND adj >= {T}), []::BIGINT[]) AS valid,
    coalesce(list(ad_ord) FILTER (sim >= {T}), []::BIGINT[]) AS raw,
    coalesce(count(*) FILTER (sim IS NULL) = 0 AND max(sim) < {T}, FALSE) AS below,
    row_number() OVER (PARTITION BY label ORDER BY hb_ord) AS pos FROM {source} GROUP BY label, hb_ord),
w(label, pos, used, hb_ord, ad_ord, reason) AS (
  SELECT label, 0::BIGINT, []::BIGINT[], NULL::BIGINT, NULL::BIGINT, NULL::VARCHAR FROM r GROUP BY label
  UNION ALL
  SELECT w.label, r.pos, CASE WHEN x.pick IS NULL THEN w.used ELSE list_append(w.used, x.pick) END, r.hb_ord, x.pick,
    CASE WHEN x.pick IS NOT NULL THEN NULL WHEN len(list_filter(r.raw, lambda c: NOT list_contains(w.used, c))) > 0 THEN 'failed_validation_checks'
      WHEN r.below THEN 'below_threshold' ELSE 'no_match_found' END
  FROM w JOIN r ON r.label = w.label AND r.pos = w.pos + 1, LATERAL (SELECT list_filter(r.valid, lambda c: NOT list_contains(w.used, c))[1] AS pick) x),
a AS (SELECT w.label, w.hb_ord, w.ad_ord, w.reason, s.sim, s.adj FROM w LEFT JOIN {source} s ON w.label = s.label AND w.hb_ord = s.hb_ord AND w.ad_ord = s.ad_ord WHERE w.pos > 0)"""


_ST = f"WITH RECURSIVE {_SIM}, q AS (SELECT *, sim AS adj FROM p), {_fold('q')}"
_GM = f"WITH RECURSIVE {_SIM}, {_FACTS}, q AS (SELECT label, hb_ord, ad_ord, sim, {_adjusted(0.15, 0.12, 0.05, 0.12, 0.05, 0.08, 0.25)} AS adj FROM g), {_fold('q')}"
_UNMATCHED_AD = "(SELECT count(*) FROM e WHERE ord % 2 = 1 AND label IN (SELECT label FROM e WHERE ord % 2 = 0)) - (SELECT count(ad_ord) FROM a) + (SELECT count(*) FROM e WHERE ord % 2 = 1 AND label NOT IN (SELECT label FROM e WHERE ord % 2 = 0))"


def _digits(x: str) -> str:
    out = f"lower({x})"
    for n, w in enumerate(NUMBER_WORDS):
        out = f"regexp_replace({out}, '\\b{w}\\b', '{n}', 'g')"
    return out


_WORDS = f"""
w AS (SELECT p_partkey AS ord, p_brand AS code, p_type AS type, p_name AS name,
    lower(p_name) || ' ' || [{', '.join(f"'{w}'" for w in NUMBER_WORDS)}][p_size % 13 + 1] || ' ' || lower(p_type) || ' 2 beds' AS text FROM part),
d AS (SELECT *, {_digits('text')} AS digits FROM w),
k AS (SELECT *, list_filter(string_split(regexp_replace(digits, '([^\\w\\s''.-])', ' \\1 ', 'g'), ' '), lambda t: t <> '') AS all_words FROM d),
kk AS (SELECT *, list_filter(all_words, lambda t: len(t) > 2 OR regexp_full_match(t, '[0-9]+')) AS words,
    list_filter(all_words, lambda t: len(t) > 2 OR regexp_full_match(t, '[0-9]')) AS counted FROM k)"""
_FIRST = "fs AS (SELECT t AS token, count(*) AS n, min(ord * 1000 + pos) AS first FROM (SELECT ord, unnest(counted) AS t, generate_subscripts(counted, 1) AS pos FROM kk) GROUP BY 1)"


def _ngrams(n: int) -> str:
    parts = " || ' ' || ".join(f"words[i + {j}]" for j in range(n))
    return f"WITH {_WORDS} SELECT {parts} AS ngram, count(*) AS n FROM (SELECT words, unnest(range(1, len(words) - {n - 2})) AS i FROM kk WHERE len(words) >= {n}) GROUP BY 1"


_STOP = ", ".join(f"'{w}'" for w in KEY_TERM_STOP_WORDS)
_JACCARD = "CASE WHEN len({0}) = 0 OR len({1}) = 0 THEN 0::DOUBLE ELSE len(list_intersect(list_distinct({0}), list_distinct({1})))::DOUBLE / len(list_distinct(list_concat({0}, {1}))) END"
_NUMERIC = "CASE WHEN len({0}) = 0 AND len({1}) = 0 THEN 1::DOUBLE WHEN len({0}) = 0 OR len({1}) = 0 THEN 0::DOUBLE ELSE len(list_intersect(list_distinct({0}), list_distinct({1})))::DOUBLE / greatest(len(list_distinct({0})), len(list_distinct({1}))) END"
_BAND = "CASE WHEN {0} >= 95 THEN 'exact' WHEN {0} >= 90 THEN 'high_confidence' WHEN {0} >= 85 THEN 'medium_confidence' WHEN {0} >= 75 THEN 'low_confidence' ELSE 'none' END"
_MAPPED = f"""
rooms AS (SELECT p_partkey AS ord, 'C' || (p_partkey % 50) AS code, p_name || ' ' || (p_size % 4) || ' room' AS name, p_type AS description FROM part),
x AS (SELECT *, {_digits("trim(name)")} AS t FROM rooms),
y AS (SELECT *, list_filter(string_split(t, ' '), lambda w: len(w) > 2 OR regexp_full_match(w, '[0-9]+')) AS tok,
    list_transform(regexp_extract_all(t, '\\d+\\s*[a-z]+'), lambda f: regexp_replace(f, '^(\\d+)\\s*', '\\1_')) AS num FROM x),
ts AS (SELECT t, min(ord) AS t_ord, any_value(tok) AS tok, any_value(num) AS num FROM y WHERE ord % 2 = 1 GROUP BY t),
ss AS (SELECT t, any_value(tok) AS tok, any_value(num) AS num FROM y WHERE ord % 2 = 0 GROUP BY t),
sc AS (SELECT ss.t, ts.t_ord, ({_JACCARD.format('ss.tok', 'ts.tok')} * 35 + {_NUMERIC.format('ss.num', 'ts.num')} * 20) / 100 * 100 AS score FROM ss CROSS JOIN ts),
bs AS (SELECT t, t_ord, score FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY score DESC, t_ord) AS r FROM sc WHERE score > 0) WHERE r = 1),
m AS (SELECT y.ord, y.code, y.name, y.description, bs.t_ord AS target_ord, o.code AS target_code, o.name AS target_name, coalesce(bs.score, 0) AS score
  FROM y LEFT JOIN bs ON y.t = bs.t LEFT JOIN y o ON o.ord = bs.t_ord WHERE y.ord % 2 = 0),
b0 AS (SELECT *, CASE WHEN ord % 3 = 0 THEN 95.0 + ord % 5 WHEN ord % 3 = 1 THEN 70.0 + ord % 25 ELSE 50.0 END::DOUBLE AS match_score FROM m),
b AS (SELECT *, {_BAND.format('match_score')} AS match_type, round(match_score / 100, 2) AS confidence FROM b0)"""
_TIERS = """
hi AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY code, target_code ORDER BY ord) AS r FROM b WHERE match_type IN ('exact', 'high_confidence') AND coalesce(target_code, '') <> '') WHERE r = 1),
lo AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY ord) AS r FROM b WHERE match_type NOT IN ('exact', 'high_confidence')) WHERE r = 1),
u AS (SELECT 'high' AS tier, ord, code, target_code, match_score, match_type, confidence FROM hi UNION ALL SELECT 'low', ord, code, NULL, match_score, match_type, confidence FROM lo)"""
_COUNTS = ", ".join(f"count(*) FILTER (match_type = '{k}') AS {n}" for k, n in (("exact", "exact"), ("high_confidence", "high"), ("medium_confidence", "medium"), ("low_confidence", "low"), ("none", "none")))
_ODD = "CASE WHEN event_id % 7 = 0 THEN v || '.0' WHEN event_id % 5 = 0 THEN ' +' || v || ' ' WHEN event_id % 11 = 0 THEN '' ELSE v END"
_LI = "p AS (SELECT l_orderkey, l_linenumber, l_partkey AS p, l_suppkey AS s, l_linenumber AS k FROM lineitem)"
_OCC = f"""{_LI}, o AS (SELECT l_orderkey, l_linenumber, nullif(p % 3, 0) AS lo, nullif(p % 5, 0) AS hi, nullif(s % 3, 0) AS la, nullif(s % 4, 0) AS ha, k % 3 AS ch, nullif(k % 2, 0) AS ca, k % 2 AS inf, nullif(p % 2, 0) AS ia, nullif(s % 2, 0) AS st FROM p)"""
_PEN = lambda n, d, hi, lo, a, b: f"CASE WHEN {d} >= 2 THEN '{n}_{'high_' if lo else ''}diff: HB=' || ({a}) || ' AD=' || ({b}) || ' (-{hi}%)' " + (f"WHEN {d} = 1 THEN '{n}_low_diff: HB=' || ({a}) || ' AD=' || ({b}) || ' (-{lo}%)' " if lo else "") + "END"

def _half_even(x: str, ten: int) -> str:
    """Rounding by exact values: |x| = h + l in halves, a + b the exact product, s its double and e what that lost."""
    x, sign = f"abs({x})", f"CASE WHEN {x} < 0 THEN -1 ELSE 1 END"
    h = f"({x} * 134217729::DOUBLE - ({x} * 134217729::DOUBLE - {x}))"
    a, b = f"({h} * {ten}::DOUBLE)", f"(({x} - {h}) * {ten}::DOUBLE)"
    s = f"({a} + {b})"
    e = f"(({a} - ({s} - ({s} - {a}))) + ({b} - ({s} - {a})))"
    over = f"(({s} - floor({s}) - 0.5::DOUBLE) + {e})"
    return f"(floor({s}) + CASE WHEN {over} > 0 OR {over} = 0 AND floor({s}) % 2 = 1 THEN 1 ELSE 0 END) / {ten}::DOUBLE * {sign}"


ORACLE: dict[str, str] = {
    "hotel_pair_join": "SELECT c_nationkey AS place_id, c_custkey AS hb_c_custkey, s_suppkey AS ad_s_suppkey FROM customer JOIN supplier ON c_nationkey = s_nationkey",
    "unmatched_hotels": "SELECT c_custkey AS place_id, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)",
    "catalog_enrich": "SELECT l_orderkey, l_linenumber, coalesce(p_name, l_returnflag) AS code_description, p_partkey IS NOT NULL AS enriched FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 20) ON l_partkey = p_partkey",
    "enrich_stats": "SELECT count(*) AS attempts, count(p_partkey) AS enriched, count(*) - count(p_partkey) AS missed, 0::BIGINT AS no_code, round(count(p_partkey)::DOUBLE / count(*) * 100, 6) AS rate FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 20) ON l_partkey = p_partkey",
    "keep_last_dedup": "SELECT source, max(doc_id) AS doc_id, arg_max(lang, doc_id) AS lang, arg_max(n_chars, doc_id) AS n_chars FROM documents GROUP BY source",
    "keep_first_dedup": "SELECT source, lang, min(doc_id) AS doc_id, arg_min(n_chars, doc_id) AS n_chars FROM documents GROUP BY source, lang",
    "normalize_text": r"WITH x AS (SELECT p_partkey, lower(trim(regexp_replace('  ' || p_name || ' -' || chr(9) || ' ' || p_type, '\s+', ' ', 'g'))) AS k FROM part) SELECT p_partkey, regexp_replace(k, '[^a-z0-9\s]', '', 'g') AS plain, k AS kept FROM x",
    "key_terms": rf"WITH x AS (SELECT p_partkey, regexp_replace(lower(trim(regexp_replace(p_name || ' ' || p_type, '\s+', ' ', 'g'))), '[^a-z0-9\s]', '', 'g') AS k FROM part) SELECT p_partkey, array_to_string(list_sort(list_filter(list_distinct(regexp_extract_all(k, '\w{{4,}}')), lambda w: w NOT IN ({_STOP}))), ',') AS terms FROM x",
    "safe_int": rf"WITH x AS (SELECT event_id, json_extract_string(props, '$.k') AS v FROM events), y AS (SELECT event_id, {_ODD} AS s FROM x) SELECT event_id, coalesce(CASE WHEN regexp_full_match(s, '\s*[+-]?[0-9]+\s*') THEN TRY_CAST(replace(trim(s), '+', '') AS INTEGER) END, 0) AS n FROM y",
    "occupancy_norm": f"WITH {_LI} SELECT l_orderkey, l_linenumber, (p % 4)::INTEGER AS min_occupancy, (p % 7)::INTEGER AS max_occupancy, (s % 3)::INTEGER AS min_adults, (s % 5)::INTEGER AS max_adults, 0 AS min_children, CASE WHEN k > 2 THEN k ELSE 0 END::INTEGER AS max_children, CASE WHEN k % 2 = 1 THEN 12 END AS max_child_age, NULL::INTEGER AS min_infants, 0 AS max_infants, 0 AS max_infant_age, k::INTEGER AS standard_occupancy FROM p",
    "occupancy_text": f"""WITH {_OCC} SELECT l_orderkey, l_linenumber, coalesce(concat_ws(', ',
        CASE WHEN lo = hi THEN 'accommodates ' || hi || ' guests' WHEN lo IS NOT NULL AND hi IS NOT NULL THEN 'accommodates ' || lo || ' to ' || hi || ' guests' WHEN hi IS NOT NULL THEN 'accommodates up to ' || hi || ' guests' END,
        CASE WHEN la = ha THEN ha || ' adults' WHEN la IS NOT NULL AND ha IS NOT NULL THEN la || ' to ' || ha || ' adults' WHEN ha IS NOT NULL THEN 'up to ' || ha || ' adults' END,
        CASE WHEN ch > 0 THEN 'up to ' || ch || ' children' || coalesce(' (max age ' || ca || ')', '') END,
        CASE WHEN inf > 0 THEN 'up to ' || inf || ' infants' || coalesce(' (max age ' || ia || ')', '') END,
        CASE WHEN st > 0 THEN 'standard occupancy ' || st END), '') AS said FROM o""",
    "cosine_pairs": f"WITH {_SIM} SELECT label, hb_ord, ad_ord, round(sim, 6) AS sim FROM p WHERE sim >= {T}",
    "greedy_rank1_match": f"{_ST} SELECT label, hb_ord, ad_ord, round(sim, 6) AS sim FROM a WHERE ad_ord IS NOT NULL",
    "unmatched_with_reason": f"""{_ST}
SELECT 'hb' AS side, label, hb_ord AS ord, reason FROM a WHERE ad_ord IS NULL
UNION ALL SELECT 'ad', label, ord, 'no_hotelbeds_match_found' FROM e WHERE ord % 2 = 1 AND ord NOT IN (SELECT ad_ord FROM a WHERE ad_ord IS NOT NULL) AND label IN (SELECT label FROM e WHERE ord % 2 = 0)
UNION ALL SELECT 'ad', label, ord, 'no_hotelbeds_rooms_available' FROM e WHERE ord % 2 = 1 AND label NOT IN (SELECT label FROM e WHERE ord % 2 = 0)
UNION ALL SELECT 'hb', label, ord, 'no_axisdata_rooms_available' FROM e WHERE ord % 2 = 0 AND label NOT IN (SELECT label FROM e WHERE ord % 2 = 1)""",
    "penalized_match": f"{_GM} SELECT label, hb_ord, ad_ord, round(sim, 6) AS sim, round(adj, 6) AS adjusted, reason FROM a",
    "penalty_flags": f"""WITH {_SIM}, {_FACTS} SELECT label, hb_ord, ad_ord, round({_adjusted(0.30, 0.25, 0.10, 0.25, 0.10, 0.15, 0.50)}, 6) AS adjusted, NOT bad_bed AS bedroom_match, NOT bad_type AS room_type_match,
        NOT (d_occ >= 1 OR d_adults >= 1 OR coalesce(d_children >= 2, FALSE)) AS occupancy_match,
        concat_ws('; ', CASE WHEN bad_bed THEN 'bedroom_mismatch: HB=' || bh || ' AD=' || ba || ' (-30%)' END, {_PEN('max_occupancy', 'd_occ', 25, 10, 'hb_ord % 4 + 1', 'ad_ord % 4 + 1')}, {_PEN('max_adults', 'd_adults', 25, 10, 'hb_ord % 3 + 1', 'ad_ord % 3 + 1')}, {_PEN('max_children', 'd_children', 15, 0, 'hb_ord % 5', 'ad_ord % 5')}, CASE WHEN bad_type THEN 'studio_bedroom_mismatch (-50%)' END) AS penalties
        FROM g WHERE sim >= {T}""",
    "match_summary": f"""{_GM} SELECT count(DISTINCT label) AS pairs, count(ad_ord) AS matches, count(*) - count(ad_ord) AS unmatched_hb, any_value({_UNMATCHED_AD}) AS unmatched_ad,
        {', '.join(f"round(coalesce({f}({c}), 0), 6) AS {p}{n}" for p, c in (("", "sim"), ("adjusted_", "adj")) for n, f in (("mean", "avg"), ("median", "median"), ("min", "min"), ("max", "max")))} FROM a""",
    "hotel_totals": "SELECT l_orderkey, count(*) AS total_rooms FROM lineitem GROUP BY 1",
    "hotel_confidence": "SELECT l_orderkey, round(avg(CASE WHEN l_returnflag = 'N' THEN 1.0 ELSE 0.0 END), 6) AS confidence FROM lineitem GROUP BY 1",
    "char_batches": "SELECT doc_id // 30 AS batch, sum(length(text))::BIGINT AS chars, round(avg(length(text)), 6) AS mean_chars FROM documents GROUP BY 1",
    "number_words": f"WITH {_WORDS} SELECT ord, digits FROM d",
    "token_freq": f"WITH {_WORDS} SELECT t AS token, count(*) AS n FROM (SELECT unnest(counted) AS t FROM kk) WHERE t <> 'beds' GROUP BY 1",
    "bigrams": _ngrams(2),
    "trigrams": _ngrams(3),
    "numeric_patterns": f"WITH {_WORDS} SELECT regexp_replace(x, '\\s+', ' ', 'g') AS pattern, count(*) AS n FROM (SELECT unnest(regexp_extract_all(digits, '\\d+\\s+[a-z]+')) AS x FROM d) GROUP BY 1",
    "code_prefixes": "WITH c AS (SELECT p_partkey AS ord, CASE WHEN length(p_brand) > 2 THEN left(p_brand, length(p_brand) - 2) ELSE p_brand END AS c, lower(p_name) AS t FROM part), l AS (SELECT ord, t, left(c, n) AS prefix FROM c, (VALUES (2), (3), (4)) v(n) WHERE length(c) >= n) SELECT prefix, arg_min(t, ord) AS text FROM l GROUP BY prefix",
    "type_categories": "SELECT p_type AS category, count(*)::INTEGER AS n, arg_min(p_name, p_partkey) AS first FROM part WHERE p_type <> '' GROUP BY 1",
    "word_clusters": f"""WITH RECURSIVE {_WORDS}, {_FIRST}, top AS (SELECT token, row_number() OVER (ORDER BY n DESC, first) AS place FROM fs ORDER BY n DESC, first LIMIT 200),
      x AS (SELECT list(token ORDER BY place) AS ws FROM top),
      g(i, taken, cluster) AS (SELECT 0, []::VARCHAR[], []::VARCHAR[] UNION ALL
        SELECT i + 1, CASE WHEN skip THEN taken ELSE list_concat(taken, near) END, CASE WHEN skip THEN []::VARCHAR[] ELSE near END FROM (
          SELECT i, taken, list_contains(taken, ws[i + 1]) OR len(ws[i + 1]) <= 3 AS skip,
            list_concat([ws[i + 1]], list_filter(ws, lambda v: v <> ws[i + 1] AND NOT list_contains(taken, v) AND 1 - levenshtein(ws[i + 1], v)::DOUBLE / greatest(len(ws[i + 1]), len(v)) > 0.5)) AS near
          FROM g, x WHERE i < len(ws)))
      SELECT cluster[1] AS leader, array_to_string(cluster, ',') AS words FROM g WHERE len(cluster) > 1""",
    "categories": f"WITH {_WORDS}, {_FIRST} SELECT token AS category, n FROM fs WHERE len(token) > 3 AND n > 0.05 * (SELECT count(*) FROM w) ORDER BY n DESC, first LIMIT 30",
    "category_rooms": f"WITH {_WORDS}, {_FIRST}, c AS (SELECT token AS category FROM fs WHERE len(token) > 3 AND n > 0.05 * (SELECT count(*) FROM w) ORDER BY n DESC, first LIMIT 30) SELECT category, count(*) AS rooms FROM c JOIN w ON contains(text, category) GROUP BY 1",
    "jaccard_score": f"WITH p AS (SELECT p_partkey, p_size, string_split(lower(p_name), ' ') AS w FROM part) SELECT p.p_partkey, q.p_partkey AS q_partkey, round({_JACCARD.format('p.w', 'q.w')}, 6) AS jaccard, round({_NUMERIC.format('p.w[1:1]', 'q.w[1:2]')}, 6) AS shared FROM p JOIN p q ON p.p_size = q.p_size AND p.p_partkey < q.p_partkey",
    "best_match": f"WITH {_MAPPED} SELECT ord, target_ord, round(score, 6) AS score, {_BAND.format('score')} AS match_type FROM m",
    "indexed_match": f"WITH {_MAPPED} SELECT ord, target_ord, round(score, 6) AS score, {_BAND.format('score')} AS match_type FROM m",
    "rounded_doubles": f"""WITH v AS (SELECT l_orderkey, l_linenumber, l_extendedprice::DOUBLE / l_quantity::DOUBLE / 8 AS x, l_partkey::DOUBLE / 8 - 100 AS y, l_suppkey::DOUBLE / 200 AS z FROM lineitem)
      SELECT l_orderkey, l_linenumber, {_half_even('x', 100)} AS two, {_half_even('x', 1)} AS none, {_half_even('y', 100)} AS tie, {_half_even('z', 100)} AS near FROM v""",
    "fuzzy_stats": f"WITH {_MAPPED} SELECT count(*) AS total, count(target_ord) AS mapped, count(*) - count(target_ord) AS unmapped, printf('%.2f%%', count(target_ord)::DOUBLE / count(*) * 100) AS mapping_rate, {_COUNTS}, round(avg(match_score), 2) AS average_score, count(*) FILTER (match_type IN ('exact', 'high_confidence')) AS auto_apply, count(*) FILTER (match_type = 'medium_confidence') AS manual_review, count(*) FILTER (match_type IN ('low_confidence', 'none')) AS needs_attention FROM b",
    "tier_dedup_filter": f"WITH {_MAPPED}, {_TIERS} SELECT * FROM u",
    "filter_stats": f"WITH {_MAPPED}, {_TIERS} SELECT (SELECT count(*) FROM b) AS original_count, (SELECT count(*) FROM b) AS filtered_count, count(*) AS total, count(*) FILTER (tier = 'high') AS mapped, count(*) FILTER (tier = 'low') AS unmapped, {_COUNTS}, round(avg(match_score), 2) AS average_score, printf('%.2f%%', count(*) FILTER (tier = 'high')::DOUBLE / count(*) * 100) AS mapping_rate, (SELECT count(*) FROM b) - count(*) AS duplicates_removed FROM u",
    "simplify_mappings": f"WITH {_MAPPED} SELECT code, name, coalesce(target_code, '') AS target_code, coalesce(target_name, '') AS target_name, round(score, 6) AS match_score, {_BAND.format('score')} AS match_type FROM m",
}
