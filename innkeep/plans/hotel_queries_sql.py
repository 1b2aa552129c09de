"""DuckDB twins of ``hotel_queries``, from the driver's tables without the JSON in between."""

from __future__ import annotations

from innkeep.plans.catalog_sql import _FACTS, _MAPPED, _OCC, _SIM, _ST, _TIERS, T, _digits

_VALID = "o_orderkey % 13 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0"
_LINES = f"""
h AS (SELECT *, {_VALID} AS valid FROM orders),
l AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, l_returnflag AS f,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) - 1 AS i
  FROM lineitem JOIN h ON l_orderkey = o_orderkey WHERE valid)"""


def _issues(rooms: list[tuple[str, str]]) -> str:
    errors = [
        ("o_orderkey % 13 = 0", "'Empty value for required field: placeId'"),
        ("o_orderkey % 11 = 0 AND o_orderkey = 0", "'Empty value for required field: hotelCode'"),
        ("o_orderkey % 17 = 0", "'Missing required field: name'"),
        ("o_orderkey % 11 = 0", "'hotelCode must be string, got int'"),
        ("o_orderkey % 19 = 0", "'rooms must be list, got dict'"),
    ]
    parts = [f"SELECT 'error' AS level, o_orderkey AS hotel_ord, NULL::BIGINT AS room_ord, {m} AS message FROM h WHERE {c}" for c, m in errors]
    parts.append("SELECT 'warning', o_orderkey, NULL, 'Hotel #' || o_orderkey || ' (H' || o_orderkey || '): No rooms defined' FROM h WHERE valid AND o_orderkey NOT IN (SELECT k FROM l)")
    parts += [f"SELECT 'warning', k, i, 'Hotel #' || k || ', Room #' || i || ': ' || {m} FROM l WHERE {c}" for c, m in rooms]
    return f"WITH {_LINES} " + " UNION ALL ".join(parts)


_REACHED = "s % 7 <> 0"
_OCCUPIED = f"{_REACHED} AND p % 6 <> 0"
_HB_RULES = [
    ("n % 5 = 0", "'Missing id'"),
    ("p % 29 = 0", "'Missing or empty name'"),
    ("p % 31 = 0", "'Missing or empty roomCode'"),
    ("s % 7 = 0", "'No providers defined'"),
    ("s % 7 = 1", "'First provider should be ''hotelbeds'''"),
    ("s % 7 = 2", "'Missing provider code'"),
    (f"{_REACHED} AND p % 6 = 0", "'Missing occupancies data'"),
    (f"{_OCCUPIED} AND n < 2", "'occupancy field ''minAdult'' cannot be negative'"),
    (f"{_OCCUPIED} AND p % 3 = 0", "'occupancy field ''maxAdults'' should be int, got str'"),
    (f"{_OCCUPIED} AND s % 5 = 0", "'Missing occupancy field ''maxChildren'''"),
    (f"{_OCCUPIED} AND p % 4 > p % 5", "'minOccupancy (' || p % 4 || ') > maxOccupancy (' || p % 5 || ')'"),
    (f"{_OCCUPIED} AND n - 2 > 2", "'minAdult (' || n - 2 || ') > maxAdults (2)'"),
]
_AD_RULES = [
    ("p % 3 < 2", "'Missing or empty name'"),
    ("s % 9 = 0", "'Missing provider code'"),
    ("p % 4 > p % 5", "'MinOccupancy (' || p % 4 || ') > MaxOccupancy (' || p % 5 || ')'"),
    ("p % 7 = 0", "'occupancy field ''MaxAdultOccupancy'' is not a valid integer'"),
    ("s % 4 = 0", "'Missing occupancy field ''MaxChildOccupancy'''"),
    ("s % 4 = 1", "'occupancy field ''MaxChildOccupancy'' cannot be negative'"),
    ("n % 2 = 0", "'occupancy field ''MaxChildAge'' is not a valid integer'"),
    ("p % 8 = 0", "'occupancy field ''StandardOccupancy'' should be str, got int'"),
]
_OCC_OK = f"({_OCCUPIED} AND n >= 2 AND p % 3 <> 0 AND s % 5 <> 0 AND p % 4 <= p % 5 AND n <= 4)"
_PLAIN = "regexp_replace(lower(trim(regexp_replace({0}, '\\s+', ' ', 'g'))), '[^a-z0-9\\s]', '', 'g')"
_HOTEL = "'P' || o_custkey AS place_id, 'H' || o_orderkey AS hotel_code, ' Hotel  ' || o_orderpriority AS hotel_name, lower('Hotel ' || o_orderpriority) AS normalized_hotel_name"
_HB_NAME = "CASE WHEN p % 29 = 0 THEN '' ELSE f || '  Room #' || p END"
_AD_GIVEN = "CASE WHEN p % 4 = 0 THEN CASE p % 3 WHEN 2 THEN f || ' Name ' || p ELSE 'Unknown Room' END WHEN p % 4 = 2 THEN '' WHEN p % 4 = 3 THEN 'Desc ' || p || ' (' || f || ')' END"
_AD_NAME = "CASE p % 3 WHEN 0 THEN NULL WHEN 1 THEN 'Unknown Room' ELSE f || ' Name ' || p END"
_NONE = "NULL::INTEGER AS min_infants, NULL::INTEGER AS max_infants, NULL::INTEGER AS max_infant_age"
_AD = f"""
r AS (SELECT o_orderkey AS hotel_ord, i AS room_ord, 'o' || o_orderkey AS hotel_id, {_HOTEL}, 'axisdata' AS source, k || '-' || n AS room_id, 'A' || p AS room_code,
    coalesce({_AD_NAME}, {_AD_GIVEN}) AS room_name, {_AD_GIVEN} AS room_description, '' AS code_description, CASE WHEN s % 9 = 0 THEN '' ELSE 'k' END AS provider_code,
    coalesce({_PLAIN.format('(' + _AD_GIVEN + ')')}, '') AS normalized_description, NULL::VARCHAR AS normalized_code_description,
    (p % 4)::INTEGER AS min_occupancy, (p % 5)::INTEGER AS max_occupancy, 1 AS min_adults, CASE WHEN p % 7 = 0 THEN 0 ELSE 2 END AS max_adults, 0 AS min_children,
    CASE s % 4 WHEN 0 THEN 0 WHEN 1 THEN -1 ELSE 2 END AS max_children, CASE WHEN n % 2 <> 0 THEN 12 END AS max_child_age, {_NONE}, 2 AS standard_occupancy
  FROM l JOIN h ON k = o_orderkey)"""
_HB_OCC = "CASE WHEN p % 6 <> 0 THEN {0} END::INTEGER AS {1}"
_HB = f"""
r AS (SELECT o_orderkey AS hotel_ord, i AS room_ord, 'o' || o_orderkey AS hotel_id, {_HOTEL}, 'hotelbeds' AS source, CASE WHEN n % 5 = 0 THEN '' ELSE k || '-' || n END AS room_id,
    CASE WHEN p % 31 <> 0 THEN ' C' || p || ' ' END AS room_code, {_HB_NAME} AS room_name, {_HB_NAME} AS room_description, '' AS code_description,
    CASE s % 7 WHEN 0 THEN '' WHEN 1 THEN 'x' WHEN 2 THEN '' ELSE 'c' || s END AS provider_code, {_PLAIN.format('(' + _HB_NAME + ')')} AS normalized_description, NULL::VARCHAR AS normalized_code_description,
    {_HB_OCC.format('p % 4', 'min_occupancy')}, {_HB_OCC.format('p % 5', 'max_occupancy')}, {_HB_OCC.format('n - 2', 'min_adults')}, {_HB_OCC.format('2', 'max_adults')},
    {_HB_OCC.format('0', 'min_children')}, {_HB_OCC.format('CASE WHEN s % 5 = 0 THEN 0 ELSE 1 END', 'max_children')}, NULL::INTEGER AS max_child_age, {_NONE}, NULL::INTEGER AS standard_occupancy, p
  FROM l JOIN h ON k = o_orderkey)"""
_ENRICHED = """
x AS (SELECT r.*, CASE WHEN p_partkey % 2 = 0 THEN p_name || ' Suite' END AS found FROM r LEFT JOIN part ON p = p_partkey
  WHERE hotel_ord NOT IN (SELECT hotel_ord FROM r WHERE room_code IS NULL))"""
_DESCRIBE = """concat_ws(', ',
    CASE WHEN min_occupancy = max_occupancy THEN 'accommodates ' || max_occupancy || ' guests' ELSE 'accommodates ' || min_occupancy || ' to ' || max_occupancy || ' guests' END,
    CASE WHEN min_adults = max_adults THEN max_adults || ' adults' ELSE min_adults || ' to ' || max_adults || ' adults' END,
    CASE WHEN max_children > 0 THEN 'up to ' || max_children || ' children' || CASE WHEN max_child_age IS NOT NULL THEN ' (max age ' || max_child_age || ')' ELSE '' END END,
    CASE WHEN standard_occupancy > 0 THEN 'standard occupancy ' || standard_occupancy END)"""
_COLS = "provider, hotel_ord, room_ord, base AS base_description, said AS occupancy_text, CASE WHEN said <> '' THEN base || '. ' || said ELSE base END AS text_for_embedding"
_FIELDS = [("min_occupancy", "lo"), ("max_occupancy", "hi"), ("min_adults", "la"), ("max_adults", "ha"), ("max_children", "ch"), ("max_child_age", "ca"), ("max_infants", "inf"), ("max_infant_age", "ia"), ("standard_occupancy", "st")]
_SPACE = "\\x09-\\x0D\\x{85}\\p{Z}"
_WORDY = "\\p{L}\\p{M}\\p{Nd}\\p{Nl}\\p{Pc}"
_TOKENS = f"""
x AS (SELECT doc_id, {_digits('text')} AS t FROM documents WHERE text IS NOT NULL),
y AS (SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(regexp_replace(t, '([^{_WORDY}{_SPACE}''.-])', ' \\1 ', 'g'), '\\.([{_SPACE}]|$)', ' .\\1', 'g'), '[{_SPACE}]+'), lambda w: w <> '') AS words FROM x),
z AS (SELECT list_filter(words, lambda w: len(w) > 2 OR regexp_full_match(w, '[0-9]')) AS counted, list_filter(words, lambda w: len(w) > 2 OR regexp_full_match(w, '[0-9]+')) AS kept FROM y)"""

ORACLE = {
    "validate_records": _issues(_HB_RULES),
    "validate_textual_records": _issues(_AD_RULES),
    "catalog_stats": f"""WITH i AS ({_issues(_HB_RULES)}), {_LINES} SELECT (SELECT count(*) FROM h) AS hotels, (SELECT count(*) FROM h WHERE valid) AS valid_hotels, (SELECT count(*) FROM l) AS rooms,
      (SELECT count(*) FROM l WHERE {_OCC_OK}) AS rooms_with_occupancy, (SELECT count(*) FROM i WHERE level = 'error') AS errors, (SELECT count(*) FROM i WHERE level = 'warning') AS warnings""",
    "normalized_rooms": f"WITH {_LINES}, {_HB} SELECT * EXCLUDE (p) FROM r",
    "normalized_textual_rooms": f"WITH {_LINES}, {_AD} SELECT * FROM r",
    "normalized_hotels": f"""WITH {_LINES} SELECT o_orderkey AS hotel_ord, 'o' || o_orderkey AS hotel_id, {_HOTEL}, 'axisdata' AS source, coalesce(string_agg(k || '-' || n, ',' ORDER BY i), '') AS room_ids,
      (SELECT count(*) FROM h WHERE valid) AS total_count, (SELECT count(*) FROM l) AS total_rooms, (SELECT count(*) FROM l) AS total_rooms_with_occupancy
      FROM h LEFT JOIN l ON k = o_orderkey WHERE valid GROUP BY o_orderkey, o_custkey, o_orderpriority""",
    "extract_occupancy": f"WITH {_LINES}, {_HB} SELECT hotel_code, room_code, {', '.join(c for c in ['min_occupancy', 'max_occupancy', 'min_adults', 'max_adults', 'min_children', 'max_children', 'max_child_age', 'min_infants', 'max_infants', 'max_infant_age', 'standard_occupancy'])} FROM r WHERE p % 6 <> 0",
    "embedding_texts": f"WITH {_LINES}, {_HB}, {_ENRICHED} SELECT hotel_ord, room_ord, coalesce(nullif({_PLAIN.format('found')}, ''), normalized_description) AS text_for_embedding FROM x WHERE coalesce(nullif({_PLAIN.format('found')}, ''), normalized_description) <> ''",
    "described_texts": f"""WITH {_LINES}, {_HB}, {_ENRICHED},
      one AS (SELECT 'hotelbeds' AS provider, hotel_ord, room_ord, coalesce({_PLAIN.format('found')}, '') AS base, CASE WHEN min_occupancy IS NULL THEN '' ELSE {_DESCRIBE} END AS said FROM x),
      two AS (WITH {_AD} SELECT 'axisdata' AS provider, hotel_ord, room_ord, lower(coalesce(nullif(normalized_description, ''), nullif(room_description, ''), nullif(room_name, ''), '')) AS base, {_DESCRIBE} AS said FROM r)
      SELECT {_COLS} FROM (SELECT * FROM one UNION ALL SELECT * FROM two) WHERE base <> '' OR said <> ''""",
    "hotel_texts": "SELECT o_orderkey AS hotel_ord, lower('Hotel ' || o_orderpriority) AS normalized, lower(' Hotel  ' || o_orderpriority) AS lower FROM orders WHERE " + _VALID,
    "occupancy_summary": f"WITH {_OCC} SELECT l_orderkey, l_linenumber, '{{' || array_to_string(list_filter([{', '.join(f'''CASE WHEN {c} IS NOT NULL THEN '"{n}":' || {c} END''' for n, c in _FIELDS)}], lambda x: x IS NOT NULL), ',') || '}}' AS said FROM o",
    "room_texts": "SELECT p_partkey, trim(coalesce(CASE WHEN p_size % 3 = 1 THEN p_name END, CASE WHEN p_size % 5 > 0 THEN p_type END, '')) AS text FROM part",
    "flag_counts": f"WITH {_SIM}, {_FACTS} SELECT count(*) FILTER (bad_bed OR bad_type OR d_occ > 0 OR d_adults > 0 OR coalesce(d_children, 0) >= 2) AS with_warnings, count(*) FILTER (d_occ > 0 OR d_adults > 0 OR coalesce(d_children, 0) >= 2) AS occupancy_warnings FROM g WHERE sim >= {T}",
    "mapped_report": f"""{_ST}, both_sides AS (SELECT label, count(*) FILTER (ord % 2 = 0) AS hb, count(*) FILTER (ord % 2 = 1) AS ad FROM e GROUP BY label),
      u AS (SELECT e.label, ord, CASE WHEN ord % 2 = 0 THEN CASE WHEN ad = 0 THEN 'no_axisdata_rooms_available' ELSE (SELECT any_value(reason) FROM a WHERE a.label = e.label AND hb_ord = ord) END
          ELSE CASE WHEN hb = 0 THEN 'no_hotelbeds_rooms_available' ELSE 'no_hotelbeds_match_found' END END AS reason
        FROM e JOIN both_sides b ON e.label = b.label WHERE (e.label, ord) NOT IN (SELECT (label, hb_ord) FROM a WHERE ad_ord IS NOT NULL) AND (e.label, ord) NOT IN (SELECT (label, ad_ord) FROM a WHERE ad_ord IS NOT NULL))
      SELECT (row_number() OVER (ORDER BY 'p' || b.label) - 1)::INTEGER AS pos, 'p' || b.label AS place_id, 'hb' || b.label AS hotelbeds_hotel_code, 'ad' || b.label AS axisdata_hotel_name, 1.0::DOUBLE AS confidence, hb AS hotelbeds_total_rooms, ad AS axisdata_total_rooms,
        coalesce((SELECT string_agg('c' || hb_ord || ':' || ad_ord || ':room ' || ad_ord, ',' ORDER BY hb_ord) FROM a WHERE a.label = b.label AND ad_ord IS NOT NULL), '') AS matches,
        coalesce((SELECT string_agg(ord || ':' || reason, ',' ORDER BY ord) FROM u WHERE u.label = b.label AND ord % 2 = 0), '') AS unmatched_hb,
        coalesce((SELECT string_agg('c' || ord || ':' || reason, ',' ORDER BY ord) FROM u WHERE u.label = b.label AND ord % 2 = 1), '') AS unmatched_ad,
        (SELECT count(DISTINCT label) FROM a) AS pairs, (SELECT count(ad_ord) FROM a) AS all_matches, (SELECT round(median(sim), 6) FROM a) AS median FROM both_sides b""",
    "output_document": """WITH l AS (SELECT l_orderkey AS k, count(*) AS n, count(*) FILTER (l_returnflag = 'N') AS m FROM lineitem GROUP BY 1)
      SELECT (row_number() OVER (ORDER BY o_orderkey) - 1)::INTEGER AS pos, o_custkey, round(coalesce(m::DOUBLE / n, 0), 6) AS confidence, coalesce(n, 0)::INTEGER AS n_rooms, round(coalesce(0.8::DOUBLE * m, 0), 6) AS room_confidence,
        (SELECT count(*) FROM orders)::INTEGER AS total_hotels, (SELECT sum(n) FROM l JOIN orders ON k = o_orderkey)::BIGINT AS total_rooms FROM orders LEFT JOIN l ON k = o_orderkey""",
    "filtered_order": f"WITH {_MAPPED}, {_TIERS} SELECT row_number() OVER (ORDER BY match_score DESC, tier, ord)::INTEGER AS place, tier, ord, code, match_score FROM u",
    "embedded_texts": "WITH x AS (SELECT p_partkey, p_name || ' ' || p_type AS t FROM part) SELECT p_partkey, t AS text_for_embedding, len(t) || ',' || " + " || ',' || ".join(f"len(t) - len(replace(t, '{c}', ''))" for c in "aeiou") + " AS vector FROM x",
    "catalog_lookup": "SELECT 'C' || p_partkey % 40 AS code, arg_max(p_name, p_partkey) AS \"codeDescription\", arg_max(p_type, p_partkey) AS type FROM part WHERE p_partkey % 40 IN (7, 39) GROUP BY 1",
    "first_matches": f"{_ST} SELECT label, hb_ord, ad_ord FROM a WHERE ad_ord IS NOT NULL ORDER BY label, hb_ord LIMIT 10",
    "document_tokens": f"WITH {_TOKENS} SELECT token, count(*) AS n FROM (SELECT unnest(counted) AS token FROM z) GROUP BY 1",
    "document_bigrams": f"WITH {_TOKENS} SELECT kept[i] || ' ' || kept[i + 1] AS ngram, count(*) AS n FROM (SELECT kept, unnest(range(1, len(kept))) AS i FROM z WHERE len(kept) > 1) GROUP BY 1",
    "document_numbers": f"WITH {_TOKENS} SELECT regexp_replace(p, '\\s+', ' ') AS pattern, count(*) AS n FROM (SELECT unnest(regexp_extract_all(t, '\\d+\\s+[a-z]+')) AS p FROM x) GROUP BY 1",
}
