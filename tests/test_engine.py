"""The catalog engine: semantics of each operator on small hand-made inputs, and greedy assignment against a plain loop."""

import json
import random
import statistics
import unicodedata
from collections import Counter
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from innkeep import settings
from innkeep.functions import occupancy, scoring, text
from innkeep.operators import embed, enrich, fuzzy, learn, matching, summary, tiers
from innkeep.plans import fuzzy_run
from innkeep.plans import run as plan
from innkeep.plans import hotel_queries
from innkeep.sources import hotels as src
from innkeep.sources import tables


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("raw", "full"),
    [("Hôtel  Paris™", "hotel paristm"), ("a - b", "a  b"), ("½ Straße X", "12 strae x"), (None, ""), ("  ", "")],
)
def test_normalize_full(spark, raw, full):
    assert one(spark, raw, text.normalize_full) == full


def test_text_functions(spark):
    assert [one(spark, s, text.safe_int) for s in ("4", " 4 ", "+4", "4.0", "", None, "x")] == [4, 4, 4, 0, 0, 0, 0]
    assert one(spark, "One bedroom, twelve beds; phone", text.number_words) == "1 bedroom, 12 beds; phone"
    assert one(spark, "2 queen beds 3 x", text.numeric_features) == ["2_queen", "3_x"]
    assert one(spark, "2  queen 3beds", text.numeric_patterns) == ["2 queen"]
    assert one(spark, "a big sea-view room (2)", text.kept_tokens) == ["big", "sea-view", "room", "2"]
    assert one(spark, "Deluxe sea view with deluxe terrace", text.key_terms) == ["deluxe", "terrace"]
    assert [text.stem(w) for w in ("caresses", "ponies", "hopping", "relational", "bedrooms", "conditional", "sky", "agreed")] == ["caress", "poni", "hop", "relat", "bedroom", "condit", "sky", "agre"]
    assert one(spark, ["a", "b", "c"], lambda c: text.ngrams(c, 2), "array<string>") == ["a b", "b c"]
    assert one(spark, ["a"], lambda c: text.ngrams(c, 2), "array<string>") == []
    assert [one(spark, c, lambda x: text.code_prefix(text.trimmed_code(x))) for c in ("ABCDEFG", "ABC", "A")] == ["ABCD", "A", "A"]


def test_bedrooms_and_types(spark):
    assert [one(spark, s, scoring.bedrooms) for s in ("2 bedroom", "one bedroom", "Studio", "twin room", "12bedroom")] == [2, 1, 0, None, 12]
    assert [one(spark, s, scoring.room_type) for s in ("studio apartment", "studio", "apt 3", "king")] == ["apartment", "studio", "apartment", None]


def test_occupancy(spark):
    kind = "struct<" + ",".join(f"{f}:string" for f in src.AXISDATA.ints) + ">"
    row = {f: None for f in src.AXISDATA.ints} | {"MinOccupancy": "1", "MaxOccupancy": "4.0", "MaxChildAge": "", "MaxInfantAge": "0", "StandardOccupancy": "x", "MaxAdultOccupancy": " 3 "}
    got = one(spark, row, occupancy.from_axisdata, kind).asDict()
    assert got["min_occupancy"] == 1 and got["max_occupancy"] == 0 and got["max_adults"] == 3 and got["max_child_age"] is None and got["max_infant_age"] == 0 and got["standard_occupancy"] == 0
    said = one(spark, {**dict.fromkeys(occupancy.FIELDS + occupancy.OPTIONAL), "min_occupancy": 2, "max_occupancy": 2, "max_children": 1, "max_child_age": 12}, occupancy.describe, occupancy.STRUCT)
    assert said == "accommodates 2 guests, up to 1 children (max age 12)"


def greedy(pairs, t):
    """(block, hb, ad or None, reason) by the plain loop."""
    out = []
    by = {}
    for b, h, a, s, adj in pairs:
        by.setdefault(b, {}).setdefault(h, []).append((a, s, adj))
    for b, rows in by.items():
        used = set()
        for h in sorted(rows):
            raw = [(a, s, adj) for a, s, adj in sorted(rows[h]) if s is not None and s >= t and a not in used]
            ok = sorted((x for x in raw if x[2] >= t), key=lambda x: (-x[2], -x[1], x[0]))
            if ok:
                used.add(ok[0][0])
                out.append((b, h, ok[0][0], None))
            elif raw:
                out.append((b, h, None, "failed_validation_checks"))
            else:
                sims = [s for _, s, _ in rows[h]]
                out.append((b, h, None, "below_threshold" if None not in sims and max(sims) < t else "no_match_found"))
    return sorted(out, key=str)


def test_greedy_against_loop(spark):
    rng = random.Random(7)
    pairs = []
    for b in range(30):
        for h in range(rng.randint(1, 7)):
            for a in range(rng.randint(1, 6)):
                s = rng.choice([0.1, 0.4, 0.5, 0.6, 0.8, 0.9, None])
                pairs.append((b, h, a, s, None if s is None else s * rng.choice([1.0, 1.0, 0.7])))
    df = spark.createDataFrame(pairs, "b long, hb_ord long, ad_ord long, sim double, adj double")
    got = matching.assign(df, "b", 0.5, F.col("adj")).collect()
    assert sorted(((r["b"], r["hb_ord"], r["ad_ord"], r["reason"]) for r in got), key=str) == greedy(pairs, 0.5)
    assert sum(r["ad_ord"] is not None for r in got) > 30


def test_zero_vectors_and_empty_sides(spark):
    hb = spark.createDataFrame([("p", 0, [1.0, 0.0]), ("p", 1, [0.0, 0.0]), ("q", 0, [1.0, 0.0])], "place string, ord long, v array<double>")
    ad = spark.createDataFrame([("p", 0, [1.0, 0.0]), ("r", 0, [1.0, 1.0])], "place string, ord long, v array<double>")
    a = matching.match_rooms(hb, ad, "place", "v", 0.75)
    assert {(r["hb_ord"], r["ad_ord"], r["reason"]) for r in a.collect()} == {(0, 0, None), (1, None, "no_match_found")}
    un = {(r["side"], r["place"], r["ord"], r["reason"]) for r in matching.unmatched_rooms(hb, ad, a, "place").collect()}
    assert un == {("hb", "p", 1, "no_match_found"), ("hb", "q", 0, "no_axisdata_rooms_available"), ("ad", "r", 0, "no_hotelbeds_rooms_available")}
    empty = a.where("1 = 0")
    row = summary.match_summary(empty, empty, "place").first()
    assert row["pairs"] == 0 and row["mean"] == 0.0 and row["median"] == 0.0


def test_penalties(spark):
    row = [(1.0, "studio", "2 bedroom suite", (2, 2, 0), (5, 3, 1))]
    occ = "struct<max_occupancy:int,max_adults:int,max_children:int>"
    df = spark.createDataFrame(row, f"s double, a string, b string, x {occ}, y {occ}")
    p = df.select(scoring.penalized(F.col("s"), F.col("a"), F.col("b"), F.col("x"), F.col("y")).alias("p")).first()["p"]
    assert abs(p["adjusted"] - 0.7 * 0.75 * 0.9 * 0.5) < 1e-12
    assert p["flags"]["penalties_applied"] == ["bedroom_mismatch: HB=0 AD=2 (-30%)", "max_occupancy_high_diff: HB=2 AD=5 (-25%)", "max_adults_low_diff: HB=2 AD=3 (-10%)", "studio_bedroom_mismatch (-50%)"]


HB = [
    {"placeId": "p1", "hotelCode": "H1", "name": "Casa Sol", "rooms": [
        {"id": "1", "name": "1 bedroom apartment", "roomCode": " A1 ", "providers": [{"name": "hotelbeds", "code": "c"}], "occupancies": {"minOccupancy": 1, "maxOccupancy": 4, "minAdult": 1, "maxAdults": 2, "maxChildren": 2}},
        {"id": "2", "name": "double room", "roomCode": "ZZ", "providers": [], "occupancies": {}},
    ]},
    {"placeId": "", "hotelCode": 5, "name": "Bad", "rooms": {}},
    "nonsense",
]
AD = [
    {"_id": {"oid": "o"}, "placeId": "p1", "hotelCode": "X1", "name": "Casa Sol", "rooms": [
        {"id": "9", "name": None, "code": None, "description": None, "providers": [{"name": "axisData", "code": "k"}], "occupancies": {"MinOccupancy": "3", "MaxOccupancy": "2"}},
        {"id": "8", "name": "1 Bedroom Apartment", "code": "AP1", "description": "1 Bedroom Apartment", "providers": [{"name": "axisData", "code": "k"}]},
    ]},
    {"placeId": "p2", "hotelCode": "X2", "name": "Other", "rooms": []},
]
TYPES = [{"code": "A1", "codeDescription": "Old", "type": "t", "occupancies": []}, {"code": " A1", "codeDescription": " 1 Bedroom Apartment ", "type": "t", "occupancies": []}, {"code": "B", "type": "t"}]


@pytest.fixture
def files(tmp_path):
    for name, data in (("hb", HB), ("ad", AD), ("types", TYPES)):
        (tmp_path / f"{name}.json").write_text(json.dumps(data))
    return tmp_path


def test_catalog_validation(spark, files):
    hb = src.load_catalog(spark, str(files / "hb.json"), src.HOTELBEDS)
    said = {(r["level"], r["hotel_ord"], r["message"]) for r in hb.issues.collect()}
    assert ("error", 2, "Must be a dict, got str") in said and ("error", 1, "hotelCode must be string, got int") in said
    assert ("error", 1, "Empty value for required field: placeId") in said and ("error", 1, "rooms must be list, got dict") in said
    assert ("warning", 0, "Hotel #0, Room #1: No providers defined") in said
    s = hb.stats().first()
    assert (s["hotels"], s["valid_hotels"], s["rooms"], s["rooms_with_occupancy"]) == (3, 1, 2, 1)
    ad = src.load_catalog(spark, str(files / "ad.json"), src.AXISDATA)
    said = {r["message"] for r in ad.issues.collect()}
    assert "Hotel #0, Room #0: MinOccupancy (3) > MaxOccupancy (2)" in said and "Hotel #1 (X2): No rooms defined" in said
    assert "Hotel #0, Room #0: Missing or empty name" in said and "Hotel #0, Room #1: Missing occupancies data" in said
    with pytest.raises(src.CatalogError, match="Validation failed"):
        src.load_catalog(spark, str(files / "hb.json"), src.HOTELBEDS, strict=True)


def test_bad_files(spark, tmp_path):
    (tmp_path / "x.json").write_text("{")
    (tmp_path / "y.json").write_text('{"a": 1}')
    for name, why in (("none.json", "not found"), ("x.json", "Invalid JSON"), ("y.json", "must be a list")):
        with pytest.raises(src.CatalogError, match=why):
            src.read_records(spark, str(tmp_path / name))
    assert src.read_normalized(spark, str(tmp_path / "y.json")).count() == 1


def test_normalized(spark, files):
    cat = src.load_catalog(spark, str(files / "ad.json"), src.AXISDATA)
    rooms = src.normalized_rooms(src.flat_rooms(cat, src.AXISDATA), src.AXISDATA)
    got = src.normalized_hotels(rooms, cat, src.AXISDATA).orderBy("hotel_ord").collect()
    assert [len(h["rooms"]) for h in got] == [2, 0] and got[0]["hotel_id"] == "o" and got[0]["normalized_hotel_name"] == "casa sol"
    null, full = got[0]["rooms"]
    assert null["room_name"] is None and null["normalized_description"] == "" and null["code_description"] == "" and null["provider_code"] == "k"
    assert full["normalized_description"] == "1 bedroom apartment" and full["occupancy"] is None
    meta = summary.normalization_metadata(src.normalized_hotels(rooms, cat, src.AXISDATA)).first()
    assert tuple(meta) == (2, 2, 1)


@pytest.mark.parametrize("method", ["plain", "validated"])
def test_pipeline(spark, files, method):
    cfg = plan.Config(str(files / "hb.json"), str(files / "ad.json"), str(files / "out"), str(files / "types.json"), method, 0.4 if method == "validated" else None)
    report = plan.run(spark, cfg)
    assert report["summary"]["matches"] == 1 and report["summary"]["pairs"] == 1
    pair = spark.read.json(str(files / "out/hotel_pairs")).first()
    assert pair["room_matches"][0]["hotelbeds_room_id"] == "1" and pair["room_matches"][0]["axisdata_room_id"] == "8"


def test_stages_run_alone(spark, files, monkeypatch):
    out = files / "alone"
    args = [str(files / "hb.json"), str(files / "ad.json"), "--catalog", str(files / "types.json"), "--output-dir", str(out), "--method", "validated", "--threshold", "0.4"]
    for stage in plan.STAGES:
        assert plan.main([*args, "--stage", stage]) == 0
    report = json.loads(spark.read.text(f"{out}/report_match").first()["value"])
    assert report["steps"] == ["match"] and report["summary"]["matches"] == 1
    doc = spark.read.json(f"{out}/normalized_axisdata_document").first()
    assert (doc["metadata"]["total_count"], doc["metadata"]["total_rooms"], len(doc["hotels"]), doc["metadata"]["source"]) == (2, 2, 2, "axisdata")
    assert spark.read.json(f"{out}/enriched_hotelbeds_rows").where("enriched").count() == 1
    assert plan.main([*args, "--no-document", "--skip-normalization", "--skip-embeddings"]) == 0
    report = json.loads(spark.read.text(f"{out}/report").first()["value"])
    assert report["steps"] == ["load", "enrich", "normalize_skipped", "embed_skipped", "match"] and report["stages"]["load"]["hotelbeds"]["errors"] == 4
    events = Counter(r["event_type"] for r in spark.read.json(f"{out}/audit").collect())
    assert events["pipeline_start"] == events["pipeline_complete"] == 6 and events["room_match"] == 2 and events["hotel_match"] == 2
    assert plan.main([str(files / "none.json"), *args[1:], "--stage", "load"]) == 1
    assert spark.read.json(f"{out}/audit").where("event_type = 'error'").count() == 1
    bad = [*args[:3], str(files / "none.json"), *args[4:]]
    assert plan.main(bad) == 0 and "enrich_failed" in spark.read.text(f"{out}/report").first()["value"]


def test_embedding_envelopes(spark, tmp_path):
    hotels = spark.createDataFrame([(0, "H1", "p", "One"), (1, "H1", "q", "Two"), (2, "H2", "r", "Three")], "ord long, hotel_code string, place_id string, hotel_name string")
    rooms = spark.createDataFrame([(0, "1", "H1", "a", "text", [1.0, 0.0]), (1, "2", "H1", "b", None, [0.0, 1.0])], "ord long, room_id string, hotel_code string, room_code string, text_for_embedding string, embedding array<double>")
    for name, df in (("hotels", hotels), ("rooms", rooms)):
        tables.write_document(tables.enveloped(df, "embeddings", ["ord"], model="m"), f"{tmp_path}/{name}")
    both = tables.load_embeddings(spark, *[f"{tmp_path}/{n}" for n in ("hotels", "rooms", "hotels", "rooms")])
    for h, r in both.values():
        assert {(x["hotel_code"], x["hotel_name"]) for x in h.collect()} == {("H1", "Two"), ("H2", "Three")}
        assert [(x["ord"], x["room_id"], x["text_for_embedding"], x["embedding"]) for x in r.orderBy("ord").collect()] == [(0, "1", "text", [1.0, 0.0]), (1, "2", "", [0.0, 1.0])]
    assert spark.read.json(f"{tmp_path}/rooms").first()["metadata"]["total_count"] == 2


def test_settings_and_logging(tmp_path, capsys):
    s = settings.Settings.from_env({"INNKEEP_BATCH_SIZE": "7", "INNKEEP_LOG_FILE": str(tmp_path / "errors"), "OTHER": "x"})
    assert (s.batch_size, s.room_threshold, s.output_dir) == (7, 0.8, "out")
    log = settings.logger(s, "innkeep.test")
    log.info("fine")
    try:
        raise ValueError("why")
    except ValueError:
        log.exception("broken %d", 3)
    [line] = (tmp_path / "errors").read_text().splitlines()
    said = json.loads(line)
    assert (said["level"], said["message"]) == ("ERROR", "broken 3") and "ValueError: why" in said["exception"]
    assert len(settings.logger(s, "innkeep.test").handlers) == 2 and settings.device() in ("cpu", "cuda")


def test_lookups_and_samples(spark):
    types = enrich.catalog(spark.createDataFrame([(0, "A", "x", "t", 1), (1, " A ", "y", "t", 1), (2, "B", "", "t", 1), (3, None, "z", "t", 1)], "ord long, code string, codeDescription string, type string, occupancies int"))
    assert [r["codeDescription"] for r in enrich.lookup(types, " A").collect()] == ["y"] and enrich.lookup(types, "B").count() == 0
    assert [r["id"] for r in summary.samples(spark.range(9).repartition(3), ["id"], 3).collect()] == [0, 1, 2]


@pytest.mark.parametrize("n", [0, 1, 2, 7, 400, 401])
def test_exact_median(spark, n):
    rng = random.Random(n)
    xs = [rng.choice([rng.uniform(-3, 3), 0.25, rng.gauss(0.5, 1e-8)]) for _ in range(n)]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double").repartition(3)
    assert abs(summary.exact_median(df, "x", "m").first()["m"] - (statistics.median(xs) if xs else 0.0)) < 1e-15


def test_unicode_forms_and_stems(spark):
    docs = ["Ŕésumé ™ ½ ﬁne", "Ａｂｃ  １２", "naïve\tcafé", "", None, "ﷺ", "e\u0301\u0327 x", "Å Å"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "i long, t string")
    got = {r["i"]: r["x"] for r in df.select("i", text.normalize_full(F.col("t"), remove_special=False).alias("x")).collect()}
    plain = lambda t: " ".join("".join(c for c in unicodedata.normalize("NFKD", t or "") if unicodedata.category(c) != "Mn").split()).lower()
    assert got == {i: plain(t) for i, t in enumerate(docs)}
    #: Examples of the published algorithm.
    pairs = "caress caress cats cat feed feed agreed agre plastered plaster bled bled motoring motor sing sing conflated conflat troubled troubl sized size falling fall hissing hiss fizzed fizz failing fail filing file happy happi rational ration valenci valenc digitizer digit conformabli conform radicalli radic differentli differ vileli vile analogousli analog vietnamization vietnam predication predic operator oper feudalism feudal decisiveness decis hopefulness hope callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic formative form formalize formal electriciti electr electrical electr hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust dependent depend adoption adopt communism commun activate activ angulariti angular homologous homolog effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll".split()
    assert [text.stem(w) for w in pairs[::2]] == pairs[1::2]


@pytest.mark.parametrize("block", [20_000, 3])
def test_fuzzy_search_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(fuzzy, "BLOCK_TEXTS", block)
    rng = random.Random(block)
    words = ["double", "rooms", "room", "suite", "suites", "sea", "view", "two", "beds", "king", "queens", "deluxe", "3", "terrace"]
    name = lambda: " ".join([*rng.choices(words, k=rng.randint(0, 4)), "room"]) if rng.random() > 0.05 else rng.choice(["", "§§", "zz"])
    kind = "ord long, code string, name string, description string"
    one, two = [(i, f"A{i}", name(), None) for i in range(60)], [(i, f"B{i}", name(), None) for i in range(50)]
    a, b = spark.createDataFrame(one, kind), spark.createDataFrame(two, kind)
    features = lambda df: [(r["ord"], r["text"], set(r["tokens"]), set(r["stems"]), set(r["numeric_features"])) for r in fuzzy.normalize_rooms(df).orderBy("ord").collect()]
    jaccard = lambda x, y: len(x & y) / len(x | y) if x and y else 0.0
    sides = features(a), features(b)
    got = {r["ord"]: r for r in fuzzy.best_matches(a, b).collect()}
    assert len(got) == 60
    for o, t, tok, stem, num in sides[0]:
        scores = []
        for p, u, tok2, stem2, num2 in sides[1]:
            number = 1.0 if not num and not num2 else len(num & num2) / max(len(num), len(num2)) if num and num2 else 0.0
            ratio = round(100 * SequenceMatcher(None, t, u).ratio()) / 100 if t and u else 0.0
            scores.append(((jaccard(tok, tok2) * 35 + jaccard(stem, stem2) * 30 + number * 20 + ratio * 15) / 100 * 100, -p))
        best = max(scores)
        assert (got[o]["score"], got[o]["target_ord"]) == ((best[0], -best[1]) if best[0] > 0 else (0.0, None))


def test_mappings_of_a_document(spark, tmp_path):
    room = lambda c: {"code": c, "name": f"n{c}", "description": None}
    rows = [{"source_room": room("a"), "target_room": room("x"), "match_score": 99.0, "match_type": "exact", "confidence": 0.99}, {"source_room": room("b"), "target_room": None, "match_score": 10.0, "match_type": "none", "confidence": 0.1}]
    (tmp_path / "m.json").write_text(json.dumps({"mappings": rows}))
    assert fuzzy_run.main(["--from", f"{tmp_path}/m.json", "--output-dir", f"{tmp_path}/out"]) == 0
    got = [(r["tier"], r["code"], r["target_code"]) for r in spark.read.json(f"{tmp_path}/out/filtered").orderBy("ord").collect()]
    assert got == [("high", "a", "x"), ("low", "b", None)]


def test_enrich_drops_hotels_with_null_codes(spark):
    rooms = spark.createDataFrame([("h", " A ", "x"), ("h", "B", "y"), ("i", None, "z"), ("i", "A", "z"), ("j", "", "w")], "hotel string, room_code string, code_description string")
    types = spark.createDataFrame([("A", "found")], "code string, codeDescription string")
    got = enrich.enrich(rooms, types, "hotel")
    assert {(r["hotel"], r["code_description"]) for r in got.collect()} == {("h", "found"), ("h", "y"), ("j", "w")}
    s = enrich.enrichment_stats(got).first()
    assert (s["attempts"], s["enriched"], s["no_code"], s["rate"]) == (2, 1, 1, 50.0)


def test_fuzzy_and_tiers(spark):
    kind = "ord long, code string, name string, description string"
    a = spark.createDataFrame([(0, "A1", "two bed suite", None), (1, "A2", "", "king room"), (2, "A3", "zzz", None)], kind)
    b = spark.createDataFrame([(0, "B1", "king room", None), (1, "B2", "2 bed suite", None), (2, "B3", "2 bed suite", None)], kind)
    got = {r["code"]: r for r in fuzzy.best_matches(a, b).collect()}
    assert got["A1"]["target_code"] == "B2" and got["A1"]["match_type"] == "exact" and got["A2"]["target_code"] == "B1"
    assert got["A3"]["match_type"] == "none" and got["A3"]["score"] < 50
    m = spark.createDataFrame(
        [(0, "x", "h1", "exact", 99.0), (1, "x", "h1", "exact", 98.0), (2, "x", "h2", "low_confidence", 76.0), (3, "y", None, "exact", 97.0), (4, "y", "h3", "none", 10.0), (5, "y", "h3", "none", 9.0), (6, "z", "h", "odd", 1.0)],
        "ord long, code string, target_code string, match_type string, match_score double",
    ).selectExpr("*", "'d' AS description", "'n' AS target_name", "0.5 AS confidence", "1 AS target_ord")
    u = tiers.tiered(m)
    assert {(r["tier"], r["ord"]) for r in u.collect()} == {("high", 0), ("low", 2), ("low", 4)}
    assert {r["ord"] for r in tiers.tiered(m, strict=True).collect()} == {0, 4}
    s = tiers.tier_statistics(m, u).first()
    assert (s["original_count"], s["filtered_count"], s["total"], s["duplicates_removed"]) == (7, 6, 3, 3)
    assert fuzzy.statistics(m).first()["mapping_rate"] == "100.00%"


def test_fuzzy_run(spark, tmp_path):
    rooms = [{"code": "A100", "name": "two bed suite", "type": "s"}, {"code": "A200", "name": None, "description": "king room"}, {"code": "A300"}, {"name": "sea view room", "code": "A400"}]
    others = [{"code": "B100", "name": "King room"}, {"code": "B200", "name": "2 bed suite"}]
    for name, rows in (("a", rooms), ("b", others)):
        (tmp_path / f"{name}.json").write_text(json.dumps(rows))
    out = f"{tmp_path}/out"
    assert fuzzy_run.main([f"{tmp_path}/a.json", f"{tmp_path}/b.json", "--output-dir", out, "--first", "3", "--patterns"]) == 0
    got = {r["code"]: (r["target_code"], r["match_type"]) for r in spark.read.parquet(f"{out}/mappings").collect()}
    assert got == {"A100": ("B200", "exact"), "A200": ("B100", "exact"), "A300": (got["A300"][0], "none")}
    stats = json.loads(spark.read.text(f"{out}/statistics").first()["value"])
    assert (stats["mapping"]["total"], stats["mapping"]["exact"], stats["filter"]["duplicates_removed"]) == (3, 2, 0)
    assert [r["tier"] for r in spark.read.json(f"{out}/filtered").orderBy("ord").collect()] == ["high", "high", "low"]
    assert {r["token"] for r in spark.read.json(f"{out}/patterns/tokens").collect()} >= {"king", "room", "suite"}
    assert fuzzy_run.main(["--from", f"{out}/mappings", "--output-dir", f"{out}2", "--strict"]) == 0 and spark.read.json(f"{out}2/simplified").count() == 3
    assert fuzzy_run.main([f"{tmp_path}/none.json", f"{tmp_path}/b.json", "--output-dir", out]) == 1


def test_learning(spark):
    rooms = spark.createDataFrame([(0, "AB12", "t", "sea view room"), (1, "AB34", "t", "sea view rooms"), (2, "", "", "king bed")], "ord long, code string, type string, text string")
    assert {r["token"]: r["n"] for r in learn.token_counts(rooms).collect()} == {"sea": 2, "view": 2, "room": 1, "rooms": 1, "king": 1, "bed": 1}
    assert {(r["leader"], tuple(r["words"])) for r in learn.word_clusters(rooms, similarity=0.75).collect()} == {("room", ("room", "rooms"))}
    assert learn.code_prefixes(rooms).collect()[0].asDict() == {"prefix": "AB", "text": "sea view room"}
    assert [tuple(r) for r in learn.type_categories(rooms).orderBy("ord").collect()] == [("t", 0, "sea view room"), ("t", 1, "sea view rooms")]


def test_embedder_failure_gives_zeros(spark):
    def broken():
        def f(texts):
            raise ValueError

        return f

    df = spark.createDataFrame([("a",), ("b",)], "text_for_embedding string")
    assert all(r["embedding"] == [0.0, 0.0] for r in embed.embed(df, broken, 2).collect())


def test_catalogs_are_read_once(spark):
    """Rooms carry the members of their hotel: no plan meets a catalog with itself."""
    for name in ("hotel_texts", "normalized_rooms", "normalized_textual_rooms", "extract_occupancy"):
        plan = hotel_queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("l_linenumber#") and sum("Relation" in line for line in plan.splitlines()) == 2, name


def test_kinds_and_emptiness_of_variants(spark):
    texts = ['{"a":1,"b":[1,{"c":2}]}', "{}", "[]", "[1]", '[{"x":1}]', "[[]]", "null", '"s"', '""', "0", "0.0", "-1", "1.5", "1e400", "false", "true", '{"_":[]}']
    rows = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", "parse_json(t) AS v").selectExpr("t", f"{src._kind('v')} AS kind", f"{src._falsy('v')} AS falsy").collect()
    kind = lambda x: type(x).__name__
    assert {r["t"]: (r["kind"], r["falsy"]) for r in rows} == {t: (kind(json.loads(t)), not json.loads(t)) if t not in ("0.0", "1e400") else ("float", t == "0.0") for t in texts}
    assert "to_json" not in src._kind("v") and src._kind("v").count("schema_of_variant") == 1
