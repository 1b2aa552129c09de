"""What must not grow with the input: texts sent to Python, rows sorted for a count, work per pair."""

import unicodedata

from pyspark.sql import functions as F

from innkeep.functions import text
from innkeep.operators import fuzzy, learn, results
from innkeep.plans import catalog, hotel_queries
from innkeep.sources import hotels


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_are_looked_at_once_a_room(spark):
    """No pattern is matched above the step that makes pairs."""
    plan = _plan(catalog.penalty_flags(spark, "/root/testdata/sf0.001"))
    above = plan[: plan.index("MapInArrow")]
    assert "RLIKE" not in above and "bedroom\\s" not in above and "regexp_extract" not in above


def test_only_other_characters_go_to_python(spark):
    texts = ["", None, "plain\n text", "é", "aẹ́x", "́ starts", "ﬁn\nÅngström\n", "한국 \U0001d11e 漢字", "ẋ̣éy", "½ ① ™ z", "\nä\n\nö"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    want = {i: "".join(c for c in unicodedata.normalize("NFKD", t or "") if unicodedata.category(c) != "Mn") for i, t in enumerate(texts)}
    assert {r[0]: r[1] for r in df.select("i", text.normalize_unicode(F.col("t"))).collect()} == want
    long = spark.createDataFrame([("a" * 5000 + "é" + "b" * 5000,)], "t string")
    sent = []
    kept = text._strip_marks
    try:
        text._strip_marks = lambda c: sent.append(c) or kept(c)
        text.normalize_unicode(F.col("t"))
    finally:
        text._strip_marks = kept
    assert long.select(F.length(sent[0])).first()[0] == 1  # it was the whole text


def test_first_places_need_no_sort(spark):
    rooms = spark.createDataFrame([(5, "bbb aaa"), (-3, "zzz bbb bbb"), (1, "aaa zzz")], "ord long, text string")
    found = learn.top_tokens(rooms, 10)
    assert [tuple(r) for r in found.orderBy("place").collect()] == [("bbb", 3, 0), ("zzz", 2, 1), ("aaa", 2, 2)]
    assert "SortAggregate" not in _plan(learn._first_seen(rooms, "text", ()))


def test_records_are_read_once_for_their_issues(spark):
    """They were read and parsed for errors, for hotels without rooms and for warnings."""
    for q in (hotel_queries.validate_records, hotel_queries.validate_textual_records):
        plan = q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 2  # orders and lineitem


def test_texts_are_taken_apart_once(spark):
    """Tokens of rooms are worked out once a text, not once a room."""
    rooms = spark.createDataFrame([(i, "C1", "large ring", "SMALL") for i in range(20)], "ord long, code string, name string, description string")
    top, below = fuzzy._texts(rooms, False)._jdf.queryExecution().optimizedPlan().toString().split("\n", 1)
    assert top.startswith("Aggregate") and "split(" in top and "split(" not in below
    found = fuzzy.best_matches(rooms, rooms.limit(3), use_stems=False, use_fuzzy=False).collect()
    assert len(found) == 20 and {r["target_ord"] for r in found} == {0}


def test_rooms_are_read_in_one_pass(spark):
    """Paths were followed to each member of a room, also to missing ones, and whole texts of rooms were shuffled."""
    for q in (hotel_queries.normalized_rooms, hotel_queries.normalized_textual_rooms):
        plan = _plan(q(spark, "/root/testdata/sf0.001"))
        assert not any(f"$.{key}, " in plan for key in ("id", "roomCode", "code", "description", "codeDescription", "providers[0].code", "occupancies.minOccupancy", "occupancies.MinOccupancy"))
        dealt = plan[plan.index("REPARTITION_BY_NUM") :]
        assert "providers" in plan and "providers" not in dealt


def test_missing_members_are_told_from_null(spark):
    rooms = ["{}", '{"id":null,"roomCode":null,"name":null,"providers":[{"code":null}],"occupancies":{}}', '{"id":7,"roomCode":"c","description":"d","providers":[{"code":"p"}],"occupancies":{"other":1}}', '{"occupancies":{"maxAdults":"3"}}', "[1]"]
    rec = '{"_id":{"oid":"o"},"placeId":"P","hotelCode":"H","name":"N","rooms":[' + ",".join(rooms) + "]}"
    recs = spark.createDataFrame([(0, rec)], "hotel_ord long, t string").selectExpr("hotel_ord", "explode(array(parse_json(t))) AS rec")
    got = hotels.flat_rooms(hotels.validated(recs, hotels.HOTELBEDS), hotels.HOTELBEDS).orderBy("room_ord").collect()
    assert [(r["room_id"], r["room_code"], r["name"], r["provider_code"]) for r in got] == [("", "", "Unknown Room", ""), (None, None, None, None), ("7", "c", "Unknown Room", "p"), ("", "", "Unknown Room", ""), ("", "", "Unknown Room", "")]
    assert [r["has_description"] for r in got] == [False, False, True, False, False]
    assert [r["occupancies"] and tuple(r["occupancies"]) for r in got] == [None, None, (None,) * 5, (None, None, None, 3, None), None]


def test_lists_are_never_broadcast(spark):
    """Spark's estimates count a list as one member, so that the rooms of all hotels went through the driver."""
    d = "/root/testdata/sf0.001"
    for q in (hotel_queries.normalized_hotels, hotel_queries.normalized_rooms, hotel_queries.normalized_textual_rooms, hotel_queries.validate_records, hotel_queries.hotel_texts):
        assert "BroadcastHashJoin" not in _plan(q(spark, d))
    hotels_ = spark.range(5).withColumnRenamed("id", "ord")
    lists = hotels_.groupBy("ord").agg(F.collect_list(F.struct((F.col("ord") > 2).alias("matched"))).alias("rooms"))
    assert "BroadcastHashJoin" not in _plan(results.hotel_mapping(hotels_, lists))
