"""JSON arrays cut in parallel, lines with gapless places, ordered documents."""

import json
import random

import pytest
from pyspark.sql import functions as F

from innkeep.operators import results
from innkeep.operators.positions import with_places
from innkeep.sources import arrays, documents, hotels, tables


@pytest.fixture
def small_blocks(spark):
    """Blocks of a few dozen bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "37", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def value(rng, depth=0):
    kind = rng.randint(0, 7 if depth < 3 else 4)
    if kind < 3:
        return "".join(rng.choices(["a", "}", "{", "]", "[", ",", '"', "\\", " ", "\n", "é", "字", "😀", '\\"', "}}"], k=rng.randint(0, 9)))
    if kind < 5:
        return rng.choice([None, True, False, rng.randint(-99, 99), 1.5])
    if kind < 7:
        return {f"k{rng.randint(0, 5)}}}": value(rng, depth + 1) for _ in range(rng.randint(0, 3))}
    return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]


@pytest.mark.parametrize("seed", range(2))
def test_arrays_against_json(spark, small_blocks, tmp_path, seed):
    rng = random.Random(seed)
    want = {}
    for k in range(3):
        items = [value(rng) for _ in range(rng.choice([0, 1, 2, 30]))]
        text = json.dumps(items, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]), separators=rng.choice([None, (",", ":")]))
        (tmp_path / f"f{k}.json").write_text(rng.choice(["", " \n"]) + text + rng.choice(["", "\n", " \r\n\t"]))
        want[f"f{k}.json"] = items
    got: dict = {k: {} for k in want}
    for r in arrays.read_array(spark, str(tmp_path)).collect():
        got[r["file"].rsplit("/", 1)[1]][r["ord"]] = json.loads(bytes(r["text"]))
    assert {k: [v[o] for o in range(len(v))] for k, v in got.items()} == want


@pytest.mark.parametrize("text,said", [('{"a": []}', "Top level"), ("[1}", "outside"), ("[1][2]", "outside"), ('[{"a": 1}]}', "brace")])
def test_what_is_no_array(spark, small_blocks, tmp_path, text, said):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(arrays.ArrayError, match=said):
        arrays.read_array(spark, str(tmp_path)).collect()


def test_records_of_large_files(spark, small_blocks, tmp_path, monkeypatch):
    """The same records, errors and places as those of files that are parsed whole."""
    items = [{"code": f"C{i}", "name": "x}y" * (i % 5)} for i in range(60)]
    (tmp_path / "good.json").write_text(json.dumps(items))
    (tmp_path / "broken.json").write_text('[{"a": 1}, {"b" 2}, 3]')
    (tmp_path / "comma.json").write_text("[1, 2, ]")
    (tmp_path / "object.json").write_text('{"a": [1]}')
    (tmp_path / "bytes.json").write_bytes(b'["\xff\xfe"]')
    read = lambda name: [(r["ord"], r["j"]) for r in hotels.read_records(spark, str(tmp_path / name)).selectExpr("ord", "to_json(rec) AS j").orderBy("ord").collect()]

    def all_of():
        out = [read("good.json")]
        for name in ("broken.json", "comma.json", "object.json", "bytes.json"):
            with pytest.raises(hotels.CatalogError) as e:
                read(name)
            out.append(str(e.value).split(":")[0])
        return out

    whole = all_of()
    monkeypatch.setattr(hotels, "SPLIT_BYTES", 1)
    cut = all_of()
    assert cut == whole and [json.loads(j) for _, j in cut[0]] == items


def test_lines_have_gapless_places(spark, small_blocks, tmp_path):
    for k, n in enumerate((30, 0, 11)):
        (tmp_path / f"f{k}.json").write_text("\n".join(["", " "] * (k == 0) + [json.dumps({"n": 100 * k + i, "x": "long " * (i % 4)}) for i in range(n)]) + "\n")
    rows = hotels.read_records(spark, str(tmp_path), lines=True).selectExpr("ord", "variant_get(rec, '$.n', 'int') AS n").orderBy("ord").collect()
    assert [r["ord"] for r in rows] == list(range(41)) and [r["n"] for r in rows] == [*range(30), *range(200, 211)]


def read_parts(spark, path):
    listed = json.loads(spark.read.text(f"{path}_parts").first()["value"])
    return json.loads("".join(open(f"{path}/{n}").read() for n in listed["parts"])), listed


def test_documents_in_parts(spark, tmp_path):
    rows = spark.range(500).select((F.col("id") * 7919 % 500).alias("ord"), F.concat(F.lit('"q\\ é'), "id").alias("name"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.array("id")).alias("list"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_document(tables.enveloped(rows, "rooms", ["ord"], model="m", most=F.max("ord")), f"{tmp_path}/many")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    doc, listed = read_parts(spark, f"{tmp_path}/many")
    want = {r["ord"]: r for r in rows.collect()}
    assert doc["metadata"] == {"model": "m", "most": 499, "total_count": 500} and listed["elements"] == 500 and len(listed["parts"]) > 1
    assert doc["rooms"] == [{"name": want[o]["name"]} | ({"list": want[o]["list"]} if want[o]["list"] else {}) for o in range(500)]
    tables.write_document(tables.enveloped(rows.where("ord < 0"), "rooms", ["ord"]), f"{tmp_path}/none")
    assert read_parts(spark, f"{tmp_path}/none")[0] == {"metadata": {"total_count": 0}, "rooms": []}
    bare = documents.document(spark.range(1).select(), 'na"me', spark.createDataFrame([(1, None), (0, "x")], "k long, v string"), [F.col("k").asc()])
    documents.write_document(bare, f"{tmp_path}/bare")
    assert read_parts(spark, f"{tmp_path}/bare")[0] == {'na"me': [{"k": 0, "v": "x"}, {"k": 1}]}


def test_output_document(spark, tmp_path):
    lists = spark.createDataFrame([(0, [(True,), (False,)]), (2, [])], "ord long, rooms array<struct<matched:boolean>>")
    mappings = results.hotel_mapping(spark.range(3).select(F.col("id").alias("ord"), F.concat(F.lit("h"), "id").alias("hotel")), lists)
    out = results.output_document(mappings)
    assert results.valid_document(out) and not results.valid_document(documents.Document(out.head, "other", out.rows))
    tables.write_document(out, f"{tmp_path}/out")
    doc, _ = read_parts(spark, f"{tmp_path}/out")
    assert doc["metadata"]["total_hotels"] == 3 and doc["metadata"]["total_rooms"] == 2
    assert [(m["hotel"], m["confidence"], len(m["rooms"])) for m in doc["mappings"]] == [("h0", 0.5, 2), ("h1", 0.0, 0), ("h2", 0.0, 0)]


@pytest.mark.parametrize("group", [[], ["g", "h"]])
def test_places(spark, group):
    rng = random.Random(len(group))
    rows = [(i, rng.choice([None, "a", "b"]), rng.choice([None, 1, 2]), rng.choice([None, 0.5, 1.5, float("nan")])) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, g string, h int, x double").withColumn("place", F.lit("old")).withColumn("n_", F.lit("extra")).repartition(5)
    got = with_places(df, [F.col("x").desc_nulls_first(), F.col("id").asc()], group).collect()
    by: dict = {}
    for r in got:
        by.setdefault(tuple(r[g] for g in group), []).append(r)
    key = lambda r: (r["x"] is not None, 0 if r["x"] is None else 1 if r["x"] != r["x"] else 2, -(r["x"] or 0) if r["x"] == r["x"] and r["x"] is not None else 0, r["id"])
    for rs in by.values():
        assert [r["place"] for r in sorted(rs, key=key)] == list(range(len(rs)))
    assert len(got) == 300 and got[0]["n_"] == "extra" and with_places(df.limit(0), [F.col("id").asc()], group).count() == 0
