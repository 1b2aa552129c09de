"""Supplier catalogs from JSON: read, validate, flatten and normalize.

Documents are read as variants, so a wrong type, a missing key and a null stay apart until they are checked. Invalid
hotels are dropped with an error; problems of rooms are warnings. Hotels and rooms carry their places in the input.
A catalog is one JSON array per file, of any size, or, with ``lines``, one hotel per line.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from innkeep.functions import occupancy, text
from innkeep.functions.columns import settled
from innkeep.sources import arrays, shared


#: Spark's limit of a variant, in bytes.
VARIANT_BYTES = 128 << 20
#: Files of arrays above this are read in parallel.
SPLIT_BYTES = 32 << 20


class CatalogError(Exception):
    """A catalog that can't be read."""


@dataclass(frozen=True)
class Provider:
    name: str
    room_code: str
    ints: dict[str, str]
    textual: bool
    required: tuple[str, ...]
    ordered: tuple[tuple[str, str], ...]


_HB_FIELDS = ("minOccupancy", "maxOccupancy", "minAdult", "maxAdults", "maxChildren")
_AD_REQUIRED = ("MinOccupancy", "MaxOccupancy", "MinAdultOccupancy", "MaxAdultOccupancy", "MinChildOccupancy", "MaxChildOccupancy", "MaxChildAge", "StandardOccupancy")
_AD_FIELDS = (*_AD_REQUIRED, "MinInfantOccupancy", "MaxInfantOccupancy", "MaxInfantAge")

HOTELBEDS = Provider("hotelbeds", "roomCode", {f: "int" for f in _HB_FIELDS}, False, _HB_FIELDS, (("minOccupancy", "maxOccupancy"), ("minAdult", "maxAdults")))
AXISDATA = Provider("axisData", "code", {f: "string" for f in _AD_FIELDS}, True, _AD_REQUIRED, (("MinOccupancy", "MaxOccupancy"), ("MinAdultOccupancy", "MaxAdultOccupancy")))


@dataclass
class Catalog:
    hotels: DataFrame  # hotel_ord, rec (variant), valid
    rooms: DataFrame  # hotel_ord, room_ord, room (variant) of valid hotels, with warnings and the members of _MEMBERS
    found: DataFrame  # these rooms before they are checked
    issues: DataFrame  # level, hotel_ord, room_ord, message
    counted: DataFrame  # issues with first: the first error of its hotel

    def stats(self) -> DataFrame:
        """One row: hotels, valid hotels, rooms, rooms without occupancy warnings, errors and warnings."""
        h = self.hotels.agg(F.count("*").alias("hotels"), F.count_if("valid").alias("valid_hotels"))
        r = self.rooms.agg(F.count("*").alias("rooms"), F.count_if("occupancy_ok").alias("rooms_with_occupancy"))
        i = self.issues.agg(F.count_if(F.col("level") == "error").alias("errors"), F.count_if(F.col("level") == "warning").alias("warnings"))
        return h.join(F.broadcast(r)).join(F.broadcast(i))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc: each file of the path as a variant; CatalogError for what is missing, a folder without files, too large or no JSON."""
    try:
        raw = spark.read.text(path, wholetext=True)
        head = raw.select(
            F.count_if(F.try_parse_json("value").isNull()).alias("bad"), F.count_if(F.octet_length("value") > VARIANT_BYTES).alias("large"), F.count_if(~F.is_valid_utf8("value")).alias("garbled"), F.count("*").alias("n")
        ).first()
    except AnalysisException as e:
        raise CatalogError(f"File not found: {path}") from e
    if not head["n"]:
        raise CatalogError(f"Not a file: {path}")
    if head["large"]:
        raise CatalogError(f"A document above {VARIANT_BYTES >> 20} MB in {path}: give one record per line (lines)")
    if head["garbled"]:
        raise CatalogError(f"Not UTF-8: {path}")
    if head["bad"]:
        raise CatalogError(f"Invalid JSON in {path}")
    return raw.select(F.parse_json("value").alias("doc"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """ord (gapless, in the order of files and lines) and rec of each line that isn't blank."""
    try:
        raw = spark.read.text(path)
    except AnalysisException as e:
        raise CatalogError(f"File not found: {path}") from e
    raw = raw.where("trim(value) <> ''").select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    raw = shared.cut(raw, "lines")  # from here on a line's place is data
    blocks = shared.cut(raw.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n")), "blocks")
    ahead = Window.partitionBy(F.lit(0)).orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("file", "block", "first", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))  # a row per block of a file
    placed = raw.join(starts, ["file", "block"]).select((F.col("at") - F.col("first") + F.col("before")).alias("ord"), "value")
    # exploded, so that conditions on a record don't parse its line again and again
    return placed.select("ord", F.explode(F.array(F.try_parse_json("value"))).alias("rec"))


def _elements(spark: SparkSession, path: str) -> DataFrame:
    """ord and rec of the elements of JSON arrays of any size."""
    try:
        each = arrays.read_array(spark, path)
    except arrays.ArrayError as e:
        raise CatalogError(str(e) if str(e).startswith("Top level") else f"Invalid JSON in {path}: {e}") from e
    text = F.col("text").cast("string")
    rows = each.select("ord", F.is_valid_utf8(text).alias("fine"), F.explode(F.array(F.try_parse_json(text))).alias("rec"))
    bad = rows.agg(F.count_if(~F.col("fine")).alias("garbled"), F.count_if(F.col("rec").isNull()).alias("bad")).first()
    if bad["garbled"]:
        raise CatalogError(f"Not UTF-8: {path}")
    if bad["bad"]:
        raise CatalogError(f"Invalid JSON in {path}")
    return rows.select("ord", "rec")


def read_records(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """ord and rec (variant) of the top-level array, or of each line. Files above SPLIT_BYTES are cut into records in parallel."""
    if lines:
        return _lines(spark, path)
    try:
        largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0  # contents aren't read
    except AnalysisException as e:
        raise CatalogError(f"File not found: {path}") from e
    if largest > SPLIT_BYTES:
        return _elements(spark, path)
    docs = read_documents(spark, path)
    if docs.where(~F.schema_of_variant("doc").like("ARRAY%")).limit(1).count():
        raise CatalogError("Top level must be a list")
    return spark.sql("SELECT CAST(pos AS BIGINT) AS ord, value AS rec FROM {docs}, LATERAL variant_explode(doc)", docs=docs)


def read_normalized(spark: SparkSession, path: str, envelope_only: bool = False) -> DataFrame:
    """ord and rec of normalized hotels: a list, {hotels: [...]}, and unless ``envelope_only`` {data: [...]} or a single hotel."""
    docs = read_documents(spark, path)
    kind = "schema_of_variant(doc) LIKE 'ARRAY%'"
    inner = "coalesce(variant_get(doc, '$.hotels', 'variant'), variant_get(doc, '$.data', 'variant'))" if not envelope_only else "variant_get(doc, '$.hotels', 'variant')"
    listed = docs.selectExpr(f"CASE WHEN {kind} THEN doc ELSE {inner} END AS list", "doc")
    if envelope_only and listed.where("list IS NULL").limit(1).count():
        raise CatalogError("Neither a list nor an object with hotels")
    many = spark.sql("SELECT CAST(pos AS BIGINT) AS ord, value AS rec FROM {x}, LATERAL variant_explode(list)", x=listed.where("list IS NOT NULL"))
    return many.unionByName(listed.where("list IS NULL").selectExpr("CAST(0 AS BIGINT) AS ord", "doc AS rec"))


def _get(v: str, key: str) -> str:
    return f"try_variant_get({v}, '$.{key}', 'variant')"


def _is_dict(v: str) -> str:
    """Whether a variant is an object; only its keys are looked at."""
    return f"try_variant_get({v}, '$', 'struct<`_`:string>') IS NOT NULL"


def _length(v: str, kind: str) -> str:
    """Members of a variant that is an array or a map; null for others. What members hold is passed over."""
    inner = "struct<`_`:string>"
    return f"cardinality(try_variant_get({v}, '$', '{'array<' if kind == 'array' else 'map<string,'}{inner}>'))"


def _kind(v: str) -> str:
    """The type's name as messages give it; null where the key is missing. Only of scalars the schema is worked out, as it takes in all members."""
    s = f"schema_of_variant({v})"
    return (
        f"CASE WHEN {v} IS NULL THEN NULL WHEN is_variant_null({v}) THEN 'NoneType' WHEN {_is_dict(v)} THEN 'dict' WHEN {_length(v, 'array')} IS NOT NULL THEN 'list' "
        f"ELSE CASE {s} WHEN 'STRING' THEN 'str' WHEN 'BOOLEAN' THEN 'bool' WHEN 'BIGINT' THEN 'int' ELSE 'float' END END"
    )


def _falsy(v: str) -> str:
    plain = f"to_json({v}) IN ('\"\"', '0', '0.0', 'false')"  # scalars only: containers are told by their size
    return f"({v} IS NULL OR is_variant_null({v}) OR coalesce({_length(v, 'array')} = 0, {_length(v, 'map')} = 0, {plain}))"


def _struct(v: str, keys: dict[str, str]) -> str:
    """Members of a variant by their names (key: type), from one pass over it; null unless it is an object."""
    return f"try_variant_get({v}, '$', 'struct<{', '.join(f'`{k}`:{t}' for k, t in keys.items())}>')"


def _kind_by(s: str) -> str:
    """:func:`_kind` of a small member, from its schema (a column)."""
    return (
        f"CASE WHEN {s} IS NULL THEN NULL WHEN {s} = 'STRING' THEN 'str' WHEN {s} = 'BIGINT' THEN 'int' WHEN {s} = 'BOOLEAN' THEN 'bool' WHEN {s} = 'VOID' THEN 'NoneType' "
        f"WHEN startswith({s}, 'OBJECT<') THEN 'dict' WHEN startswith({s}, 'ARRAY<') THEN 'list' ELSE 'float' END"
    )


def _falsy_by(v: str, s: str) -> str:
    """:func:`_falsy` of a small member, with its schema (a column)."""
    return (
        f"CASE WHEN {s} IS NULL OR {s} = 'VOID' THEN TRUE WHEN {s} = 'STRING' THEN try_variant_get({v}, '$', 'string') = '' "
        f"WHEN startswith({s}, 'OBJECT<') THEN {_length(v, 'map')} = 0 WHEN startswith({s}, 'ARRAY<') THEN {_length(v, 'array')} = 0 ELSE to_json({v}) IN ('0', '0.0', 'false') END"
    )


def _issues(conds: list[tuple[str, str]]) -> Column:
    """An array with the message of each condition that holds, else null; both are SQL."""
    items = ", ".join(f"CASE WHEN {c} THEN {m} END" for c, m in conds)
    return F.expr(f"array({items})")


def _said(c: str) -> str:
    """The messages of a settled column of :func:`_issues`. Functions over arrays don't run compiled, so it must not hold the conditions themselves."""
    return f"filter({c}, m -> m IS NOT NULL)"


def _q(s: str) -> str:
    return "'" + s.replace("'", "\\'") + "'"


def with_hotel_issues(recs: DataFrame) -> DataFrame:
    """Adds errors of the variant column rec. Members and their kinds become columns first, so that conditions stay short."""
    fields = {"placeId": ("str", "string"), "hotelCode": ("str", "string"), "name": ("str", "string"), "rooms": ("list", "list")}
    kinds = {f: "array<boolean>" if f == "rooms" else "variant" for f in fields}  # rooms aren't copied: whether they are a list is enough
    facts = recs.select("*", F.expr(_struct("rec", kinds)).alias("m_"))
    schema = {f: f"schema_of_variant(m_.{f})" for f in fields} | {"rooms": f"CASE WHEN m_.rooms IS NOT NULL THEN 'ARRAY<' ELSE schema_of_variant({_get('rec', 'rooms')}) END"}
    facts = facts.select("*", F.expr(f"CASE WHEN m_ IS NOT NULL THEN 'dict' ELSE {_kind('rec')} END").alias("k_"), *[F.expr(schema[f]).alias(f"s_{f}") for f in fields])
    facts = facts.select(*recs.columns, "k_", *[F.expr(_kind_by(f"s_{f}")).alias(f"k_{f}") for f in fields], *[F.expr(_falsy_by(f"m_.{f}", f"s_{f}")).alias(f"e_{f}") for f in fields if f != "rooms"])
    facts = settled(facts, *[c for c in facts.columns if c not in recs.columns])  # also cuts the compiled method: the JVM leaves one above 8,000 bytes to its interpreter
    conds = [("coalesce(k_, 'NoneType') <> 'dict'", "concat('Must be a dict, got ', coalesce(k_, 'NoneType'))")]
    for f in fields:
        conds.append((f"k_ = 'dict' AND k_{f} IS NULL", _q(f"Missing required field: {f}")))
        if f != "rooms":
            conds.append((f"k_ = 'dict' AND k_{f} IS NOT NULL AND e_{f}", _q(f"Empty value for required field: {f}")))
    conds += [(f"k_ = 'dict' AND k_{f} <> '{want}'", f"concat('{f} must be {name}, got ', k_{f})") for f, (want, name) in fields.items()]
    found = settled(facts.select(*recs.columns, _issues(conds).alias("errors")), "errors")
    return settled(found.withColumn("errors", F.expr(_said("errors"))), "errors")


def _room_messages(rooms: DataFrame, p: Provider) -> DataFrame:
    """Adds w1 and w2 (messages of the variant column room; of its occupancy) as :func:`_issues` gives them, and reached: occupancy was reached."""
    where = "concat('Hotel #', hotel_ord, ', Room #', room_ord, ': "
    msg = lambda s: where + s.replace("'", "\\'") + "')"
    facts = rooms.selectExpr("*", f"{_struct('room', dict.fromkeys(('id', 'name', p.room_code, 'providers', 'occupancies'), 'variant'))} AS m_")
    facts = facts.selectExpr(
        "*", "m_ IS NOT NULL AS is_dict", "m_.id IS NULL AS no_id", "schema_of_variant(m_.name) AS s_name", f"schema_of_variant(m_.{p.room_code}) AS s_code",
        "try_variant_get(m_.providers, '$[0]', 'variant') AS v_first", f"{_struct('m_.occupancies', dict.fromkeys(p.required, 'variant'))} AS o_",
    )
    facts = facts.selectExpr("*", f"{_struct('v_first', {'name': 'string', 'code': 'variant'})} AS f_", *[f"schema_of_variant(o_.{f}) AS s_{f}" for f in p.required], f"v_first IS NOT NULL OR {_length('m_.providers', 'array')} IS NOT NULL AS is_list")
    has = " OR ".join(f"s_{f} IS NOT NULL" for f in p.required)
    number = lambda f: f"CASE WHEN s_{f} = 'BIGINT' THEN try_variant_get(o_.{f}, '$', 'bigint') WHEN s_{f} IS NOT NULL THEN CASE WHEN try_variant_get(o_.{f}, '$', 'string') RLIKE '^\\\\s*[+-]?[0-9]+\\\\s*$' THEN try_cast(trim(try_variant_get(o_.{f}, '$', 'string')) AS BIGINT) END END"
    facts = facts.selectExpr(
        "*", "is_dict AND (m_.providers IS NULL OR is_list) AS listed", "is_dict AND is_list AND f_ IS NOT NULL AS reached", f"{_falsy_by('m_.name', 's_name')} AS e_name", f"{_falsy_by(f'm_.{p.room_code}', 's_code')} AS e_code",
        "schema_of_variant(f_.code) AS s_first", f"CASE WHEN {has} THEN FALSE ELSE {_falsy('m_.occupancies')} END AS e_occ", *[f"{_kind_by(f's_{f}')} AS k_{f}" for f in p.required], *[f"{number(f)} AS n_{f}" for f in p.required],
    )
    conds = [
        ("NOT is_dict", msg("Must be a dict")),
        ("is_dict AND no_id", msg("Missing id")),
        ("is_dict AND e_name", msg("Missing or empty name")),
        ("is_dict AND e_code", msg(f"Missing or empty {p.room_code}")),
        ("is_dict AND NOT listed", msg("providers must be a list")),
        ("listed AND v_first IS NULL", msg("No providers defined")),
        ("listed AND v_first IS NOT NULL AND f_ IS NULL", msg("provider must be a dict")),
        (f"reached AND coalesce(f_.name, '') <> '{p.name}'", msg(f"First provider should be '{p.name}'")),
        (f"reached AND {_falsy_by('f_.code', 's_first')}", msg("Missing provider code")),
    ]
    occ = [("reached AND e_occ", msg("Missing occupancies data")), ("reached AND NOT e_occ AND o_ IS NULL", msg("occupancies must be a dict"))]
    checked = "reached AND NOT e_occ AND o_ IS NOT NULL"
    want, kinds = ("str", "('str')") if p.textual else ("int", "('int', 'bool')")
    for f in p.required:
        occ += [
            (f"{checked} AND k_{f} IS NULL", msg(f"Missing occupancy field '{f}'")),
            (f"{checked} AND k_{f} NOT IN {kinds}", where + f"occupancy field \\'{f}\\' should be {want}, got ', k_{f})"),
            (f"{checked} AND k_{f} IN {kinds} AND n_{f} < 0", msg(f"occupancy field '{f}' cannot be negative")),
        ]
        if p.textual:
            occ.append((f"{checked} AND k_{f} = 'str' AND n_{f} IS NULL", msg(f"occupancy field '{f}' is not a valid integer")))
    for low, high in p.ordered:
        occ.append((f"{checked} AND n_{low} > n_{high}", where + f"{low} (', n_{low}, ') > {high} (', n_{high}, ')')"))
    return settled(facts.select(*rooms.columns, "reached", _issues(conds).alias("w1"), _issues(occ).alias("w2")), "reached", "w1", "w2")


def with_room_issues(rooms: DataFrame, p: Provider) -> DataFrame:
    """Adds warnings of the variant column room, and occupancy_ok: occupancy was reached and has no warning."""
    said = _room_messages(rooms, p).selectExpr(*rooms.columns, f"concat({_said('w1')}, {_said('w2')}) AS warnings", f"reached AND size({_said('w2')}) = 0 AS occupancy_ok")
    return settled(said, "warnings", "occupancy_ok")


def _found_issues(recs: DataFrame, p: Provider) -> DataFrame:
    """level, hotel_ord, room_ord, message, first of records with errors and valid, from one pass over them: a row per room, and one of each hotel without rooms or with errors."""
    named = recs.selectExpr("hotel_ord", "errors", "valid", "coalesce(try_variant_get(rec, '$.hotelCode', 'string'), 'UNKNOWN') AS code_", "CASE WHEN valid THEN try_variant_get(rec, '$.rooms', 'variant') END AS rooms_")
    each = recs.sparkSession.sql("SELECT hotel_ord, errors, valid, code_, CAST(pos AS BIGINT) AS room_ord, value AS room FROM {v}, LATERAL variant_explode_outer(rooms_)", v=named)
    none = "array(concat('Hotel #', hotel_ord, ' (', code_, '): No rooms defined'))"
    said = F.expr(f"CASE WHEN room_ord IS NOT NULL THEN concat(w1, w2) WHEN valid THEN {none} ELSE errors END")
    rows = _room_messages(each, p).select(F.expr("IF(valid, 'warning', 'error')").alias("level"), "hotel_ord", "room_ord", "valid", F.posexplode(said).alias("pos", "message"))
    return rows.where("message IS NOT NULL").select("level", "hotel_ord", "room_ord", "message", F.expr("NOT valid AND pos = 0").alias("first"))


_MEMBERS = ("coalesce(try_variant_get(rec, '$._id.oid', 'string'), '') AS hotel_id", "try_variant_get(rec, '$.placeId', 'string') AS place_id", "try_variant_get(rec, '$.hotelCode', 'string') AS hotel_code", "try_variant_get(rec, '$.name', 'string') AS hotel_name")


def validated(recs: DataFrame, provider: Provider, strict: bool = False) -> Catalog:
    """The catalog of records (hotel_ord, rec); ``strict`` raises if any hotel has an error."""
    recs = with_hotel_issues(recs).withColumn("valid", F.size("errors") == 0)
    valid = recs.where("valid")
    members = settled(valid.selectExpr("hotel_ord", "rec", *_MEMBERS), *[m.split()[-1] for m in _MEMBERS])
    names = ", ".join(m.split()[-1] for m in _MEMBERS)
    found = recs.sparkSession.sql(f"SELECT hotel_ord, {names}, CAST(pos AS BIGINT) AS room_ord, value AS room FROM {{v}}, LATERAL variant_explode(try_variant_get(rec, '$.rooms', 'variant'))", v=members)
    rooms = with_room_issues(found.select("hotel_ord", "room_ord", "room", *[m.split()[-1] for m in _MEMBERS]), provider)
    issues = _found_issues(recs, provider)
    errors = recs.select(F.explode("errors").alias("message"))
    if strict and errors.limit(1).count():
        raise CatalogError("Validation failed: " + "; ".join(r["message"] for r in errors.limit(5).collect()))
    return Catalog(recs.select("hotel_ord", "rec", "valid"), rooms, found, issues.drop("first"), issues)


def load_catalog(spark: SparkSession, path: str, provider: Provider, strict: bool = False, lines: bool = False) -> Catalog:
    """Read and validate a catalog."""
    return validated(read_records(spark, path, lines).withColumnRenamed("ord", "hotel_ord"), provider, strict)


def load_all(spark: SparkSession, hotelbeds: str, axisdata: str, strict: bool = False, lines: bool = False) -> dict[str, Catalog]:
    """Both suppliers' catalogs by name."""
    return {"hotelbeds": load_catalog(spark, hotelbeds, HOTELBEDS, strict, lines), "axisdata": load_catalog(spark, axisdata, AXISDATA, strict, lines)}


def _text(v: str, absent: str) -> str:
    """A member (variant) as a text: ``absent`` (SQL) if the key is missing, null if it is null."""
    return f"CASE WHEN {v} IS NULL THEN {absent} ELSE try_variant_get({v}, '$', 'string') END"


def _members(cat: Catalog) -> DataFrame:
    return cat.hotels.where("valid").selectExpr("hotel_ord", *_MEMBERS)


def hotel_members(cat: Catalog, p: Provider) -> DataFrame:
    """Valid hotels without their rooms."""
    named = _members(cat).withColumn("normalized_hotel_name", text.normalize_full(F.col("hotel_name"), remove_special=False))
    return named.withColumn("source", F.lit(p.name.lower()))


def flat_rooms(cat: Catalog, p: Provider, checked: bool = False) -> DataFrame:
    """A row per room of valid hotels: hotel and room members as columns; occupancies as a struct of the provider's fields.

    ``checked`` adds occupancy_ok: no warning of its occupancy.
    """
    # members come from one pass over the room; to follow a path to a missing key is slow
    members = dict.fromkeys(("id", p.room_code, "name", "description", "codeDescription"), "variant")
    members |= {"providers": "array<struct<code:variant>>", "occupancies": f"struct<{', '.join(f'`{f}`:{t}' for f, t in p.ints.items())}>"}
    facts = (cat.rooms if checked else cat.found).selectExpr("*", f"{_struct('room', members)} AS m_")
    # an object without any member is no occupancy
    has = f"m_.occupancies IS NOT NULL AND (coalesce({', '.join(f'm_.occupancies.{f}' for f in p.ints)}) IS NOT NULL OR {_length(_get('room', 'occupancies'), 'map')} > 0)"
    occ = ", ".join(f"'{f}', m_.occupancies.{f}" for f in p.ints)
    rooms = facts.selectExpr(
        "hotel_ord", "hotel_id", "place_id", "hotel_code", "hotel_name", "room_ord", f"{_text('m_.id', _q(''))} AS room_id", f"{_text(f'm_.{p.room_code}', _q(''))} AS room_code", f"{_text('m_.name', _q('Unknown Room'))} AS name",
        "m_.description IS NOT NULL AS has_description", "try_variant_get(m_.description, '$', 'string') AS description",
        f"{_text('m_.codeDescription', _q(''))} AS code_description", f"{_text('get(m_.providers, 0).code', _q(''))} AS provider_code",
        f"CASE WHEN {has} THEN named_struct({occ}) END AS occupancies", *["occupancy_ok"] * checked,
    )
    return settled(rooms, "occupancies")


def normalized_rooms(flat: DataFrame, p: Provider) -> DataFrame:
    """Rooms in the normal form, with the members of their hotel."""
    given = F.when(F.col("has_description"), F.col("description")).otherwise(F.coalesce(F.nullif("name", F.lit("")), F.lit("Unknown Room")))
    description = given if p.textual else F.col("name")
    name = F.coalesce(F.nullif("name", F.lit("")), description) if p.textual else F.col("name")
    occ = occupancy.from_axisdata(F.col("occupancies")) if p.textual else occupancy.from_hotelbeds(F.col("occupancies"))
    return flat.select(
        "hotel_ord", "room_ord", "hotel_id", "place_id", "hotel_code", "hotel_name",
        text.normalize_full(F.col("hotel_name"), remove_special=False).alias("normalized_hotel_name"), F.lit(p.name.lower()).alias("source"),
        "room_id", "room_code", name.alias("room_name"), description.alias("room_description"), "code_description", "provider_code",
        text.normalize_full(description).alias("normalized_description"),
        F.when(F.col("code_description") != "", text.normalize_full(F.col("code_description"))).alias("normalized_code_description"), occ.alias("occupancy"),
    )


_ROOM = ["room_id", "room_code", "room_name", "room_description", "code_description", "occupancy", "provider_code", "normalized_description", "normalized_code_description"]
_HOTEL = ["hotel_ord", "hotel_id", "place_id", "hotel_code", "hotel_name", "normalized_hotel_name", "source"]


def nested_hotels(rooms: DataFrame, hotels: DataFrame) -> DataFrame:
    """Hotels (of ``hotel_members``) with their normalized rooms nested in input order; hotels without rooms stay."""
    nested = rooms.groupBy("hotel_ord").agg(F.transform(F.array_sort(F.collect_list(F.struct("room_ord", F.struct(*_ROOM).alias("r")))), lambda x: x["r"]).alias("rooms"))
    # never broadcast: Spark's estimates count a list as one member
    return hotels.join(nested.hint("merge"), "hotel_ord", "left").select(*_HOTEL, F.coalesce("rooms", F.expr("CAST(array() AS array<" + rooms.select(F.struct(*_ROOM).alias("r")).schema["r"].dataType.simpleString() + ">)")).alias("rooms"))


def normalized_hotels(rooms: DataFrame, cat: Catalog, p: Provider) -> DataFrame:
    """Valid hotels of a catalog with their normalized rooms."""
    return nested_hotels(rooms, hotel_members(cat, p))


def extract_occupancy(flat: DataFrame, p: Provider) -> DataFrame:
    """hotel_code, room_code and the normalized occupancy of every room that has one."""
    occ = occupancy.from_axisdata(F.col("occupancies")) if p.textual else occupancy.from_hotelbeds(F.col("occupancies"))
    return flat.where("occupancies is not null").select("hotel_code", "room_code", occ.alias("occupancy"))
