"""WARC archives: write pages as records, read records back, reassemble segmented ones.

A page becomes a ``response`` record whose block is an HTTP message in chunked transfer framing, or a ``revisit``
record that refers to the response with the same payload. Blocks longer than ``segment_bytes`` are cut into a first
segment and ``continuation`` records. The reader groups continuations by WARC-Segment-Origin-ID, orders them by
WARC-Segment-Number, checks the numbers and WARC-Segment-Total-Length, and decodes the chunked framing.

Files go through Spark's text writer and binary reader, so any file system that Spark knows will do. A record ends in
CR LF CR LF; its last LF is the writer's line end.

Defined results: a null payload is empty; a null url gives a record without WARC-Target-URI; a null id gives a record
without the id field, read back as null; repeated rows give one response and revisits of it; an empty table gives no
files and no rows; extra columns are ignored. Damaged records come back with a ``status`` other than ``ok``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.llm import skew, store

#: Digits of conv(.., 32) and the base-32 alphabet of RFC 4648.
_HEX32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_RFC32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 4096
RECORDS_PER_FILE = 4096
_DATE = "2024-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base-32 SHA-1 of a binary column."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _HEX32, _RFC32)


def _uuid_urn(*cols: Column) -> Column:
    h = F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("~")) for c in cols]))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def plan_records(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_dedup_bytes: int = 0) -> DataFrame:
    """A row per page: row_id, url, payload, digest, record_id and, for revisits, refers_to.

    Of rows with equal payloads of at least ``min_dedup_bytes``, the one with the largest id is the response. Pages are written
    once, each with a number: rows that repeat an id are told apart by it, and it is data from then on, however later jobs
    lay out their scans.
    """
    base = pages.select(
        F.col(id_col).cast("long").alias("row_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
        F.monotonically_increasing_id().alias("n"),
    )
    base = store.cut(base, "warc-pages")
    base = base.withColumn("whole", F.sha2("payload", 256))
    if min_dedup_bytes > 0:
        base = base.withColumn("whole", F.when(F.octet_length("payload") >= min_dedup_bytes, F.col("whole")))
    groups = (
        base.where("whole is not null")
        .groupBy("whole")
        .agg(F.max(F.struct("row_id", "n")).alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("whole", F.col("first.row_id").alias("f_id"), F.col("first.n").alias("f_n"), "copies")
    )
    groups = store.cut(groups, "warc-groups")
    counts = groups.select("whole", F.col("copies").alias("n"))
    groups = groups.drop("copies")
    out = skew.spread_join(base.where("whole is not null"), groups, ["whole"], F.xxhash64("row_id", "n"), counts, "left")
    if min_dedup_bytes > 0:
        out = out.unionByName(base.where("whole is null").select("*", F.lit(None).cast("long").alias("f_id"), F.lit(None).cast("long").alias("f_n")))
    revisit = F.col("f_n").isNotNull() & (F.col("f_n") != F.col("n"))
    return out.select(
        "row_id",
        "url",
        "payload",
        sha1_base32(F.col("payload")).alias("digest"),
        _uuid_urn(F.col("whole"), F.col("row_id"), F.col("n")).alias("record_id"),
        F.when(revisit, _uuid_urn(F.col("whole"), F.col("f_id"), F.col("f_n"))).alias("refers_to"),
    )


def _head(kind: str, record_id: str, row_id, url, length: int, more: list[str]) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {_DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if row_id is not None:
        lines.append(f"X-Row-ID: {row_id}")
    lines += [*more, "Content-Type: application/http;msgtype=response", f"Content-Length: {length}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def frame_chunks(payload: bytes, chunk_bytes: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing of a payload."""
    out = []
    for i in range(0, len(payload), chunk_bytes):
        part = payload[i : i + chunk_bytes]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    out.append(b"0\r\n\r\n")
    return b"".join(out)


def decode_chunks(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if the framing is broken or cut short."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        size = body[at:end].split(b";")[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
            return None
        n, at = int(size, 16), end + 2
        if n == 0:
            return b"".join(out)  # trailers are not part of the payload
        if body[at + n : at + n + 2] != b"\r\n":
            return None
        out.append(body[at : at + n])
        at += n + 2


def record_bytes(row_id, url, payload: bytes, digest: str, record_id: str, refers_to, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    """The WARC records of one page."""
    said = [f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        said += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {refers_to}"]
        yield _head("revisit", record_id, row_id, url, 0, said) + b"\r\n\r\n"
        return
    block = _HTTP + frame_chunks(payload, chunk_bytes)
    if len(block) <= segment_bytes:
        yield _head("response", record_id, row_id, url, len(block), said) + block + b"\r\n\r\n"
        return
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    yield _head("response", record_id, row_id, url, len(parts[0]), [*said, "WARC-Segment-Number: 1"]) + parts[0] + b"\r\n\r\n"
    for k, part in enumerate(parts[1:], 2):
        more = [f"WARC-Segment-Origin-ID: {record_id}", f"WARC-Segment-Number: {k}"]
        if k == len(parts):
            more.append(f"WARC-Segment-Total-Length: {len(block)}")
        yield _head("continuation", f"{record_id[:-1]}:{k}>", None, url, len(part), more) + part + b"\r\n\r\n"


def write_archive(records: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write the rows of :func:`plan_records` as gzipped WARC files of at most RECORDS_PER_FILE records."""

    def lines(batches):
        for batch in batches:
            out, size = [], 0
            for row in zip(*[batch.column(c).to_pylist() for c in ("row_id", "url", "payload", "digest", "record_id", "refers_to")], strict=True):
                for rec in record_bytes(*row, segment_bytes, chunk_bytes):
                    out.append(rec[:-1])
                    size += len(rec)
                if size > 1 << 24:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    text = records.mapInArrow(lines, "record binary").select(F.col("record").cast("string").alias("value"))
    text.write.option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _inflate(data: bytes) -> bytes:
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data:
        d = zlib.decompressobj(31)
        out.append(d.decompress(data))
        out.append(d.flush())
        data = d.unused_data
    return b"".join(out)


def parse_records(data: bytes) -> Iterator[dict]:
    """The records of a WARC file, plain or gzipped (also by record). Stops at the first record that it can't read."""
    data, at = _inflate(data), 0
    while at < len(data):
        if data[at : at + 5] != b"WARC/":
            yield {"error": "not a record"}
            return
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            yield {"error": "truncated"}
            return
        head = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            k, _, v = line.partition(b":")
            head[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
        n = head.get("content-length", "")
        if not n.isdigit() or end + 4 + int(n) > len(data):
            yield {"error": "truncated"}
            return
        head["block"] = data[end + 4 : end + 4 + int(n)]
        yield head
        at = end + 4 + int(n)
        at += 4 if data[at : at + 4] == b"\r\n\r\n" else 0


def http_payload(block: bytes) -> tuple[bytes | None, str]:
    """The decoded payload of an HTTP message and its status."""
    end = block.find(b"\r\n\r\n")
    if end < 0:
        return None, "no http head"
    chunked = re.search(rb"(?im)^transfer-encoding:[^\r\n]*chunked", block[:end])
    body = block[end + 4 :]
    if not chunked:
        return body, "ok"
    body = decode_chunks(body)
    return body, "ok" if body is not None else "bad chunk framing"


_RECORD = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("row_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary()), ("status", pa.string()), ("origin", pa.string()), ("segment", pa.int64()), ("total", pa.int64()), ("block", pa.binary())])
_RECORD_SQL = "record_id string, record_type string, row_id long, url string, digest string, refers_to string, payload binary, status string, origin string, segment long, total long, block binary"


def _number(x: str | None) -> int | None:
    return int(x) if x is not None and re.fullmatch(r"-?\d{1,18}", x) else None


def _row(r: dict) -> dict:
    if "error" in r:
        return {"status": r["error"]}
    out = {"record_id": r.get("warc-record-id"), "record_type": r.get("warc-type"), "row_id": _number(r.get("x-row-id")), "url": r.get("warc-target-uri"), "refers_to": r.get("warc-refers-to"), "status": "ok"}
    out["digest"] = (r.get("warc-payload-digest") or "").removeprefix("sha1:") or None
    out["segment"], out["total"] = _number(r.get("warc-segment-number")), _number(r.get("warc-segment-total-length"))
    if "warc-segment-number" in r:
        return out | {"origin": r.get("warc-segment-origin-id") or out["record_id"], "block": r["block"]}
    if out["record_type"] == "response":
        out["payload"], out["status"] = http_payload(r["block"])
    return out


def join_segments(parts: list[dict]) -> tuple[bytes | None, str]:
    """The block of a record from its segments, in any order and possibly repeated, and its status."""
    by: dict[int, bytes] = {}
    for p in parts:
        if by.setdefault(p["segment"], p["block"]) != p["block"]:
            return None, "segments disagree"
    totals = {(p["segment"], p["total"]) for p in parts if p["total"] is not None}
    if len(totals) != 1:
        return None, "no total length"
    (last, total), = totals
    if sorted(by) != list(range(1, last + 1)):
        return None, "segments missing"
    block = b"".join(by[k] for k in range(1, last + 1))
    return (block, "ok") if len(block) == total else (None, "wrong total length")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """A row per logical record: record_id, record_type, row_id, url, digest (as stated), refers_to, payload, status.

    Whole records are decoded where they are read; only segments are shuffled, by their origin.
    """

    def batch(rows: list[dict]):
        return pa.RecordBatch.from_pylist(rows, schema=_RECORD)

    def parse(batches, segments: bool):
        for b in batches:
            for data in b.column("content").to_pylist():
                rows, size = [], 0
                for r in parse_records(data):
                    if ("warc-segment-number" in r) is not segments:
                        continue
                    rows.append(row := _row(r))
                    size += len(row.get("payload") or row.get("block") or b"")
                    if size > 1 << 24:
                        yield batch(rows)
                        rows, size = [], 0
                yield batch(rows)

    def reassemble(batches):
        for b in batches:
            rows = []
            for parts in b.column("parts").to_pylist():
                head = next((p for p in parts if p["segment"] == 1), parts[0])
                block, status = join_segments(parts)
                payload, status = http_payload(block) if block is not None else (None, status)
                rows.append({k: head[k] for k in ("url", "row_id", "digest")} | {"record_id": head["origin"], "record_type": "response", "payload": payload, "status": status})
            yield batch(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    # files are read once for whole records and once for segments: cheaper than keeping every payload in between
    whole = files.mapInArrow(lambda it: parse(it, False), _RECORD_SQL)
    cut = files.mapInArrow(lambda it: parse(it, True), _RECORD_SQL)
    keep = ["record_id", "record_type", "row_id", "url", "digest", "refers_to", "payload", "status"]
    segments = cut.groupBy("origin").agg(F.collect_list(F.struct("segment", "total", "block", "origin", "url", "row_id", "digest")).alias("parts")).select("parts")
    return whole.select(*keep).unionByName(segments.mapInArrow(reassemble, _RECORD_SQL).select(*keep))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Give every revisit the row, size and digest of the response that it refers to; fails if there is none.

    ``records``: a written table of record_id, record_type, row_id, refers_to, payload_bytes, payload_digest. The join's
    key is the response; one that very many records revisit is dealt over several tasks.
    """
    to = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("row_id").alias("to_row"), F.col("payload_bytes").alias("to_bytes"), F.col("payload_digest").alias("to_digest"), F.lit(True).alias("there"))
    met = skew.spread_join(records.where("refers_to is not null"), to, ["refers_to"], F.xxhash64("record_id"), how="left")
    lost = F.raise_error(F.concat(F.lit("revisit without a response: "), F.col("record_id"))).cast("long")
    met = met.select("record_id", "record_type", "row_id", F.coalesce("to_bytes", "payload_bytes").alias("payload_bytes"), F.coalesce("to_digest", "payload_digest").alias("payload_digest"), F.when(F.col("there"), F.col("to_row")).otherwise(lost).alias("refers_to"))
    alone = records.where("refers_to is null").select("record_id", "record_type", "row_id", "payload_bytes", "payload_digest", F.lit(None).cast("long").alias("refers_to"))
    return met.unionByName(alone)
