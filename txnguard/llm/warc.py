"""WARC archives of pages, and a salvage reader that recovers what lies behind damage.

Writing: every row becomes one WARC/1.1 record, in DataFrame functions, and Spark's text writer puts the records into files (its line end
is the blank lines that end a record), so that archives can lie in any store and a retried task leaves no second copy. A file
holds about ``FILE_BYTES``. Of the rows with equal payloads that of the largest id is a response with an HTTP block; the others
are revisits, which hold the HTTP header and name the response. Equal payloads are found by their SHA-1 and length.

Reading: files are read whole (they are bounded), plain or as gzip members, one after another in a task. A record must
have its version line, a type, a name, a length, the blank lines after its block, and the digests it states; a member must end with its own
checksum. Where a check fails, the reader searches for the next version line or member that passes all of them, goes on there, and logs
the bytes between as a quarantined gap: file, start, end and reason. Nothing else is dropped.

Null html is an empty payload, a null URL is written as the record's own name, a null id as an empty name. Rows that repeat an id are records of
their own; if they hold the largest id of a payload all of them are responses. Only a null-id row has no id to refer to. An empty
table writes no records. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txnguard.llm.common import Scratch
from txnguard.operators.joins import lookup_join

FILE_BYTES = 32 << 20
END = "\r\n\r\n"

#: The alphabet of base 32, the profile of revisits to equal payloads.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAME = "urn:x-page:"
HEADER_BYTES = 1 << 20  # the longest header looked for
STRIP = 1 << 16  # bytes of a member unpacked at a time

_NEXT = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_HTTP_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*([0-9]{1,18})[ \t]*(?=\r\n|\Z)", re.I)


# writing


def base32(hex_digest: Column) -> Column:
    """Base 32 of a SHA-1 given in hex: four times 40 bits."""
    out = []
    for at in range(0, 40, 10):
        bits = F.conv(F.substring(hex_digest, at + 1, 10), 16, 10).cast("long")
        out += [F.substring(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(31).cast("int") + 1, F.lit(1)) for s in range(35, -1, -5)]
    return F.concat(*out)


def typed(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, size and head: the id of the response, null for a response itself. ``pages``: page_id, url, html.
    The ids that copies refer to are stored and counted: few are broadcast, so that no html is shuffled; beyond that a payload that a
    large share of the pages have is spread over lanes."""
    html = F.coalesce("html", F.lit(""))
    pages = pages.select("page_id", "url", html.alias("html"), base32(F.sha1(html.cast("binary"))).alias("digest"), F.octet_length(html).cast("long").alias("size"))
    heads = pages.groupBy("digest", "size").agg(F.max("page_id").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    heads = Scratch(pages.sparkSession, "warc").keep(heads, "heads")
    return lookup_join(pages, heads, ["digest", "size"], "left", ["page_id", "url"]) \
        .withColumn("head", F.when(F.col("page_id").eqNullSafe(F.col("head")), None).otherwise(F.col("head")))


def record(page: DataFrame) -> Column:
    """The text of one record of ``typed`` rows, without the blank lines that end it."""
    name = F.concat(F.lit(f"<{NAME}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))
    target = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20"), F.concat(F.lit(NAME), F.col("page_id").cast("string")), F.lit(NAME))
    again = F.col("head").isNotNull()
    block = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END),
                     F.when(again, F.lit("")).otherwise(F.col("html")))
    lines = [F.lit("WARC/1.1\r\nWARC-Type: "), F.when(again, F.lit("revisit")).otherwise(F.lit("response")), F.lit("\r\nWARC-Record-ID: "), name,
             F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "), target, F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
             F.when(again, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: <{NAME}"), F.col("head").cast("string"), F.lit(">"))).otherwise(F.lit("")),
             F.lit("\r\nWARC-Block-Digest: sha1:"), base32(F.sha1(F.col("block").cast("binary"))),
             F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length("block").cast("string"), F.lit(END), F.col("block")]
    return page.withColumn("block", block).select(F.concat(*lines).alias("value"))


def write(pages: DataFrame, path: str) -> None:
    """Archives of ``pages`` (page_id, url, html) below ``path``. Their mean size sets how many records a file takes."""
    size = pages.agg(F.avg(F.octet_length(F.coalesce("html", F.lit(""))) + 700).alias("size")).first()["size"]
    record(typed(pages)).write.option("lineSep", END).option("maxRecordsPerFile", max(1, int(FILE_BYTES / (size or 1)))).text(path)


# reading


class Fault(Exception):
    """Why bytes are no record."""


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _fields(header: bytes) -> dict[str, str]:
    """Named fields. A line without a name, or a name that stands twice, is the trace of a cut between two records."""
    out: dict[str, str] = {}
    last = ""
    for line in header.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if last and line[:1] in (b" ", b"\t"):
            out[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        last = name.strip().lower().decode("latin-1")
        if not colon or last in out and last != "warc-concurrent-to":
            raise Fault("header")
        out[last] = value.strip().decode("utf-8", "replace")
    return out


def _length(value: str | None) -> int:
    if value is None or not re.fullmatch("[0-9]{1,18}", value):
        raise Fault("length")
    return int(value)


def _record(data: bytes, at: int) -> tuple[dict, int]:
    """The record at ``at`` and the place after it, if it passes every check."""
    version = _VERSION.match(data, at)
    if not version:
        raise Fault("version")
    top = data.find(b"\r\n\r\n", version.end(), version.end() + HEADER_BYTES)
    if top < 0:
        raise Fault("header")
    fields = _fields(data[version.end():top])
    if not (fields.get("warc-type") and fields.get("warc-record-id")):
        raise Fault("fields")
    start = top + 4
    end = start + _length(fields.get("content-length"))
    if end > len(data) or data[end:end + 4] != b"\r\n\r\n":  # before anything is hashed
        raise Fault("end")
    block = data[start:end]
    stated = fields.get("warc-block-digest", "")
    if stated.startswith("sha1:") and stated[5:] != _digest(block):
        raise Fault("block digest")
    kind, digest, size, payload = fields.get("warc-type", ""), fields.get("warc-payload-digest", "").removeprefix("sha1:"), len(block), block
    if fields.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        stated = _HTTP_LENGTH.search(head)
        size = len(payload) if kind == "response" else int(stated[1]) if stated else None  # of other writers' revisits it may be unknown
    if kind == "response" and digest and digest != _digest(payload):
        raise Fault("payload digest")
    return {"type": kind, "name": fields.get("warc-record-id", "").strip("<>"), "uri": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to", "").strip("<>") or None,
            "digest": digest or (_digest(payload) if kind == "response" else None), "size": size, "payload": payload if kind == "response" else None}, end + 4


def _member(data: bytes, at: int) -> tuple[list[dict], int]:
    """The records of the gzip member at ``at``, if all of it is sound."""
    unpack, parts, to = zlib.decompressobj(31), [], at
    while not unpack.eof:
        if to >= len(data):
            raise Fault("member cut off")
        try:
            parts.append(unpack.decompress(data[to:to + STRIP]))
        except zlib.error:
            raise Fault("member") from None
        to += STRIP
    text, end = b"".join(parts), min(to, len(data)) - len(unpack.unused_data)
    found, place = [], 0
    while place < len(text):
        one, place = _record(text, place)
        found.append(one)
    return found, end


def salvage(data: bytes) -> Iterator[dict]:
    """Records (with ``start`` and ``end``) and gaps (with ``reason``) of one archive, in order; together they cover it."""
    at = 0
    while at < len(data):
        try:
            found, end = _member(data, at) if data[at:at + 3] == b"\x1f\x8b\x08" else (lambda r: ([r[0]], r[1]))(_record(data, at))
            yield from ({"start": at, "end": end, "reason": None} | one for one in found)
            at = end
        except Fault as fault:
            stop = next((m.start() for m in _NEXT.finditer(data, at + 1) if _sound(data, m.start())), len(data))
            yield {"start": at, "end": stop, "reason": str(fault)}
            at = stop


def _sound(data: bytes, at: int) -> bool:
    try:
        _member(data, at) if data[at] == 0x1F else _record(data, at)
    except Fault:
        return False
    return True


_COLUMNS = [("file", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("reason", pa.string()), ("type", pa.string()), ("name", pa.string()),
            ("uri", pa.string()), ("refers_to", pa.string()), ("digest", pa.string()), ("size", pa.int64()), ("payload", pa.binary())]


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps of the archives below ``path``: file, start, end, reason (of a gap, null for a record), type, name, uri, refers_to, digest,
    size of the full payload, payload (of responses, if asked for)."""
    schema = pa.schema(_COLUMNS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"]):
                held, size = [], 0
                for found in salvage(content.as_py()):
                    found = found if payloads else found | {"payload": None}
                    held.append(found | {"file": file.as_py()})
                    size += 500 + len(found.get("payload") or b"")
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)
    kinds = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary"}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(rows, ", ".join(f"`{c}` {kinds[k]}" for c, k in _COLUMNS))


def report(pages: DataFrame) -> DataFrame:
    """What the archives of the table say, read back."""
    spark = pages.sparkSession
    path = f"{Scratch(spark, 'warc').root}/archives"
    write(pages.select("page_id", "url", "html"), path)
    kind = pages.schema["page_id"].dataType
    page = lambda c: F.nullif(F.substr(c, F.lit(len(NAME) + 1)), F.lit("")).cast(kind)
    return read(spark, path, payloads=False).where("reason IS NULL").select(
        page(F.col("name")).alias("page_id"), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
        page(F.col("refers_to")).alias("refers_to"))


_SQL_BASE32 = "||".join(f"substr('{BASE32}', (((('0x'||substr(d, {at + 1}, 10))::BIGINT >> {s}) & 31) + 1)::INTEGER, 1)" for at in range(0, 40, 10) for s in range(35, -1, -5))

REPORT_SQL = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS d FROM pages),
heads AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS head FROM payloads)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, {_SQL_BASE32} AS payload_digest,
  CASE WHEN head IS NULL OR page_id IS NOT DISTINCT FROM head THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id IS DISTINCT FROM head THEN head END AS refers_to
FROM heads"""
