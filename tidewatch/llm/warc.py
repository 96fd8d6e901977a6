"""A content-addressed archive of WARC records.

Two tables make an archive. ``payloads`` holds the bytes of every distinct
payload once, compressed, under its SHA-256 and its length; ``records`` holds
the exact header block of every record with the address of its payload.
``read`` joins both on the address, inflates and verifies each payload and
gives back whole records; a record's fields are parsed from its header block.

A response carries its payload. A revisit record has no block of its own; its
header names the response that has the same payload.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import ready, stored

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"
CRLF = "\r\n"
MIN_BYTES = 0
# Speed over ratio; the level changes no result.
LEVEL = 3


@dataclass(frozen=True)
class Archive:
    payloads: DataFrame
    records: DataFrame


def addressed(pages: DataFrame, body: bool) -> DataFrame:
    """(page_id, url, address, sha1, size[, packed]) of each page; a null html is empty."""
    names = ["address", "sha1", "size"] + ["packed"] * body
    kinds = {"address": pa.binary(), "sha1": pa.string(), "size": pa.int64(), "packed": pa.binary()}

    def digest(batches):
        for batch in batches:
            raw = batch.column(2).to_pylist()
            made = {
                "address": [hashlib.sha256(x).digest() for x in raw],
                "sha1": [base64.b32encode(hashlib.sha1(x).digest()).decode() for x in raw],
                "size": [len(x) for x in raw],
            }
            if body:
                made["packed"] = [zlib.compress(x, LEVEL) for x in raw]
            columns = [batch.column(0), batch.column(1), *[pa.array(made[n], kinds[n]) for n in names]]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", *names])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")))
    return rows.mapInArrow(digest, "page_id long, url string, address binary, sha1 string, size long" + ", packed binary" * body)


def record_id(page: Column, url: Column, sha1: Column) -> Column:
    h = F.md5(F.concat_ws("|", page.cast("string"), F.coalesce(url, F.lit("")), sha1))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def header_value(text: Column) -> Column:
    """A value that cannot end its line: control characters and % become %XX."""
    safe = F.replace(text, F.lit("%"), F.lit("%25"))
    for char, code in (("\r", "%0D"), ("\n", "%0A")):
        safe = F.replace(safe, F.lit(char), F.lit(code))
    return safe


def header_block(min_bytes: int) -> Column:
    c = F.col
    revisit = c("refers_to").isNotNull()
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), record_id(c("page_id"), c("url"), c("sha1"))),
        F.lit(f"WARC-Date: {EPOCH}"),
        F.concat(F.lit("WARC-Target-URI: "), header_value(c("url"))),  # null, and so left out, without a url
        F.concat(F.lit("WARC-Page-ID: "), c("page_id").cast("string")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), c("sha1")),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.concat(F.lit("WARC-Refers-To-Page-ID: "), c("refers_to").cast("string")),
        F.lit("Content-Type: text/html; charset=UTF-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(c("size")).cast("string")),
    ]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF))


def write(pages: DataFrame, min_bytes: int = MIN_BYTES) -> Archive:
    """Write one record per page and each distinct payload once.

    Of equal payloads of at least ``min_bytes`` the smallest page_id is the
    response. Rows that repeat a page_id with the same payload are the same
    capture and get the same record type. A page without an id is a response
    only where no equal payload has one. An empty table gives an empty archive.
    """
    ready(pages.sparkSession)
    # Rows of one payload meet as one row per task: the first aggregate runs before the shuffle.
    store = stored(
        addressed(pages, body=True)
        .groupBy("address", "size")
        .agg(F.min("page_id").alias("first_page"), F.first("sha1").alias("sha1"), F.first("packed").alias("packed")),
        "warc-payloads",
    )
    owners = store.select("address", "size", "first_page")
    later = (F.col("size") >= min_bytes) & F.col("first_page").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_page"))
    records = (
        addressed(pages, body=False)
        .join(owners, ["address", "size"])
        .withColumn("refers_to", F.when(later, F.col("first_page")))
        .select("address", "size", header_block(min_bytes).alias("header"))
    )
    return Archive(store.select("address", "size", "sha1", "packed"), stored(records, "warc-records"))


def read(archive: Archive) -> DataFrame:
    """(header, payload) of every record; a payload that fails its SHA-256 stops the job."""

    def inflate(batches):
        for batch in batches:
            headers, bodies = batch.column("header"), []
            for address, size, packed in zip(*(batch.column(n).to_pylist() for n in ("address", "size", "packed"))):
                body = zlib.decompress(packed)
                if len(body) != size or hashlib.sha256(body).digest() != address:
                    raise ValueError(f"payload {address.hex()} is damaged")
                bodies.append(body)
            yield pa.RecordBatch.from_arrays([headers, pa.array(bodies, pa.binary())], names=["header", "payload"])

    both = archive.records.join(archive.payloads.select("address", "size", "packed"), ["address", "size"])
    return both.select("header", "address", "size", "packed").mapInArrow(inflate, "header string, payload binary")


def field(name: str) -> Column:
    """A header field of a record, null where it is absent."""
    found = F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(found != "", found)


def whole(records: DataFrame) -> DataFrame:
    """The bytes of each WARC record as a file has them: header block, block, two line ends."""
    body = F.when(field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return records.select(F.concat(F.encode("header", "UTF-8"), body, F.lit((CRLF + CRLF).encode())).alias("record"))


def summary(records: DataFrame) -> DataFrame:
    """Page, payload size and digest, type and target of each record, from what was read back."""
    return records.select(
        field("WARC-Page-ID").cast("long").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        field("WARC-Refers-To-Page-ID").cast("long").alias("refers_to"),
        (field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))).alias("digest_matches"),
    )


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five hex digits make four base-32 digits."""
    h = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(h, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
