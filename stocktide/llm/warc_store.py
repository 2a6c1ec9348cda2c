"""Content-addressed WARC archive: payloads once, record headers apart, joins put them together.

An archive is a folder of two tables. `payloads` holds each distinct payload once under its address, the SHA-256
of its bytes, which is verified when the payload is read. `headers` holds for each record the exact
bytes of its header block, up to and with the empty line, and the address. The payload of the record
whose page has the smallest id is a `response`; other records of the same payload are `revisit`
records that refer to it. Payloads below `least_bytes` are stored once too, but all their records are responses.

Reading joins headers and payloads, so every record comes back whole, revisits with the payload
they stand for. An address shared by a third of all pages meets in a join that adaptive execution splits; the
smallest page id per address is combined before the shuffle, and payloads are shuffled only once
a map task has put equal ones together.

Defined results: a null payload is empty; a null id ranks last; of rows with equal smallest id and payload
each is a response; a null url is written as an empty target; other columns are ignored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.llm.common import bind
from stocktide.session import cut_lineage, released_tables

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF, CONTENT_TYPE = "\r\n", "text/html; charset=utf-8"
HEADERS = "page_id long, address binary, header binary"
PAYLOADS = "address binary, payload binary"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Archive:
    spark: SparkSession
    folder: str

    def headers(self) -> DataFrame:
        return self.spark.read.schema(HEADERS).parquet(f"{self.folder}/headers")

    def payloads(self) -> DataFrame:
        return self.spark.read.schema(PAYLOADS).parquet(f"{self.folder}/payloads")


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of bytes: 40 hexadecimal digits, five of them to four characters."""

    def spell(digits: Column) -> Column:
        groups = []
        for g in range(8):
            number = F.conv(F.substr(digits, F.lit(1 + 5 * g), F.lit(5)), 16, 10).cast("int")
            for shift in (15, 10, 5, 0):
                at = F.shiftright(number, shift).bitwiseAND(F.lit(31))
                groups.append(F.substr(F.lit(ALPHABET), at + 1, F.lit(1)))
        return F.concat(*groups)

    return bind(F.sha1(payload), spell)


def _record_id(archive: str, page: Column, no: Column) -> Column:
    """Unique in the world: the archive's name, the page and the number of the record in the archive."""
    page = F.coalesce(page.cast("string"), F.lit("none"))
    return F.concat(F.lit(f"<urn:page:{archive}:"), page, F.lit(":"), no.cast("string"), F.lit(">"))


def _header(kind: Column, archive: str, written: str) -> Column:
    """The exact header block of a record."""
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(archive, F.col("page_id"), F.col("no"))),
        F.lit(f"WARC-Date: {written}"),
        # A target may not break the block: line ends in it are percent-encoded.
        F.concat(F.lit("WARC-Target-URI: "), F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.lit(f"Content-Type: {CONTENT_TYPE}"),
        F.concat(F.lit("Content-Length: "), F.when(kind == "revisit", 0).otherwise(F.col("n_bytes")).cast("string")),
    ]
    revisit = F.concat(
        F.lit(f"WARC-Profile: {REVISIT_PROFILE}{CRLF}WARC-Refers-To: "),
        _record_id(archive, F.col("first_id"), F.col("first_no")), F.lit(CRLF),
    )
    block = F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF), F.when(kind == "revisit", revisit).otherwise(""), F.lit(CRLF))
    return F.encode(block, "UTF-8")


def write_archive(pages: DataFrame, folder: str, least_bytes: int = 0, written: datetime | None = None) -> Archive:
    """Write a record per row of (`page_id`, `url`, `html`), all dated `written` (default: now)."""
    date = (written or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        payload.alias("payload"),
    )
    address = F.unhex(F.sha2("payload", 256))
    name = uuid.uuid4().hex
    archive = Archive(pages.sparkSession, f"{folder.rstrip('/')}/{name}")
    distinct = rows.select(address.alias("address"), "payload").groupBy("address")
    distinct.agg(F.first("payload").alias("payload")).write.parquet(f"{archive.folder}/payloads")

    facts = rows.select(
        "page_id", "url", address.alias("address"), base32_sha1(F.col("payload")).alias("digest"),
        F.octet_length("payload").cast("long").alias("n_bytes"), F.monotonically_increasing_id().alias("no"),
    )
    with released_tables(pages.sparkSession):
        facts = cut_lineage(facts)
        # Only addresses of several records need a look at the others.
        first = F.min(F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "no")).alias("first")
        firsts = facts.where(F.col("n_bytes") >= least_bytes).groupBy("address").agg(first, F.count("*").alias("n"))
        firsts = firsts.where("n > 1 AND NOT first.unknown").select(
            "address", F.col("first.page_id").alias("first_id"), F.col("first.no").alias("first_no")
        )
        known = facts.join(cut_lineage(firsts), "address", "left")
        later = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
        kind = F.when(later, "revisit").otherwise("response")
        known.select("page_id", "address", _header(kind, name, date).alias("header")).write.parquet(f"{archive.folder}/headers")
    return archive


def read_records(archive: Archive) -> DataFrame:
    """Every record: `page_id`, its exact `header`, whole `payload`, and whether the bytes are what their address says."""
    found = archive.headers().join(archive.payloads(), "address", "left")
    verified = F.coalesce(F.unhex(F.sha2("payload", 256)) == F.col("address"), F.lit(False))
    return found.select("page_id", "header", "payload", verified.alias("verified"))


def record_bytes(header: Column, payload: Column) -> Column:
    """A record as it stands in a WARC file; a revisit has no block."""
    block = F.when(field(header, "WARC-Type") == "revisit", F.lit(b"")).otherwise(payload)
    return F.concat(header, block, F.lit((CRLF * 2).encode()))


def field(header: Column, name: str) -> Column:
    """Value of a header field, null where the record has none."""
    found = F.regexp_extract(F.decode(header, "UTF-8"), rf"\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def describe(records: DataFrame) -> DataFrame:
    """Per record what its header and payload say; fails on a payload that isn't what its address or its header says."""
    page = F.regexp_extract(field(F.col("header"), "WARC-Refers-To"), "<urn:page:[0-9a-f]+:(-?[0-9]+):", 1)
    payload = F.when(F.col("verified"), F.col("payload")).otherwise(F.raise_error(F.lit("a payload doesn't match its address")))
    digest = base32_sha1(F.col("whole"))
    said = field(F.col("header"), "WARC-Payload-Digest") == F.concat(F.lit("sha1:"), F.col("digest"))
    agreed = F.when(said, F.col("digest")).otherwise(F.raise_error(F.lit("a payload doesn't match its header's digest")))
    return records.withColumn("whole", payload).withColumn("digest", digest).select(
        "page_id", F.octet_length("whole").cast("long").alias("payload_bytes"), agreed.alias("payload_digest"),
        field(F.col("header"), "WARC-Type").alias("record_type"), F.try_to_number(page, F.lit("S9999999999999999999")).cast("long").alias("refers_to"),
    )
