"""Legacy ARC archives and their conversion to WARC.

ARC files open with a version block whose second line names the version (1 or 2); each record is one header line, whose fields depend on the
version and whose last field declares the record's length, then that many bytes. The converter reads lengths, never separators, so
payloads may hold anything. It synthesises what WARC has and ARC lacks: record identifiers (a UUID from the record's own content and
address, so reruns agree), ISO timestamps, record types and payload digests.

WARC archives are written by Spark's text sink with the record terminator as its line separator, gzip-compressed, so any store
that Spark writes to will do; they are read back by declared lengths too.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm.common import cut, done_with, new_folder, table

#: Fixed values of the formats.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: The crawl date and address that pages without any get.
NO_DATE, NO_IP = "19700101000000", "0.0.0.0"
ARCHIVE_BYTES = 1 << 20
#: Bytes of payloads that a WARC file holds about.
FILE_BYTES = 1 << 26
MIN_REVISIT_BYTES = 100

RECORD = "page_id long, record_id string, date string, uri string, ip string, http string, payload binary, payload_bytes long, payload_digest string"


def _address(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "-"


def _arc_record(version: int, url: str | None, page_id: int | None, html: str | None) -> bytes:
    body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {'' if page_id is None else page_id}\r\n\r\n".encode() + (html or "").encode()
    fields = [_address(url), NO_IP, NO_DATE, "text/html"] + ["200", "-", "-", "0", "pages.arc"] * (version == 2) + [str(len(body))]
    return " ".join(fields).encode() + b"\n" + body + b"\n"


def write_arc(pages: DataFrame) -> DataFrame:
    """(archive binary): ARC files of about ARCHIVE_BYTES holding a record per page, by turns of version 1 and 2."""

    def close(version: int, records: list[bytes]) -> bytes:
        block = f"{version} 0 cardloom\n{' '.join(ARC_FIELDS[version])}\n\n".encode()
        return f"filedesc://pages.arc {NO_IP} {NO_DATE} text/plain {len(block)}\n".encode() + block + b"\n" + b"".join(records)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version, records, size = 1, [], 0
        for batch in batches:
            for page, url, html in zip(*(batch.column(k) for k in ("page_id", "url", "html")), strict=True):
                records.append(_arc_record(version, url.as_py(), page.as_py(), html.as_py()))
                size += len(records[-1])
                if size >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([close(version, records)], pa.binary())], ["archive"])
                    version, records, size = 3 - version, [], 0
        if records:
            yield pa.RecordBatch.from_arrays([pa.array([close(version, records)], pa.binary())], ["archive"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "archive binary")


def parse_arc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The header fields and the bytes of each record of an ARC file, its version block left out."""
    end = data.index(b"\n")
    length = int(data[:end].rsplit(b" ", 1)[1])
    block, at = data[end + 1 : end + 1 + length], end + 1 + length
    version = int(block.split(b" ", 1)[0])
    names = ARC_FIELDS[version]
    while at < len(data):
        if data[at : at + 1] in b"\r\n":  # records are parted by line ends that no length counts
            at += 1
            continue
        end = data.index(b"\n", at)
        values = data[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        if len(values) != len(names):
            raise ValueError(f"an ARC version {version} header line has {len(names)} fields: {values[:12]}")
        fields = dict(zip(names, values, strict=True))
        length = int(fields["Archive-length"])
        yield fields, data[end + 1 : end + 1 + length]
        at = end + 1 + length


def _iso(date: str) -> str:
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def arc_to_records(archives: DataFrame) -> DataFrame:
    """The WARC fields of every record of ARC archives (schema RECORD); all are responses so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), *((k, pa.string()) for k in ("record_id", "date", "uri", "ip", "http")), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
        for batch in batches:
            for archive in batch.column("archive"):
                rows = []
                for fields, body in parse_arc(archive.as_py()):
                    head, gap, payload = body.partition(b"\r\n\r\n")
                    digest = hashlib.sha256(payload).hexdigest()
                    page = re.search(rb"(?im)^X-Page-Id: *(-?\d+)\r?$", head)
                    name = uuid.UUID(bytes=hashlib.sha256(f"{fields['URL']} {fields['Archive-date']} {digest} ".encode() + head).digest()[:16], version=4)
                    http = (head + gap).decode("utf-8", "replace")
                    rows.append((int(page[1]) if page else None, f"<urn:uuid:{name}>", _iso(fields["Archive-date"]), fields["URL"], fields["IP-address"], http, payload, len(payload), digest))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return archives.mapInArrow(run, RECORD)


def with_revisits(records: DataFrame, least_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Adds record_type, refers_to (page_id) and refers_to_id (record): of equal payloads of least_bytes or more the smallest page_id is the response.

    Payloads meet as digests; only which record is a revisit of which is joined to the records, by their own ids, so one common payload is no task of its own.
    """
    sized = records.where(F.col("payload_bytes") >= least_bytes).select("payload_digest", "page_id", "record_id")
    has_id = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "record_id"))  # a page without an id is never referred to
    first = sized.groupBy("payload_digest").agg(F.min(has_id).alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("payload_digest", "first")
    first = cut(first, "responses")
    again = sized.join(first, "payload_digest").where("page_id > first.page_id").select(F.col("page_id").alias("of_page"), F.col("record_id").alias("of_id"), "first").distinct()
    out = records.join(again, (F.col("page_id") == F.col("of_page")) & (F.col("record_id") == F.col("of_id")), "left")
    return out.withColumns({"record_type": F.when(F.col("first").isNotNull(), "revisit").otherwise("response"), "refers_to": F.col("first.page_id"), "refers_to_id": F.col("first.record_id")}).drop("of_page", "of_id", "first")


def write_warc(records: DataFrame, path: str) -> None:
    """Writes each record of with_revisits() to gzipped WARC files under path."""
    crlf = "\r\n"
    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, F.col("http")).otherwise(F.concat("http", F.col("payload").cast("string")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(crlf))
    header = F.concat(
        F.lit(f"WARC/1.1{crlf}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.col("date")),
        line("WARC-Target-URI", F.col("uri")),
        line("WARC-IP-Address", F.col("ip")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(REVISIT_PROFILE)), line("WARC-Refers-To", F.col("refers_to_id")), line("X-Refers-To-Page-Id", F.col("refers_to").cast("string")))).otherwise(""),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
    )
    text = records.select(F.concat(header, F.lit(crlf), block).alias("value"))
    mean = records.agg(F.avg(F.col("payload_bytes") + 1024)).first()[0] or 1
    text.write.option("lineSep", crlf * 2).option("compression", "gzip").option("maxRecordsPerFile", max(1, int(FILE_BYTES / mean))).text(path)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The header fields (names in lower case) and the block of each record of a WARC file, plain or gzipped."""
    data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = int(fields["content-length"])
        yield fields, data[end + 4 : end + 4 + length]
        at = end + 4 + length + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, uri, payload) of every record under path.

    A response's digest and length are computed from the payload that was read; a revisit has those its header states.
    """
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()), ("uri", pa.string()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for fields, block in parse_warc(content.as_py()):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    page = re.search(rb"(?im)^X-Page-Id: *(-?\d+)\r?$", head)
                    full = fields["warc-type"] == "response"
                    refers = fields.get("x-refers-to-page-id")
                    rows.append((
                        int(page[1]) if page else None,
                        len(payload) if full else int(fields["x-payload-length"]),
                        hashlib.sha256(payload).hexdigest() if full else fields["warc-payload-digest"].removeprefix("sha256:"),
                        fields["warc-type"],
                        int(refers) if refers else None,
                        fields["warc-record-id"],
                        fields["warc-target-uri"],
                        payload if full else None,
                    ))
                    size += len(payload)
                    if size >= ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, uri string, payload binary")


def pages_to_warc(pages: DataFrame, path: str, least_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Puts pages(page_id, url, html) into ARC archives, converts those to WARC files under path, and reads these back.

    Null html is an empty payload, a null or empty url the address "-", blanks and control characters in a url are percent-encoded.
    Payloads under least_bytes are always responses. Rows that repeat the smallest page_id of a payload are all responses, as no id is
    smaller. A null page_id is read back as null and is never referred to if the payload has another page. A table without rows gives none. Other columns aren't read.
    A page's bytes are held whole in one task, and so is a file of about FILE_BYTES when it is read back.
    """
    records = cut(arc_to_records(write_arc(pages)), "records")  # archives are parsed once
    write_warc(with_revisits(records, least_bytes), path)
    done_with(records)
    return read_warc(pages.sparkSession, path)


def op8_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the WARC files of all pages hold when read back; edge cases as in pages_to_warc."""
    found = pages_to_warc(table(spark, sf_dir, "pages"), new_folder(spark, "warc"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP8_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
q AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p),
r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS low FROM q)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND page_id > low THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND page_id > low THEN low END AS refers_to
FROM r
"""
