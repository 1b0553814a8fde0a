"""WARC archives with revisit records for repeated payloads.

Only headers (digest, size, page_id) are shuffled by payload digest. Of equal payloads the page with the
largest page_id becomes the response; the others become revisit records that name it. Records get fresh
headers, and Spark's text sink writes them as they are, gzip-compressed: each record ends with the blank
lines WARC asks for. Reading goes through the records by their Content-Length, takes size and digest of a
response from its payload, and joins revisit records to the responses they refer to.

Defined cases: a null html is the empty payload; a null url leaves its header out, and line breaks in a
url are dropped; a null page_id loses against any other; of repeated rows one is the response and the
others revisit it; payloads below the least size are all responses; an empty table writes no record and
gives an empty result.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.llm.common import only, same
from lakemart.session import new_table_path

LEAST_BYTES = 1000  # smaller payloads are never revisited
FILE_RECORDS = 10_000  # records a file holds at most
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
PAGE, REFERS_TO_PAGE = "X-Page-ID", "X-Refers-To-Page-ID"


def payloads(pages: DataFrame) -> DataFrame:
    """page_id, url, html, and size, SHA-1 and SHA-256 of the html in UTF-8.

    SHA-256 decides which payloads are equal; SHA-1 is what the headers state.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    return only(pages, "page_id", "url", "html").select(
        "page_id",
        "url",
        html.alias("html"),
        F.octet_length(html).cast("long").alias("bytes"),
        F.sha1(html).alias("sha1"),
        F.sha2(html, 256).alias("sha256"),
    )


def row_key() -> Column:
    """Page and payload as one key without nulls; only repeated rows share it."""
    return F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("null")), "sha256")


def originals(headers: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Key of page and payload (each pair once) and the page_id of the response, for payloads held twice or more."""
    pairs = headers.where(F.col("bytes") >= least_bytes).groupBy("page_id", "sha256").agg(F.count("*").alias("rows"))
    groups = pairs.groupBy("sha256").agg(F.max("page_id").alias("original"), F.sum("rows").alias("size"))
    return pairs.select("page_id", "sha256").join(groups.where("size > 1"), "sha256").select(row_key().alias("of_key"), "original")


def _record_id(page_id: Column, sha256: Column, number: Column) -> Column:
    """A UUID from the page, its payload and its number among equal rows."""
    text = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("null")), sha256, number.cast("string")))
    return F.regexp_replace(text, "(.{8})(.{4})(.{4})(.{4})(.{12})", "<urn:uuid:$1-$2-$3-$4-$5>")


def _line(name: str, value: Column) -> Column:
    """A header line; nothing for null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def records(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """One record per page, as text without its closing blank lines."""
    read = payloads(pages)
    found = originals(read.select("page_id", "bytes", "sha256"), least_bytes)
    # Window and join share one shuffle of the payloads.
    again = Window.partitionBy("key").orderBy("url")
    numbered = read.withColumn("key", row_key()).withColumn("number", F.row_number().over(again))
    numbered = numbered.join(found, F.col("key") == F.col("of_key"), "left")
    first = same(F.col("page_id"), F.col("original")) & (F.col("number") == 1)
    revisit = F.col("of_key").isNotNull() & ~first
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    origin = _record_id(F.col("original"), F.col("sha256"), F.lit(1))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("sha256"), F.col("number"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.regexp_replace("url", "[\\r\\n]", "")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line(PAGE, F.col("page_id").cast("string")),
        _line("WARC-Profile", F.when(revisit, PROFILE)),
        _line("WARC-Refers-To", F.when(revisit, origin)),
        _line(REFERS_TO_PAGE, F.when(revisit, F.col("original").cast("string"))),
        F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"),
        block,
    )
    return numbered.select(head.alias("value"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """The records of ``pages`` as gzip-compressed archives in the folder ``path``."""
    sink = records(pages, least_bytes).write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
    sink.option("maxRecordsPerFile", FILE_RECORDS).text(path)


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an archive."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        version, *lines = archive[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = dict(line.split(": ", 1) for line in lines)
        start = end + 4
        stop = start + int(headers["Content-Length"])
        if archive[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError("a WARC record is damaged")
        yield headers, archive[start:stop]
        at = stop + 4


HEADERS = (
    "record_id string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to_record string, refers_to long"
)


def _row(headers: dict[str, str], block: bytes) -> tuple:
    size = None
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if headers["WARC-Type"] == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        size = len(payload)
        if hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError("a payload differs from its digest")
    page, refers_to = headers.get(PAGE), headers.get(REFERS_TO_PAGE)
    return (
        headers["WARC-Record-ID"],
        None if page is None else int(page),
        headers.get("WARC-Target-URI"),
        headers["WARC-Type"],
        size,
        digest,
        headers.get("WARC-Refers-To"),
        None if refers_to is None else int(refers_to),
    )


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives; payload_bytes is null for revisit records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = [part.split()[0] for part in HEADERS.split(", ")]
        for batch in batches:
            for content in batch.column(0):
                rows = [_row(*record) for record in parse(gzip.decompress(content.as_buffer()))]
                if rows:
                    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.record_batch(columns, names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, HEADERS)


def resolve(headers: DataFrame) -> DataFrame:
    """``headers`` with the size and digest of what each revisit record refers to."""
    known = headers.where("record_type = 'response'").select(
        F.col("record_id").alias("of"), F.col("payload_bytes").alias("size"), F.col("payload_digest").alias("hash")
    )
    revisits = headers.where("record_type = 'revisit'").join(known, F.col("refers_to_record") == F.col("of"))
    resolved = revisits.withColumns({"payload_bytes": F.col("size"), "payload_digest": F.col("hash")})
    return headers.where("record_type = 'response'").unionByName(resolved.select(*headers.columns))


def round_trip(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write the archives and read them back."""
    path = new_table_path(pages.sparkSession, "archives")
    write_archives(pages, path, least_bytes)
    found = resolve(read_headers(pages.sparkSession, path))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "url")
