"""WARC archives in which repeated payloads are revisit records.

Thin headers (page id and payload digest) are shuffled by digest, never the pages: each digest of a
long enough payload gets its original, the page with the largest id. Pages then meet their verdict by
page id, which spreads a payload that a third of all pages share. Records are written by Spark's text
writer, whose line separator is the blank lines that end a WARC record, so archives lie wherever Spark
can write, a failed task leaves nothing behind, and no executor touches a local file.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcensus.llm.common import materialize, shared_folder, text_or_empty

RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ROWS_READ_AT_ONCE = 256
#: The number of a page's row, in a column of this name.
ROW = "_warc_row"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: 40 hexadecimal digits as 8 groups of 20 bits, each 4 letters."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def resolve_revisits(pages: DataFrame, page_id: str = "page_id", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """page_id, digest, refers_to and first_row, once for each page id and payload.

    ``refers_to`` is null for responses, ``first_row`` the least number of the pages' rows, taken from
    the column that ``ROW`` names if there is one. Of equal payloads of at least ``min_bytes`` the row with the
    largest id is the response (a null id is smaller than any other), and so are its exact repeats.
    """
    payload = text_or_empty(F.col(html)).cast("binary")
    number = F.col(ROW) if ROW in pages.columns else F.lit(0).cast("long")
    heads = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        base32_sha1(payload).alias("digest"),
        F.octet_length(payload).cast("long").alias("n"),
        number.alias(ROW),
    )
    rows = heads.groupBy("page_id", "digest", "n").agg(F.min(ROW).alias("first_row"))
    heads = materialize(rows, "headers")
    originals = heads.where(F.col("n") >= min_bytes).groupBy("digest").agg(
        F.max("page_id").alias("original"), F.count(F.lit(1)).alias("copies")
    )
    repeated = originals.where(F.col("copies") > 1).select("digest", "original")
    revisit = F.coalesce(F.col("page_id") != F.col("original"), F.col("original").isNotNull())
    return heads.join(repeated, "digest", "left").select(
        "page_id", "digest", F.when(revisit, F.col("original")).alias("refers_to"), "first_row"
    )


def _record_id(page_id: Column, digest: Column, repeat: Column) -> Column:
    """A record id from the page id, the payload's digest and, for an exact repeat, the number of its row."""
    parts = [F.coalesce(part.cast("string"), F.lit("-")) for part in (page_id, digest, repeat)]
    h = F.md5(F.concat_ws(" ", F.lit("page"), *parts))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def warc_records(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0,
    date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """A column ``record``: the text of one WARC record for each page, without the closing blank lines.

    Records of one page id with several payloads, or of pages without an id, have ids of their own, and
    a revisit refers to the one record of its original. Rows are numbered to tell exact repeats apart,
    of which the first has the id that revisits refer to; for that the pages must come in the same
    order in two reads, as files give.
    """
    pages = pages.withColumn(ROW, F.monotonically_increasing_id())
    verdicts = resolve_revisits(pages, page_id, html, min_bytes)
    verdicts = verdicts.select(F.col("page_id").alias("of"), F.col("digest").alias("of_digest"), "refers_to", "first_row")
    body = text_or_empty(F.col(html))
    # control characters would break a header line
    target = F.regexp_replace(text_or_empty(F.col(url)), r"[\x00-\x20\x7f]", "%20")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        target.alias("url"),
        body.alias("body"),
        base32_sha1(body.cast("binary")).alias("digest"),
        ROW,
    )
    joined = rows.join(
        verdicts, F.col("page_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("of_digest")), "left"
    )
    revisit = F.col("refers_to").isNotNull()
    first = F.lit(None).cast("long")
    repeat = F.when(F.col(ROW) != F.col("first_row"), F.col(ROW))
    block = F.concat(F.lit(HTTP_HEAD), F.when(revisit, F.lit("")).otherwise(F.col("body")))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def known(name: str, value: Column) -> Column:
        return F.coalesce(line(name, value), F.lit(""))

    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"), repeat)),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        known("X-Page-Id", F.col("page_id").cast("string")),
        line("X-Payload-Length", F.octet_length("body").cast("string")),
        known("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to"), F.col("digest"), first))),
        known("X-Refers-To-Page", F.col("refers_to").cast("string")),
        F.when(revisit, line("WARC-Profile", F.lit(REVISIT_PROFILE))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )
    return joined.select(record.alias("record"))


def write_archives(pages: DataFrame, folder: str, **options) -> None:
    """Write the archives, gzipped, one per task."""
    warc_records(pages, **options).write.option("lineSep", RECORD_END).option("compression", "gzip").text(folder)


READ_SCHEMA = (
    "archive string, record_type string, record_id string, target string, page_id long, payload_bytes long,"
    " payload_digest string, refers_to long, payload binary"
)


def _records(content: bytes) -> Iterator[tuple[dict, bytes]]:
    """Headers and block of each record; blocks are taken by their length, whatever they contain."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record where one should begin")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        start = end + 4
        at = start + int(headers["Content-Length"])
        yield headers, content[start:at]
        if content[at : at + 4] != b"\r\n\r\n":
            raise ValueError("a WARC record does not end with blank lines")
        at += 4


def read_archives(spark, folder: str) -> DataFrame:
    """The records of all archives in a folder: one row each, with its payload (null for revisits).

    The digest of a response is recomputed from the bytes read and must be the one in its header.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip

        names = [part.split()[0] for part in READ_SCHEMA.split(", ")]
        types = [pa.string()] * 4 + [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

        def table_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                rows: list[tuple] = []
                for headers, block in _records(gzip.decompress(content.as_py())):
                    response = headers["WARC-Type"] == "response"
                    payload = block.split(b"\r\n\r\n", 1)[1] if response else None
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if response and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError("a payload does not have its digest")
                    number = [int(headers[k]) if k in headers else None for k in ("X-Page-Id", "X-Refers-To-Page")]
                    rows.append(
                        (
                            path.as_py(), headers["WARC-Type"], headers["WARC-Record-ID"], headers["WARC-Target-URI"],
                            number[0], int(headers["X-Payload-Length"]), digest, number[1], payload,
                        )
                    )
                    if len(rows) == ROWS_READ_AT_ONCE:
                        yield table_of(rows)
                        rows = []
                if rows:
                    yield table_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path", "content")
    return files.mapInArrow(run, READ_SCHEMA)


def round_trip(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write archives of the pages and read them back.

    One record per row, repeated rows too. Null pages have an empty payload, which is a payload like
    any other; null ids and urls leave their headers out or empty. An empty table gives no records.
    Other columns are ignored.
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder, **options)
    return read_archives(spark, folder)
