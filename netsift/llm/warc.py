"""WARC archives of pages with revisit records for repeated payloads.

Headers alone are shuffled by payload digest; the payload follows only to where its record is written. Archives are
written by Spark's text writer (record, then the two line ends that close a WARC record) and read as whole files, so
they can lie in any file system that Spark reads.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, keep, new_path, remove, text_bytes

#: Payloads of fewer bytes are always written in full.
LEAST_BYTES = 100
#: Bytes of payload in one archive, about, before compression; records of an archive at most.
ARCHIVE_BYTES, ARCHIVE_RECORDS = 64_000_000, 20_000
RECORD = "page_id long, url string, record_type string, refers_to long, header_digest string, block_digest string, block_bytes long"
EOL = "\r\n"


def headers(pages: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest; the payload is the html in UTF-8, null as empty."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select("page_id", "url", F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_digest"))


def resolve(heads: DataFrame) -> DataFrame:
    """page_id and refers_to of each page whose payload an earlier page_id has: the smallest one is the original.

    Digests are counted before the shuffle, and only those of several pages are joined back, so a payload that a third of
    all pages share is one row here.
    """
    large = heads.where(F.col("payload_bytes") >= LEAST_BYTES).select("page_id", "payload_digest")
    first = large.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    return large.join(first, "payload_digest").where("page_id is null or page_id > refers_to").select("page_id", "payload_digest", "refers_to").distinct()


def _head(*lines: Column | str) -> Column:
    return F.concat(*[F.concat(F.lit(x) if isinstance(x, str) else x, F.lit(EOL)) for x in lines], F.lit(EOL))


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def records(pages: DataFrame, revisits: DataFrame) -> DataFrame:
    """One column ``record``: the WARC record of each page but for the line ends that close it."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha2(html.cast("binary"), 256).alias("payload_digest"))
    known = revisits.select(F.col("page_id").alias("_p"), F.col("payload_digest").alias("_g"), "refers_to")
    rows = rows.join(known, F.col("page_id").eqNullSafe(F.col("_p")) & (F.col("payload_digest") == F.col("_g")), "left")
    again = F.col("refers_to").isNotNull()
    http = _head("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", F.concat(F.lit("Content-Length: "), F.octet_length("html").cast("string")))
    block = F.when(again, http).otherwise(F.concat(http, F.col("html")))
    uri = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\x00-\x20\x7f]", "%20")
    revisit = F.concat(
        F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{EOL}WARC-Refers-To: "), _record_id(F.col("refers_to")), F.lit(EOL)
    )
    head = F.concat(
        F.lit(f"WARC/1.1{EOL}WARC-Type: "), F.when(again, "revisit").otherwise("response"), F.lit(f"{EOL}WARC-Record-ID: "), _record_id(F.col("page_id")),
        F.lit(f"{EOL}WARC-Date: 2024-01-01T00:00:00Z{EOL}WARC-Target-URI: "), uri, F.lit(f"{EOL}WARC-Payload-Digest: sha256:"), F.col("payload_digest"), F.lit(EOL),
        F.when(again, revisit).otherwise(""), F.lit(f"Content-Type: application/http;msgtype=response{EOL}Content-Length: "), F.octet_length(block).cast("string"), F.lit(EOL + EOL),
    )
    return rows.select(F.concat(head, block).alias("record"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Deduplicated gzipped archives of pages under path; pages are dealt out so that each has about ARCHIVE_BYTES."""
    revisits = keep(resolve(headers(pages)), "revisits")
    n = -(-text_bytes(pages, "html") // ARCHIVE_BYTES)
    rows = records(pages, revisits)
    rows = rows.repartition(n) if n > 1 else rows
    rows.write.option("lineSep", EOL + EOL).option("compression", "gzip").option("maxRecordsPerFile", ARCHIVE_RECORDS).text(path)
    forget(revisits)


def _parse(stream) -> Iterator[tuple]:
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:60]!r}")
        fields = {}
        while line := stream.readline().rstrip(b"\r\n"):
            name, _, value = line.partition(b":")
            fields[name.lower()] = value.strip()
        length = int(fields[b"content-length"])
        block = stream.read(length)
        if len(block) != length or stream.read(4) != b"\r\n\r\n":
            raise ValueError("a WARC record ends early")
        payload = block.partition(b"\r\n\r\n")[2]
        number = lambda key: (lambda v: int(v) if v and v != b"none" else None)(fields.get(key, b"").strip(b"<>").rpartition(b":")[2])
        kind = fields[b"warc-type"].decode()
        yield (
            number(b"warc-record-id"), fields[b"warc-target-uri"].decode(), kind, number(b"warc-refers-to"), fields[b"warc-payload-digest"].decode().rpartition(":")[2],
            hashlib.sha256(payload).hexdigest() if kind == "response" else None, len(payload) if kind == "response" else None,
        )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under path, payloads reduced to digest and length. A broken record raises."""
    schema = spark.range(0).selectExpr(*[f"cast(null as {t.split()[1]}) {t.split()[0]}" for t in RECORD.split(", ")])
    arrow = pa.schema([(f, pa.int64() if t == "bigint" else pa.string()) for f, t in schema.dtypes])

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows: list[tuple] = []
                for row in _parse(gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))):
                    rows.append(row)
                    if len(rows) == 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(parsed, RECORD)


def resolved(records: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to, url, intact.

    A revisit gets length and digest from the response it refers to; intact says that the digest in its header is the one
    of that payload. Only responses that something refers to are joined.
    """
    asked = records.where("record_type = 'revisit'").select(F.col("refers_to").alias("_id")).distinct()
    original = records.where("record_type = 'response'").join(asked, F.col("page_id") == F.col("_id"), "left_semi")
    original = original.select(F.col("page_id").alias("_id"), F.col("block_digest").alias("_d"), F.col("block_bytes").alias("_b")).dropDuplicates(["_id", "_d"])
    same = (F.col("refers_to") == F.col("_id")) & (F.col("header_digest") == F.col("_d"))
    rows = records.join(original, same, "left")
    digest = F.coalesce("block_digest", "_d")
    return rows.select(
        "page_id", F.coalesce("block_bytes", "_b").alias("payload_bytes"), F.coalesce(digest, "header_digest").alias("payload_digest"), "record_type", "refers_to", "url",
        F.coalesce(digest == F.col("header_digest"), F.lit(False)).alias("intact"),
    )


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write pages (page_id, url, html; others ignored) as deduplicated archives in the shared folder, read them back and
    delete them; write_archives() writes some that stay.

    Null html is an empty payload, a null url an empty one; control characters and blanks of a url are written %20. A row
    with a null page_id is never an original if another page has its payload. Rows that repeat the smallest page_id are all
    responses. Equal payloads under 100 bytes are all responses. An empty table gives no record.
    """
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(pages, path)
    out = resolved(keep(read_archives(spark, path), "records"))
    remove(spark, path)
    return out
