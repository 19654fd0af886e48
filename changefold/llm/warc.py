"""WARC archives: write, read back, resolve revisits by payload digest, write deduplicated archives.

Archives are WARC/1.1 files, gzipped, written by Spark's text sink: a record ends in CR LF CR LF, the last LF being the
sink's line end. They are read back whole by Spark's binary file source and cut by Content-Length, never by searching
payloads, so any payload is safe. `RECORDS_PER_FILE` bounds a file and so what a task holds.

Only headers are shuffled by digest; the group of a hot digest is reduced before the shuffle to its first record, and the
join back is a plain equi-join that adaptive execution splits.

Defined cases: a null payload is empty; a null url is written as an empty target; a null page id sorts after all others
and a record that refers to such a page has no `refers_to`; repeated rows are records of their own, of which one is the
response. An empty table gives an archive without records. Other columns are ignored.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefold.llm.common import table
from changefold.session import work_dir

RECORDS_PER_FILE = 2000
MIN_REVISIT_BYTES = 100
RECORD_SCHEMA = (
    "record_id string, record_type string, page_id long, url string, payload_digest string, payload_bytes long,"
    " refers_to long, payload string"
)


def write_warc(records: DataFrame, path: str) -> None:
    """Write rows of (record_id, record_type, page_id, url, payload_digest, payload_bytes, refers_to, refers_to_id,
    payload) as archives below `path`; revisits are written without their payload. Headers are made afresh."""
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )

    def field(name, value):
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))

    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.col("record_type"),
        F.lit("\r\n"),
        field("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.col("record_id"), F.lit(">"))),
        field("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        field("WARC-Target-URI", F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), "[\r\n]", "%0A")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        field("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        field("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:uuid:"), F.col("refers_to_id"), F.lit(">")))),
        field("X-Page-Id", F.col("page_id").cast("string")),
        field("X-Refers-To-Page", F.col("refers_to").cast("string")),
        field("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.octet_length(body)).cast("string"),
        F.lit("\r\n\r\n"),
    )
    (
        records.select(F.concat(header, http, body, F.lit("\r\n\r")).alias("value"))
        .write.option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


def parse_warc(data: bytes):
    """(fields, block) of each record of an archive's bytes; raises ValueError where the archive is broken."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        at = start + int(fields["Content-Length"])
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"record ends badly at byte {at}")
        yield fields, data[start:at]
        at += 4


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives below `path` by RECORD_SCHEMA; payload is null for revisits or if not asked for.
    The digest of every stored payload is computed again and must equal the header's."""

    def records(batches):
        import hashlib

        import pyarrow as pa

        kinds = [pa.string()] * 2 + [pa.int64()] + [pa.string()] * 2 + [pa.int64()] * 2 + [pa.string()]
        names = [c.split()[0] for c in RECORD_SCHEMA.split(",")]

        def batch(rows):
            columns = zip(*rows) if rows else [[]] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        def number(value):
            return None if value is None else int(value)

        for files in batches:
            for content in files.column(0):
                rows, held = [], 0
                for fields, block in parse_warc(zlib.decompress(content.as_py(), 31)):
                    digest, payload = fields["WARC-Payload-Digest"].removeprefix("sha256:"), None
                    if fields["WARC-Type"] != "revisit":
                        payload = block[block.index(b"\r\n\r\n") + 4 :]
                        if hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
                        payload = payload.decode() if payloads else None
                    rows.append(
                        (
                            fields["WARC-Record-ID"][10:-1],
                            fields["WARC-Type"],
                            number(fields.get("X-Page-Id")),
                            fields["WARC-Target-URI"],
                            digest,
                            int(fields["X-Payload-Length"]),
                            number(fields.get("X-Refers-To-Page")),
                            payload,
                        )
                    )
                    held += len(block)
                    if held > 4 << 20:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(path)
    return files.select("content").mapInArrow(records, RECORD_SCHEMA)


def archive_pages(pages: DataFrame, path: str) -> None:
    """One response record for each row of (page_id, url, html)."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    write_warc(
        pages.select(
            F.expr("uuid()").alias("record_id"),
            F.lit("response").alias("record_type"),
            "page_id",
            "url",
            F.sha2(payload, 256).alias("payload_digest"),
            F.octet_length(payload).cast("long").alias("payload_bytes"),
            F.lit(None).cast("long").alias("refers_to"),
            F.lit(None).cast("string").alias("refers_to_id"),
            payload.alias("payload"),
        ),
        path,
    )


def resolve_revisits(headers: DataFrame) -> DataFrame:
    """(record_id, refers_to_id, refers_to) of the records that repeat the payload of another one of their digest.

    The record with the smallest page id is the original; payloads under MIN_REVISIT_BYTES are never revisits."""
    long_enough = headers.filter(F.col("payload_bytes") >= MIN_REVISIT_BYTES)
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "record_id")
    originals = (
        long_enough.groupBy("payload_digest")
        .agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("payload_digest", F.col("first.record_id").alias("refers_to_id"), F.col("first.page_id").alias("refers_to"))
    )
    return (
        long_enough.select("payload_digest", "record_id")
        .join(originals, "payload_digest")
        .filter("record_id != refers_to_id")
        .select("record_id", "refers_to_id", "refers_to")
    )


def deduplicate_warc(spark: SparkSession, source: str, target: str) -> None:
    """Write the records of the archives below `source` to `target`, repeated payloads as revisits."""
    revisits = resolve_revisits(read_warc(spark, source, payloads=False))
    records = read_warc(spark, source).drop("refers_to").join(revisits, "record_id", "left")
    kind = F.when(F.col("refers_to_id").isNotNull(), F.lit("revisit")).otherwise(F.lit("response"))
    write_warc(records.withColumn("record_type", kind), target)


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page, deduplicate the archives, and read the result's headers."""
    source, target = work_dir(spark, "warc"), work_dir(spark, "warc-dedup")
    archive_pages(table(spark, sf_dir, "pages"), source)
    deduplicate_warc(spark, source, target)
    return read_warc(spark, target, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP1_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM f
"""
