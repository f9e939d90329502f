"""Content-addressed archive of WARC records.

Payload bytes are stored once each, under their SHA-256; the exact header bytes
of every record are stored apart, with the digest they refer to. Records are
rebuilt byte for byte by joining the two tables, and a payload whose digest
differs from the one it is stored under stops the read.

Of records with equal payloads of at least ``least_bytes`` bytes, the one with
the smallest page id is a ``response``, the others are ``revisit`` records that
name it; smaller payloads are always responses. A revisit holds the HTTP header
only; its payload is that of the response.

Defined results: a null payload is empty; a null url gives no target line, and
line breaks in urls are percent-encoded; among repeated rows of one page the one
scanned first is the response and the rest revisit that page; rows with a null
page id come after all others and are written without one; an empty table gives
an empty archive; other columns are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.scratch import stored
from wardflow.session import shared_dir

HEADERS = ("record_no long, payload_digest string, warc_header binary, http_header binary")
PAYLOADS = "payload_digest string, payload binary"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = "\r\n"
#: The archive's files: texts of a few hundred bytes to some megabytes, written once and read once.
FILES = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(EOL)), F.lit(""))


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))


def classify(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html",
             least_bytes: int = 100) -> DataFrame:
    """A row per record without its payload: ids, digest, size, type and what it refers to."""
    body = F.encode(F.coalesce(F.col(payload).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("b"))
    rows = stored(rows.select(F.monotonically_increasing_id().alias("record_no"), "page_id", "url",
                              F.sha2("b", 256).alias("payload_digest"),
                              F.octet_length("b").cast("long").alias("payload_bytes")), "warc-records")
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "record_no")
    first = (rows.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest")
             .agg(F.min(order).alias("first"), F.count("*").alias("copies")).filter("copies > 1")
             .select("payload_digest", F.col("first.page_id").alias("first_page"),
                     F.col("first.record_no").alias("first_no")))
    again = F.col("first_no").isNotNull() & (F.col("first_no") != F.col("record_no"))
    return rows.join(first, "payload_digest", "left").select(
        "record_no", "page_id", "url", "payload_digest", "payload_bytes",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first_page")).alias("refers_to"))


def record_headers(records: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """The exact header bytes of each record: the WARC lines, and the HTTP lines that open its block."""
    revisit = F.col("record_type") == "revisit"
    clean = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}"),
                    _line("Content-Length", F.col("payload_bytes").cast("string")), F.lit(EOL))
    block = F.octet_length("http") + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    head = F.concat(
        F.lit(f"WARC/1.1{EOL}"), _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))), _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("clean")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to")))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", block.cast("string")), F.lit(EOL))
    return (records.withColumns({"http": http, "clean": clean})
            .select("record_no", "payload_digest", F.encode(head, "UTF-8").alias("warc_header"),
                    F.encode("http", "UTF-8").alias("http_header")))


def _table(path: str) -> str:
    """The name by which this session's catalog knows the payloads of the archive at ``path``."""
    return f"wardflow_payloads_{hashlib.md5(path.encode()).hexdigest()}"


def write_archive(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
                  least_bytes: int = 100) -> str:
    """Write the tables ``headers`` and ``payloads`` under ``path``.

    Payloads are written in buckets of their digest, as the shuffle that finds the copies leaves them, so that a reader in
    this session (``rebuild``) shuffles headers only. Elsewhere the files are read as any Parquet.
    """
    records = classify(pages, page_id, url, payload, least_bytes)
    record_headers(records).write.mode("overwrite").options(**FILES).parquet(f"{path}/headers")
    body = F.encode(F.coalesce(F.col(payload).cast("string"), F.lit("")), "UTF-8")
    (pages.select(F.sha2(body, 256).alias("payload_digest"), body.alias("payload"))
     .groupBy("payload_digest").agg(F.first("payload").alias("payload"))
     .write.mode("overwrite").options(**FILES).option("path", f"{path}/payloads")
     .bucketBy(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), "payload_digest").saveAsTable(_table(path)))
    return path


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The stored payloads, each checked against the digest it is stored under."""
    table = _table(path)
    rows = spark.table(table) if spark.catalog.tableExists(table) else spark.read.schema(PAYLOADS).parquet(f"{path}/payloads")
    # The digest stays the column that the rows are bucketed by.
    same = F.sha2("payload", 256) == F.col("payload_digest")
    return rows.select("payload_digest", F.when(same, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload differs from its digest "), "payload_digest")).cast("binary")).alias("payload"))


def header_field(name: str) -> Column:
    """A field of ``warc_header``, null if absent."""
    found = F.regexp_extract(F.decode("warc_header", "UTF-8"), f"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def _page(field: Column) -> Column:
    return F.regexp_extract(field, "^<urn:page:(.*)>$", 1).cast("long")


def rebuild(spark: SparkSession, path: str) -> DataFrame:
    """``record_no``, the record's bytes as in a WARC file, and its full payload (that of the response for revisits)."""
    heads = spark.read.schema(HEADERS).parquet(f"{path}/headers")
    block = F.when(header_field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    end = F.lit((EOL * 2).encode())
    return heads.join(read_payloads(spark, path), "payload_digest").select(
        "record_no", F.concat("warc_header", "http_header", block, end).alias("record"), "payload")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records as rebuilt, taken apart again: type and page ids from the header in the record's bytes, size and digest of
    the payload that came back: what stands in a response's block, and what a revisit's join found."""
    text = F.decode("record", "UTF-8")
    rows = rebuild(spark, path).select("record", "payload", F.substring_index(text, EOL * 2, 1).alias("head"),
                                       F.substring_index(text, EOL * 2, 2).alias("heads"))
    rows = rows.withColumn("warc_header", F.encode(F.concat("head", F.lit(EOL * 2)), "UTF-8"))
    first = F.octet_length("heads") + len(EOL * 2)
    block = F.substring(F.col("record"), first + 1, F.octet_length("record") - first - len(EOL * 2))
    body = F.when(header_field("WARC-Type") == "revisit", F.col("payload")).otherwise(block)
    return rows.select(
        _page(header_field("WARC-Record-ID")).alias("page_id"), F.octet_length(body).cast("long").alias("payload_bytes"),
        F.sha2(body, 256).alias("payload_digest"), header_field("WARC-Type").alias("record_type"),
        _page(header_field("WARC-Refers-To")).alias("refers_to"))


def archive_roundtrip(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Archive the pages under the shared folder and read every record back."""
    spark = pages.sparkSession
    path = write_archive(pages, shared_dir(spark, "llm-warc"), least_bytes=least_bytes)
    return read_records(spark, path)
