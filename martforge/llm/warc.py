"""Content-addressed WARC archive.

An archive is two Parquet datasets in the shared folder: ``payloads`` keeps
every distinct payload once under its SHA-256 (copies are folded map-side; two
payloads under one digest with different SHA-1 or length stop the job), and
``records`` keeps each record's exact header bytes with the digest of its
payload.  Reading back joins the two on the digest, checks the stored bytes
against it and gives the original record: header, payload, end marks.

Of the records with equal payloads of at least ``min_bytes`` the one with the
largest page id is the response, the others are revisits that refer to it;
shorter payloads are always responses.  A null payload is empty.  Line breaks
and other control characters of a URL are percent-encoded, a null URL is
empty.  Repeated rows with the largest id are all responses; a record without
id never is one beside records with ids, and alone in its group stays a
response.  An empty table gives an empty archive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from .common import clean, read

MIN_BYTES = 1000
DATE = "2026-01-01T00:00:00Z"  # pages carry no crawl time: one fixed value for all records
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORDS, PAYLOADS = "records", "payloads"


def _record_id(page_id) -> F.Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def _uri() -> F.Column:
    url = F.coalesce(F.col("url"), F.lit(""))
    coded = F.transform(F.split(url, ""), lambda c: F.when(
        c.rlike(r"^[\x00-\x20\x7F]$"), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c))
    return F.when(url.rlike(r"[\x00-\x20\x7F]"), F.array_join(coded, "")).otherwise(url)


def write_archive(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """Write one record per page under ``path``."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = clean(pages, "page_id", "url", "html").select(
        "page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("address"),
        F.sha1(payload).alias("sha1"), F.octet_length(payload).cast("long").alias("size"))

    folded = rows.groupBy("address").agg(
        F.first("payload").alias("payload"), F.min("sha1").alias("low"), F.max("sha1").alias("high"),
        F.min("size").alias("least"), F.max("size").alias("most"))
    sound = (F.col("low") == F.col("high")) & (F.col("least") == F.col("most"))
    (folded.select("address", F.when(sound, F.col("payload")).otherwise(
        F.raise_error(F.lit("two payloads under one digest")).cast("binary")).alias("payload"))
        .write.option("compression", "zstd").parquet(f"{path}/{PAYLOADS}"))

    light = rows.drop("payload")
    owner = light.where(F.col("size") >= min_bytes).groupBy("address").agg(F.max("page_id").alias("owner"))
    known = light.join(owner, "address", "left")
    revisit = F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    line = "\r\n"
    block = F.when(revisit, F.lit(0)).otherwise(F.col("size")) + len(HTTP)
    header = F.concat(
        F.lit("WARC/1.1" + line + "WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(line + "WARC-Record-ID: "), _record_id(F.col("page_id")),
        F.lit(line + "WARC-Date: " + DATE + line + "WARC-Target-URI: "), _uri(),
        F.lit(line + "WARC-Payload-Digest: sha1:"), F.col("sha1"),
        F.when(revisit, F.concat(F.lit(line + "WARC-Refers-To: "), _record_id(F.col("owner")),
                                 F.lit(line + "WARC-Profile: " + REVISIT_PROFILE))).otherwise(F.lit("")),
        F.lit(line + "Content-Type: application/http; msgtype=response" + line + "Content-Length: "),
        block.cast("string"), F.lit(line + line + HTTP))
    (known.select("address", header.cast("binary").alias("header"))
     .write.option("compression", "zstd").parquet(f"{path}/{RECORDS}"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Original records: address, header, payload (the full one, also for
    revisits) and record (the bytes as in a WARC file)."""
    records = spark.read.schema("address string, header binary").parquet(f"{path}/{RECORDS}")
    payloads = spark.read.schema("address string, payload binary").parquet(f"{path}/{PAYLOADS}")
    whole = F.sha2(F.col("payload"), 256) == F.col("address")
    checked = payloads.select("address", F.when(whole, F.col("payload")).otherwise(
        F.raise_error(F.lit("stored payload does not match its digest")).cast("binary")).alias("payload"))
    text = F.col("header").cast("string")
    body = F.when(text.startswith("WARC/1.1\r\nWARC-Type: revisit\r\n"), F.lit(b"")).otherwise(F.col("payload"))
    # left: a record whose payload is missing stops the job instead of vanishing
    found = records.join(checked, "address", "left")
    payload = F.when(F.col("payload").isNull(), F.raise_error(F.lit("payload is missing")).cast("binary")).otherwise(F.col("payload"))
    return (found.withColumn("payload", payload)
            .withColumn("record", F.concat(F.col("header"), body, F.lit(b"\r\n\r\n"))))


def parse(records: DataFrame) -> DataFrame:
    """Fields of the records, read from their whole bytes, beside the payload's length and digest.

    A record is cut at its first blank line; its block must have the stated length and be
    followed by the end marks and nothing else.  A response's payload is taken from its
    block, a revisit's (which has none) from the archive.
    """
    mark = b"\r\n\r\n"
    head = F.substring_index(F.col("record").cast("string"), mark.decode(), 1)
    begin = F.octet_length(head) + len(mark)

    def field(name):
        return F.regexp_extract(F.concat(F.col("head"), F.lit("\r\n")), rf"\r\n{name}: ([^\r]*)\r\n", 1)

    def page(name):
        return F.nullif(F.regexp_extract(field(name), r"^<urn:page:(.*)>$", 1), F.lit("")).cast("long")

    rows = records.select("record", F.col("payload").alias("whole"), head.alias("head"), begin.alias("begin"))
    rows = rows.withColumn("size", field("Content-Length").cast("int"))
    end = F.expr("substring(record, begin + size + 1)")
    rows = rows.withColumn("block", F.when(end == F.lit(mark), F.expr("substring(record, begin + 1, size)")).otherwise(
        F.raise_error(F.lit("a record does not end where its Content-Length says")).cast("binary")))
    response = field("WARC-Type") == "response"
    payload = F.when(response, F.expr(f"substring(block, {len(HTTP) + 1})")).when(F.octet_length("block") == len(HTTP), F.col("whole"))
    rows = rows.withColumn("payload", payload)
    digest = F.sha1("payload")
    stated = F.regexp_extract(field("WARC-Payload-Digest"), "^sha1:(.*)$", 1)
    return rows.select(
        page("WARC-Record-ID").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(digest == stated, digest).otherwise(
            F.raise_error(F.lit("header digest does not match")).cast("string")).alias("payload_digest"),
        field("WARC-Type").alias("record_type"), page("WARC-Refers-To").alias("refers_to"),
        field("WARC-Target-URI").alias("target_uri"))


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "warc")
    write_archive(read(spark, sf_dir, "pages"), path)
    return parse(read_archive(spark, path)).drop("target_uri")


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
o AS (SELECT h, max(page_id) AS owner FROM p WHERE strlen(h) >= 1000 GROUP BY h)
SELECT page_id, CAST(strlen(p.h) AS BIGINT) AS payload_bytes, sha1(p.h) AS payload_digest,
       CASE WHEN owner IS NOT NULL AND page_id <> owner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM p LEFT JOIN o ON p.h = o.h
"""
