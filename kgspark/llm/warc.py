"""WARC as a content-addressed archive.

``write_archive`` stores two Parquet tables under one folder of the shared store:

* ``payloads``  -- one row per distinct payload: ``sha256`` (the address), ``payload``.
* ``headers``   -- one row per record: the exact WARC header block and HTTP header block,
  the payload's address and the record's position.

A payload is stored once, whoever repeats it. Its address is verified twice: rows are only
treated as equal if SHA-256, SHA-1 and length agree, and reading back recomputes SHA-256 of the
stored bytes and fails the job on a mismatch. ``read_records`` joins both tables and rebuilds
each record byte for byte (a revisit has no payload in its block, as the format says).

Defined cases: a null payload is empty; a null url leaves out the target header; control
characters and blanks of a url are percent-encoded; repeated rows are separate records (one of
them is the response, by (id, position)); an empty table gives an empty archive; other columns
of the input are ignored. Texts of any length pass whole. A payload that a third of all records
share costs one stored row; the choice of its response is a partial aggregate on narrow rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_path

CRLF = "\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Alphabets of base 32: Java's digits, and the one of RFC 4648.
DIGITS, RFC4648 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base-32 SHA-1: 40 hex digits are four groups of 40 bits, eight letters each."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0")
              for i in range(4)]
    return F.translate(F.concat(*groups), DIGITS, RFC4648)


@dataclass(frozen=True)
class Archive:
    """Folder of an archive; both tables are plain Parquet."""
    path: str

    def headers(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/headers")

    def payloads(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/payloads")


def _uri(url: Column) -> Column:
    out = F.replace(url, F.lit("%"), F.lit("%25"))
    for c in "\r\n\t ":
        out = F.replace(out, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return out


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_bytes: int = 0,
                  date: str = "1970-01-01T00:00:00Z") -> Archive:
    """Archive every row. Of records with equal payloads of at least ``min_bytes`` bytes the one
    with the smallest id is the response and the others revisit it."""
    spark = pages.sparkSession
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8")
        .alias("payload"))
    address = [F.sha2("payload", 256).alias("sha256"), base32_sha1(F.col("payload")).alias("sha1"),
               F.octet_length("payload").cast("bigint").alias("n_bytes")]
    # narrow rows, written once: the record number stays fixed from here on
    rows.select("id", "url", *address, F.monotonically_increasing_id().alias("record_no")) \
        .write.mode("overwrite").parquet(f"{path}/records")
    records = spark.read.parquet(f"{path}/records")
    key = ["sha256", "sha1", "n_bytes"]
    first = records.groupBy(*key).agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "record_no")).alias("first"))
    first = first.select(*key, F.col("first.id").alias("first_id"),
                         F.col("first.record_no").alias("first_no"))
    named = records.join(first, key)
    shared = (F.col("n_bytes") >= F.lit(min_bytes)) & (F.col("record_no") != F.col("first_no"))
    kind = F.when(shared, F.lit("revisit")).otherwise(F.lit("response"))
    urn = lambda i, n: F.concat(F.lit("<urn:record:"), F.coalesce(i.cast("string"), F.lit("")),
                                F.lit(":"), n.cast("string"), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    maybe = lambda name, value: F.coalesce(line(name, value), F.lit(""))
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF),
                    F.lit("Content-Type: text/html; charset=utf-8" + CRLF),
                    line("Content-Length", F.col("n_bytes").cast("string")), F.lit(CRLF))
    block = F.octet_length("http") + F.when(F.col("kind") == "response", F.col("n_bytes")).otherwise(F.lit(0))
    head = F.concat(
        F.lit("WARC/1.1" + CRLF), line("WARC-Type", F.col("kind")),
        line("WARC-Record-ID", urn(F.col("id"), F.col("record_no"))),
        line("WARC-Date", F.lit(date)), maybe("WARC-Target-URI", _uri(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(F.col("kind") == "revisit", F.concat(
            line("WARC-Profile", F.lit(REVISIT)),
            line("WARC-Refers-To", urn(F.col("first_id"), F.col("first_no"))))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", block.cast("string")), F.lit(CRLF))
    (named.withColumn("kind", kind).withColumn("http", http)
     .select("record_no", "sha256", F.col("kind"), F.encode(head, "UTF-8").alias("warc_header"),
             F.encode("http", "UTF-8").alias("http_header"))
     .write.mode("overwrite").parquet(f"{path}/headers"))
    # one row per payload, whichever record brings it: rows of one address are equal
    (rows.select(F.sha2("payload", 256).alias("sha256"), "payload")
     .groupBy("sha256").agg(F.first("payload").alias("payload"))
     .write.mode("overwrite").parquet(f"{path}/payloads"))
    return Archive(path)


def read_records(spark: SparkSession, archive: Archive) -> DataFrame:
    """Rebuild every record: ``record_no``, ``sha256``, ``record`` (its exact bytes, both trailing
    line ends included). A payload whose bytes no longer hash to their address fails the job."""
    checked = archive.payloads(spark).select(
        "sha256", F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload"))
        .otherwise(F.raise_error(F.concat(F.lit("payload does not match its address "),
                                          F.col("sha256")))).alias("payload"))
    end = F.lit((CRLF * 2).encode())
    headers = archive.headers(spark)
    whole = (headers.where("kind = 'response'").join(checked, "sha256")
             .select("record_no", "sha256",
                     F.concat("warc_header", "http_header", "payload", end).alias("record")))
    without = (headers.where("kind <> 'response'")
               .select("record_no", "sha256", F.concat("warc_header", "http_header", end).alias("record")))
    return whole.unionByName(without)


def parse_records(records: DataFrame) -> DataFrame:
    """Fields of each rebuilt record, from its bytes alone: ``id``, ``kind``, ``declared_sha1``,
    ``refers_to``, ``refers_no`` and, for records that carry it, ``payload``."""
    text = F.decode("record", "UTF-8")
    parts = F.split(text, CRLF * 2, 3)
    out = records.select("*", parts.alias("parts")).select(
        "*", F.col("parts")[0].alias("head"),
        F.expr("substring(parts[2], 1, length(parts[2]) - 4)").alias("body"))
    field = lambda name: F.regexp_extract("head", rf"(?m)^{name}: ([^\r]*)", 1)
    urn = lambda name, k: F.nullif(F.regexp_extract(
        "head", rf"(?m)^{name}: <urn:record:(-?\d*):(\d+)>", k), F.lit("")).cast("bigint")
    return out.select(
        "record_no", "sha256", field("WARC-Type").alias("kind"),
        urn("WARC-Record-ID", 1).alias("id"), urn("WARC-Record-ID", 2).alias("number"),
        F.regexp_extract("head", r"WARC-Payload-Digest: sha1:(\w+)", 1).alias("declared_sha1"),
        urn("WARC-Refers-To", 1).alias("refers_to"), urn("WARC-Refers-To", 2).alias("refers_no"),
        F.when(field("WARC-Type") == "response", F.encode("body", "UTF-8")).alias("payload"))


def archive_report(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the archive, read it back, and describe each record by its full payload."""
    spark = pages.sparkSession
    archive = write_archive(pages, shared_path(spark, "warc"), min_bytes=min_bytes)
    records = parse_records(read_records(spark, archive))
    own = records.where("kind = 'response'").select(
        "id", "number", F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"))
    target = F.when(F.col("kind") == "revisit", F.col("refers_no")).otherwise(F.col("number"))
    stats = own.select(F.col("number").alias("target"), "payload_bytes", "payload_digest")
    return (records.select("id", "kind", "refers_to", "declared_sha1", target.alias("target"))
            .join(stats, "target")
            .select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest",
                    F.col("kind").alias("record_type"), "refers_to",
                    (F.col("declared_sha1") == F.col("payload_digest")).alias("digest_verified")))
