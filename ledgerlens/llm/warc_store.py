"""Content-addressed web archive.

``payload``  one row per different payload: its bytes, stored once, under the
             pair of SHA-1 and SHA-256 and the length, and the record that
             carries it;
``headers``  one row per page: the exact bytes of its record header, and the
             address of its payload.

An original record is header, blank line, payload, two line ends: a join of
the two tables.  Reading recomputes both digests from the stored bytes and
fails on any difference, so an address never stands for other bytes.  All of
it is DataFrame functions; payloads are grouped with a map-side pass, so
thousands of equal ones leave a task as one.

Of records with equal payloads of at least ``min_bytes``, the one with the
largest page id is the response and the others are revisits that refer to it.

Defined results: NULL html is an empty payload; a NULL url has no target line;
line ends in a url are percent-encoded; a NULL page id counts as smallest;
repeated rows of the largest id are each a response; an empty table gives an
empty archive.  Only the three named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import shared_path

#: alphabet of base32
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
#: records carry a fixed date: the input has none
WARC_DATE = "2024-01-01T00:00:00Z"


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a hex digest whose bits are a multiple of 20 (SHA-1: 160)."""
    out = []
    for g in range(8):
        v = F.conv(F.substring(digest, 5 * g + 1, 5), 16, 10).cast("int")
        for s in (15, 10, 5, 0):
            out.append(F.substring(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*out)


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


ADDRESS = ["sha1", "sha256", "payload_bytes"]


def _records(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    p = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    return (pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), p.alias("payload"))
            .select("page_id", "url", "payload", F.sha1("payload").alias("sha1"), F.sha2("payload", 256).alias("sha256"),
                    F.octet_length("payload").cast("long").alias("payload_bytes")))


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
          min_bytes: int = 0) -> str:
    """Write the archive; returns ``path``."""
    spark = pages.sparkSession
    rec = _records(pages, key, url, html)
    (rec.groupBy(*ADDRESS).agg(F.first("payload").alias("payload"), F.max("page_id").alias("response_id"),
                               F.count("*").alias("records"))
     .write.parquet(f"{path}/payload"))
    carrier = spark.read.parquet(f"{path}/payload").select(*ADDRESS, "response_id")
    h = rec.drop("payload").join(carrier, ADDRESS)
    revisit = ~F.col("page_id").eqNullSafe(F.col("response_id")) & (F.col("payload_bytes") >= min_bytes)
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    target = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), kind, F.lit(f"{CRLF}WARC-Record-ID: "), _urn(F.col("page_id")),
        F.coalesce(F.concat(F.lit(f"{CRLF}WARC-Target-URI: "), target), F.lit("")),
        F.lit(f"{CRLF}WARC-Date: {WARC_DATE}{CRLF}WARC-Payload-Digest: sha1:"), base32_of_hex(F.col("sha1")),
        F.when(revisit, F.concat(F.lit(f"{CRLF}WARC-Refers-To: "), _urn(F.col("response_id")),
                                 F.lit(f"{CRLF}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))
        .otherwise(F.lit("")),
        F.lit(f"{CRLF}Content-Type: text/html; charset=UTF-8{CRLF}Content-Length: "),
        F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string")), F.lit(CRLF))
    h.select(F.encode(header, "UTF-8").alias("header"), *ADDRESS).write.parquet(f"{path}/headers")
    return path


def _verified(payload: DataFrame) -> DataFrame:
    """Stored payloads whose bytes still have their address; others are an error."""
    ok = ((F.sha1("payload") == F.col("sha1")) & (F.sha2("payload", 256) == F.col("sha256"))
          & (F.octet_length("payload") == F.col("payload_bytes")))
    return payload.withColumn("payload", F.when(ok, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("stored payload differs from its digest "), F.col("sha1"))).cast("binary")))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """header, payload and whole original record (response form) of every page."""
    pay = _verified(spark.read.parquet(f"{path}/payload").select(*ADDRESS, "payload"))
    j = spark.read.parquet(f"{path}/headers").join(pay, ADDRESS)
    body = F.when(F.decode("header", "UTF-8").contains(f"{CRLF}WARC-Type: revisit{CRLF}"), F.lit(b"")).otherwise(F.col("payload"))
    return j.select("header", "payload", F.concat(F.col("header"), F.lit(CRLF.encode()), body, F.lit((CRLF * 2).encode())).alias("record"))


def describe(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, parsed
    from the record headers and computed from the reconstructed payloads."""
    r = records.select(F.decode("header", "UTF-8").alias("head"), F.octet_length("payload").cast("long").alias("payload_bytes"),
                       base32_of_hex(F.sha1("payload")).alias("payload_digest"))
    stated = F.regexp_extract("head", r"WARC-Payload-Digest: sha1:([A-Z2-7]{32})\r", 1)
    digest = F.when(stated == F.col("payload_digest"), F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("header and payload disagree: "), stated)))
    return r.select(F.expr("try_cast(nullif(regexp_extract(head, 'WARC-Record-ID: <urn:page:(-?[0-9]+)>', 1), '') AS bigint)")
                    .alias("page_id"), "payload_bytes", digest.alias("payload_digest"),
                    F.regexp_extract("head", r"WARC-Type: ([a-z]+)", 1).alias("record_type"),
                    F.expr("try_cast(nullif(regexp_extract(head, 'WARC-Refers-To: <urn:page:(-?[0-9]+)>', 1), '') AS bigint)")
                    .alias("refers_to"))


def archive(pages: DataFrame, path: str | None = None, **kw) -> DataFrame:
    """Write the archive of ``pages`` and describe what is read back."""
    spark = pages.sparkSession
    path = write(pages, path or shared_path(spark, "warc"), **kw)
    return describe(read_records(spark, path))
