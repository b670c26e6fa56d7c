"""Content-addressed archive of web records.

Payload bytes are stored once under their SHA-256; the records' exact header blocks are stored
apart, each with the digest of its payload. Reading joins the two and verifies the bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneloom.store import new_path

#: Fixed values of the format.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 as 32 upper-case base32 digits: 5 hex digits are 4 of them."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


@dataclass(frozen=True)
class Archive:
    payloads: str
    headers: str


def write_archive(
    pages: DataFrame,
    folder: str | None = None,
    record_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    least_bytes: int = 0,
) -> Archive:
    """Write one record per row: payloads once each, headers apart.

    Of the records with equal payloads of ``least_bytes`` or more, the one with the largest id is
    the response and the others revisit it; smaller payloads are all responses. A null payload is
    empty; ids that are null come before all others; rows that repeat the response's id are
    responses too. A null url has no target line, and control characters in urls are escaped.
    """
    spark = pages.sparkSession
    folder = folder or new_path(spark, "archive")
    archive = Archive(f"{folder}/payloads", f"{folder}/headers")
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b"").cast("binary"))
    records = pages.select(F.col(record_id).alias("id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    addressed = records.withColumn("digest", F.sha2("payload", 256))

    # Copies meet map-side first; one of the equal payloads goes on.
    addressed.groupBy("digest").agg(F.max("id").alias("response_id"), F.any_value("payload").alias("payload")).select(
        "digest", base32_sha1(F.col("payload")).alias("sha1"), F.octet_length("payload").cast("bigint").alias("length"), "response_id", "payload"
    ).write.parquet(archive.payloads)

    stored = spark.read.parquet(archive.payloads).select(F.col("digest").alias("address"), "sha1", "length", "response_id")
    slim = addressed.select("id", "url", "digest").join(stored, F.col("digest") == F.col("address"))
    is_response = F.col("id").eqNullSafe(F.col("response_id")) | (F.col("length") < least_bytes)
    typed = slim.withColumn("record_type", F.when(is_response, "response").otherwise("revisit"))
    typed = typed.withColumn("refers_to", F.when(F.col("record_type") == "revisit", F.col("response_id")))
    safe_url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    urn = lambda c: F.concat(F.lit("<urn:record:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("record_type") == "revisit"
    lines = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("id"))),
        F.concat(F.lit("WARC-Date: "), F.lit(date)),
        F.concat(F.lit("WARC-Target-URI: "), safe_url),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("refers_to")))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.lit("Content-Type: text/html;charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("length")).cast("string")),
    )
    header = F.concat(lines, F.lit("\r\n\r\n"))
    typed.select("id", "digest", header.cast("binary").alias("header")).write.parquet(archive.headers)
    return archive


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every record again: id, record_type, refers_to, header, payload, payload_bytes, payload_digest.

    Type and reference are read from the header's bytes. The stored payloads are digested anew; a payload that is not what
    its address says stops the reading, and so does a header without a payload, or one whose digest or
    length is not the payload's. A revisit has the payload it refers to.
    """
    stored = spark.read.parquet(archive.payloads)
    sound = F.sha2("payload", 256) == F.col("digest")
    verified = stored.select(
        F.when(sound, F.col("digest")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest")))).alias("address"),
        "payload",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
    )
    headers = spark.read.parquet(archive.headers)
    told = lambda name: F.regexp_extract(F.col("header").cast("string"), rf"\r\n{name}: ([^\r]*)", 1)
    referred = F.regexp_extract(told("WARC-Refers-To"), "^<urn:record:(.*)>$", 1)
    joined = headers.join(verified, F.col("digest") == F.col("address"), "left").withColumn("record_type", told("WARC-Type"))
    length = F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(F.lit(0))
    states = (told("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), F.col("payload_digest"))) & (told("Content-Length") == length.cast("string"))
    found = F.when(F.col("address").isNull(), F.raise_error(F.concat(F.lit("no payload for "), F.col("digest")))).otherwise(
        F.when(states, F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("a header is not its payload's: "), F.col("digest"))))
    )
    return joined.select(
        "id", "record_type", F.when(referred != "", referred).cast(headers.schema["id"].dataType).alias("refers_to"),
        "header", "payload", "payload_bytes", found.alias("payload_digest"),
    )


def record_bytes(records: DataFrame) -> DataFrame:
    """(id, record): the records as a WARC file holds them; a revisit has an empty block."""
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b"").cast("binary"))
    return records.select("id", F.concat("header", block, F.lit(b"\r\n\r\n").cast("binary")).alias("record"))
