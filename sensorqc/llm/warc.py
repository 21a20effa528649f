"""Content-addressed WARC archive: payloads once, record headers apart.

``payloads`` holds the bytes of every distinct payload once, under its SHA-256;
``headers`` holds, for every record, its exact header text (WARC fields and the
HTTP head of the block) and the payload's digest. The first record of a payload
is a ``response``, the others are ``revisit`` records that name it and have no
payload of their own. Original records are header plus payload, by a join on
the digest; every payload is hashed again when it is read, and a payload that
does not have its digest stops the read.

Cases: a null payload is an empty one; payloads below ``min_bytes`` are never
revisited; of rows that tie for the smallest id all are responses (the payload
is still stored once); a null url gives no target field, and line ends in a
url are percent-encoded; an empty table gives an empty archive; other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorqc.llm.common import checkpointed

# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

HEADERS = "payload binary, header string"
PAYLOADS = "payload binary, bytes binary"


def base32_of_hex(hexed: Column, chars: int = 40) -> Column:
    """Base32 of a hex string; five hex digits are four base32 characters."""
    parts = [F.lpad(F.conv(F.substring(hexed, i, 5), 16, 32), 4, "0") for i in range(1, chars, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def header_text(first: Column, date: str) -> Column:
    """Header of a record from page_id, url, sha1, n_bytes; ``first``: the revisited page or null."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    revisit = first.isNotNull()
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    length = F.lit(len(HTTP_HEAD)) + F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes"))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha1")))),
        F.when(revisit, F.concat(line("WARC-Refers-To", record_id(first)), line("WARC-Profile", F.lit(PROFILE))))
        .otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", length.cast("string")),
        F.lit("\r\n" + HTTP_HEAD))


def write_archive(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
                  page_id: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """Writes a record per row below ``folder`` (shared storage).

    Only (digest, id) pairs are grouped, with map-side minima, so copies by the
    million meet in one small row each; a payload's bytes are shuffled at most
    once per map task.
    """
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"),
                        F.encode(F.coalesce(F.col(f"`{payload}`"), F.lit("")), "UTF-8").alias("bytes"))
    rows = rows.withColumn("payload", F.unhex(F.sha2("bytes", 256)))
    facts = rows.select("page_id", "url", "payload", F.sha1("bytes").alias("sha1"),
                        F.octet_length("bytes").cast("long").alias("n_bytes"))
    # Checkpointed, so that the join shuffles both sides itself and Spark can split the partitions of hot payloads.
    first = checkpointed(facts.filter(F.col("n_bytes") >= min_bytes).groupBy("payload")
                         .agg(F.min("page_id").alias("first")))
    other = F.when(F.col("first") < F.coalesce(F.col("page_id"), F.lit((1 << 63) - 1)), F.col("first"))
    (facts.join(first, "payload", "left").select("payload", header_text(other, date).alias("header"))
     .write.option("compression", "zstd").parquet(f"{folder}/headers"))
    (rows.select("payload", "bytes").dropDuplicates(["payload"])
     .write.option("compression", "zstd").parquet(f"{folder}/payloads"))


def verified_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """(payload, bytes, n_bytes, sha1); fails on bytes that do not have their digest."""
    stored = spark.read.schema(PAYLOADS).parquet(f"{folder}/payloads")
    true = F.unhex(F.sha2("bytes", 256))
    return stored.select(
        F.when(true == F.col("payload"), F.col("payload"))
        .otherwise(F.raise_error(F.concat(F.lit("stored payload is damaged: "), F.hex("payload")))).alias("payload"),
        "bytes", F.octet_length("bytes").cast("long").alias("n_bytes"), F.sha1("bytes").alias("sha1"))


def _field(name: str) -> Column:
    value = F.regexp_extract("header", f"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(value != "", value)


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Header fields of every record beside its payload's bytes and measures."""
    headers = spark.read.schema(HEADERS).parquet(f"{folder}/headers")
    page = lambda name: F.regexp_extract(_field(name), "<urn:page:(.*)>", 1).try_cast("long")
    return headers.join(verified_payloads(spark, folder), "payload").select(
        page("WARC-Record-ID").alias("page_id"), _field("WARC-Type").alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"), _field("WARC-Target-URI").alias("url"),
        _field("WARC-Payload-Digest").alias("digest_field"), base32_of_hex(F.col("sha1")).alias("payload_digest"),
        "n_bytes", "header", "bytes")


def original_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record as it stands in a WARC file: (page_id, record: binary)."""
    body = F.when(F.col("record_type") == "response", F.col("bytes")).otherwise(F.lit(b""))
    return records(spark, folder).select(
        "page_id", F.concat(F.encode("header", "UTF-8"), body, F.lit(b"\r\n\r\n")).alias("record"))
