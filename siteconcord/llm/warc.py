"""WARC archives whose payloads are stored once, by content.

An archive is a folder of two Parquet tables. `payloads` maps a SHA-256 digest to bytes, each payload once; `records` holds
the exact header of every record with the digest of its payload. Equal digests are verified: rows that share a digest must
agree in length and in a second, independent hash, else writing fails. Of the records with equal payloads of at least
`LEAST` bytes the one with the smallest page_id is the response and the others revisit it.

Payload bytes are not shuffled to find copies: only digests are grouped, and only the digests that occur more than once
(broadcast if they are few) decide which page's bytes are stored. Reading joins headers with payloads again.

Defined cases: null html is an empty payload; small payloads are responses each, though their bytes are stored once; rows
that share a page_id are records of their own (of equal payloads in one page_id, each is a response if that id is the
smallest); a null page_id never owns a payload if another page has it; empty tables give an empty archive; other columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siteconcord.llm.common import small
from siteconcord.session import materialized

# Fixed value of the query contract: smaller payloads are never revisits.
LEAST = 100
# Fixed text of the format: line end, version line, and the profile of a revisit of an identical payload.
CRLF = "\r\n"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Archive:
    folder: str

    @property
    def records(self) -> str:
        return f"{self.folder}/records"

    @property
    def payloads(self) -> str:
        return f"{self.folder}/payloads"


def _record_id(page_id: Column) -> Column:
    """A name-based id: 32 hexadecimal digits in the usual groups."""
    digits = F.md5(F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit(""))))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(digits, a, n) for a, n in cuts]), F.lit(">"))


def _header(date: str) -> Column:
    """The exact header block up to and with the empty line."""
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"))),
        F.lit(f"WARC-Date: {date}"),
        # A line end inside a URL would end the header line.
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest")),
        F.when(F.col("record_type") == "revisit", F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(F.col("record_type") == "revisit", F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("refers_to")))),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.when(F.col("record_type") == "revisit", 0).otherwise(F.col("payload_bytes")).cast("string")),
    ]
    return F.concat(F.array_join(F.array_compact(F.array(*lines)), CRLF), F.lit(CRLF + CRLF))


def write_archive(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> Archive:
    """Write a record per row of `pages` (page_id, url, html)."""
    archive = Archive(folder)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    held = pages.select("page_id", "url", payload.alias("payload")).select(
        "page_id", "url", "payload", F.sha2("payload", 256).alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes")
    )
    prints = held.select("page_id", "payload_digest", "payload_bytes", F.xxhash64("payload").alias("second"))
    groups = prints.groupBy("payload_digest").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min("page_id").alias("owner"),
        F.min("payload_bytes").alias("shortest"),
        F.max("payload_bytes").alias("longest"),
        F.min("second").alias("least"),
        F.max("second").alias("most"),
    )
    verified = F.assert_true(F.expr("shortest = longest AND least = most"), "Two payloads share a digest.")
    shared = groups.filter("copies > 1").select("payload_digest", "owner", verified.alias("verified")).filter("verified IS NULL")
    shared = materialized(shared.select("payload_digest", "owner", F.lit(True).alias("shared")), "shared")
    marked = held.join(small(shared), "payload_digest", "left")

    single = marked.filter("shared IS NULL").select("payload_digest", "payload")
    # Rows of one page_id may both be the owner, so these alone are made distinct.
    owners = marked.filter("shared AND page_id <=> owner").select("payload_digest", "payload").dropDuplicates(["payload_digest"])
    single.unionByName(owners).write.option("compression", "zstd").parquet(archive.payloads)

    revisit = F.expr(f"payload_bytes >= {LEAST} AND owner IS NOT NULL AND NOT page_id <=> owner")
    records = marked.select(
        "page_id",
        "url",
        "payload_bytes",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("owner")).alias("refers_to"),
    )
    records.select("page_id", "payload_digest", "refers_to", _header(date).alias("header")).write.option("compression", "zstd").parquet(archive.records)
    return archive


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """(page_id, header, payload_digest, payload, refers_to): every record with the full payload it stands for.

    A copy's payload is that of the record it revisits. The digest of the bytes read is compared with the one on record.
    """
    payloads = spark.read.parquet(archive.payloads).withColumnRenamed("payload_digest", "stored_digest")
    records = spark.read.parquet(archive.records)
    intact = F.assert_true(F.sha2("payload", 256) == F.col("stored_digest"), "A stored payload does not have its digest.")
    sound = payloads.withColumn("intact", intact).filter("intact IS NULL").drop("intact")
    return records.join(sound, F.expr("payload_digest = stored_digest")).select("page_id", "header", "payload_digest", "payload", "refers_to")


def record_bytes() -> Column:
    """The record as it stands in a WARC file: header, own payload (a revisit has none), two line ends."""
    own = F.when(F.col("header").contains("WARC-Type: revisit"), F.lit(b"")).otherwise(F.col("payload"))
    return F.concat(F.encode("header", "UTF-8"), own, F.lit(b"\r\n\r\n"))


def described(records: DataFrame) -> DataFrame:
    """What the records read back say of themselves: type from the header, length and digest from the bytes."""
    return records.select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        F.regexp_extract("header", r"\r\nWARC-Type: (\w+)\r\n", 1).alias("record_type"),
        "refers_to",
    )


def write_warc_files(records: DataFrame, folder: str) -> None:
    """Plain WARC files of the records of `read_archive`: one record after the other, UTF-8."""
    text = F.concat(F.col("header"), F.when(F.col("header").contains("WARC-Type: revisit"), "").otherwise(F.decode("payload", "UTF-8")))
    records.select(text.alias("value")).write.option("lineSep", CRLF + CRLF).text(folder)
