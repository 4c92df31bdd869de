"""Content-addressed WARC archive: payload bytes once by SHA-256, exact record headers apart, records by a join."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rrnlake.llm.common import shared_path

# Fixed values of the WARC 1.1 format.
LINE_END = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class ArchiveRules:
    """Payloads of fewer than min_revisit_bytes are never revisited; date is the WARC-Date of all records."""

    min_revisit_bytes: int = 100
    date: str = "2024-01-01T00:00:00Z"
    id_prefix: str = "urn:page:"


def _record_id(page_id: Column, rules: ArchiveRules) -> Column:
    return F.concat(F.lit(f"<{rules.id_prefix}"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def _header(rules: ArchiveRules) -> Column:
    """The header block up to and with its empty line. Line breaks in a URL are percent-encoded."""
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = F.col("record_type") == "revisit"
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), "record_type"),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"), rules)),
        F.lit(f"WARC-Date: {rules.date}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), "digest"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("first_id"), rules))),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).cast("string")),
    ]
    return F.concat(F.concat_ws(LINE_END, *lines), F.lit(LINE_END * 2)).cast("binary")


def write_archive(pages: DataFrame, path: str, rules: ArchiveRules = ArchiveRules()) -> None:
    """Write `path`/records (digest, header) and `path`/payloads (digest, payload).

    pages has page_id, url and html; other columns are ignored. The payload is the html in UTF-8, null being empty. The
    record with the smallest page_id of a payload is a response, rows that repeat this id too; null ids count as largest.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")}
    )
    first = rows.groupBy("digest").agg(F.min("page_id").alias("first_id"))
    is_first = F.col("page_id").eqNullSafe(F.col("first_id"))
    kind = F.when(is_first | (F.col("payload_bytes") < rules.min_revisit_bytes), "response").otherwise("revisit")
    records = rows.drop("payload").join(first, "digest").withColumn("record_type", kind)
    records.select("digest", _header(rules).alias("header")).write.parquet(f"{path}/records")
    # Equal digests have equal bytes: any row brings them, and copies fold before they are shuffled.
    rows.groupBy("digest").agg(F.any_value("payload").alias("payload")).write.parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """digest, header, payload and the whole WARC `record` of each archived page.

    Payloads are hashed again; one that doesn't fit its digest, or is missing, ends the job with an error.
    """
    records, stored = spark.read.parquet(f"{path}/records"), spark.read.parquet(f"{path}/payloads")
    sound = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload doesn't fit its digest: "), "digest")).cast("binary")
    )
    stored = stored.select("digest", sound.alias("payload"))
    there = F.when(F.col("payload").isNotNull(), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("no payload for digest: "), "digest")).cast("binary")
    )
    block = F.when(field("WARC-Type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return records.join(stored, "digest", "left").withColumn("payload", there).withColumn(
        "record", F.concat("header", block, F.lit((LINE_END * 2).encode()))
    )


def field(name: str, header: Column | str = "header") -> Column:
    """The value of a field of a header block, null where it lacks."""
    text = (F.col(header) if isinstance(header, str) else header).cast("string")
    found = F.regexp_extract(text, rf"(?m)^{name}: ([^\r\n]*)", 1)
    return F.when(text.rlike(rf"(?m)^{name}: "), found)


def parse_records(archive: DataFrame, rules: ArchiveRules = ArchiveRules()) -> DataFrame:
    """What the records say: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    Header and block are cut from the reconstructed record by its empty line and Content-Length.
    """
    ends = F.octet_length("header")
    cut = archive.select(
        "payload", F.substring(F.col("record"), F.lit(1), ends).alias("header"),
        F.substring(F.col("record"), ends + 1, F.octet_length("record") - ends - 4).alias("block"),
    )
    plain = lambda c: F.regexp_extract(c, r"(-?\d+)>$", 1)
    page = lambda c: F.when(c.isNotNull() & (plain(c) != ""), plain(c)).cast("long")
    digest = F.substring(field("WARC-Payload-Digest"), 8, 64)
    kind = field("WARC-Type")
    fits = (F.octet_length("block") == field("Content-Length").cast("int")) & (
        (kind == "revisit") | (F.sha2("block", 256) == digest))
    return cut.select(
        page(field("WARC-Record-ID")).alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(fits, digest).otherwise(F.raise_error(F.lit("record doesn't fit its header"))).alias("payload_digest"),
        kind.alias("record_type"), page(field("WARC-Refers-To")).alias("refers_to"), field("WARC-Target-URI").alias("url"),
    )


def write_warc_files(archive: DataFrame, path: str) -> None:
    """The records as WARC files. For UTF-8 payloads: the text sink ends each record with its two line breaks."""
    block = F.when(field("WARC-Type") == "response", F.col("payload")).otherwise(F.lit(b""))
    archive.select(F.concat("header", block).cast("string").alias("value")).write.option("lineSep", LINE_END * 2).text(path)


def archive_pages(pages: DataFrame, path: str | None = None, rules: ArchiveRules = ArchiveRules()) -> DataFrame:
    """Write the archive of pages (a new folder in the shared one by default), read it back and parse it. Runs jobs."""
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    write_archive(pages, path, rules)
    return parse_records(read_archive(spark, path), rules)
