"""Content-addressed WARC archive (operator 3).

A written archive has two tables. `payloads` holds each distinct payload once, under its SHA-256;
`headers` holds one row per record: its exact header bytes (the WARC header, and the HTTP header
that opens its block) and the address of its payload. Records are put together again by joining
the two, and `from_records` cuts the rebuilt bytes up again, as a reader of the archive would.
Addresses are verified: writing fails if payloads of one address differ in length or
SHA-1, reading fails if stored bytes don't have the digests that address and header state.

Of records with equal payloads the one with the smallest page id is a response, the others are
revisits that refer to it; payloads smaller than `least` bytes are all responses.

A null payload is an empty one. A null id comes after all others; repeated rows are records of
their own, of which the first is the response and the others revisit it. A null url is left out
of the header. Line breaks in a url are percent-encoded. An empty table gives an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Digits of base 32 as Spark's conv() gives them, and as digests are written.
DIGITS, LETTERS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: four runs of 40 bits with eight digits each."""
    digest = F.sha1(payload)
    runs = [
        F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)
    ]
    return F.translate(F.concat(*runs), DIGITS, LETTERS)


def _records(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).cast("binary")
    return pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumn("address", F.unhex(F.sha2("payload", 256)))


def _name(page_id: Column, copy: Column) -> Column:
    return F.concat(
        F.lit("<urn:tallystar:page:"), F.coalesce(page_id.cast("string"), F.lit("none")),
        F.lit(":"), copy.cast("string"), F.lit(">"),
    )


def write_archive(
    pages: DataFrame,
    path: str,
    least: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
) -> None:
    """Writes the archive of a table of pages; `date` is the WARC-Date of all records."""
    records = _records(pages, id_col, url_col, payload_col)
    # Equal payloads are combined before the shuffle, so a group of copies costs one per task.
    records.groupBy("address").agg(F.first("payload").alias("payload")).write.mode(
        "errorifexists"
    ).parquet(f"{path}/payloads")
    slim = records.select(
        "page_id", "url", "address",
        F.octet_length("payload").cast("long").alias("size"),
        base32_sha1(F.col("payload")).alias("digest"),
    )
    same = slim.groupBy("page_id", "url", "address", "size", "digest").agg(F.count("*").alias("n"))
    order = F.struct(
        F.col("page_id").isNull().alias("last"), "page_id", F.coalesce("url", F.lit("")).alias("url"),
        F.col("url").isNull().alias("no_url"),
    )
    first = same.groupBy("address").agg(
        F.min(order).alias("first"),
        F.min("size").alias("size_least"), F.max("size").alias("size_most"),
        F.min("digest").alias("digest_least"), F.max("digest").alias("digest_most"),
    )
    agree = (F.col("size_least") == F.col("size_most")) & (
        F.col("digest_least") == F.col("digest_most")
    )
    first = first.select(
        F.when(agree, F.col("address"))
        .otherwise(F.raise_error(F.lit("two payloads have one SHA-256"))).alias("address"),
        "first",
    )
    small = F.col("size") < least
    joined = (
        same.join(first, "address")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        .withColumn("response", small | ((order == F.col("first")) & (F.col("copy") == 1)))
    )
    joined = _numbered_copies(joined)
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"), F.lit("\r\n\r\n"),
    )
    block = F.length(http) + F.when(F.col("response"), F.col("size")).otherwise(0)
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    warc = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(F.col("response"), "response").otherwise("revisit"),
        F.lit("\r\nWARC-Record-ID: "), _name(F.col("page_id"), F.col("copy")),
        F.lit(f"\r\nWARC-Date: {date}"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), url), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(F.col("response"), "").otherwise(
            F.concat(
                F.lit("\r\nWARC-Refers-To: "), _name(F.col("first.page_id"), F.lit(1)),
                F.lit(f"\r\nWARC-Profile: {PROFILE}"),
            )
        ),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        block.cast("string"), F.lit("\r\n\r\n"),
    )
    joined.select(
        "page_id", "copy", "address",
        warc.cast("binary").alias("warc_header"), http.cast("binary").alias("http_header"),
    ).write.mode("errorifexists").parquet(f"{path}/headers")


def _numbered_copies(rows: DataFrame) -> DataFrame:
    """Keeps record names unique: the response of a page id is its copy 1."""
    return rows.withColumn(
        "copy",
        F.when(F.col("response") & (F.col("copy") == 1), F.col("copy").cast("string")).otherwise(
            F.concat(
                F.col("copy").cast("string"), F.lit("-"),
                F.substring(F.sha1(F.concat_ws("|", F.hex("address"), "url").cast("binary")), 1, 16),
            )
        ),
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records of an archive, with their fields read from the headers and their full payloads.

    Columns: page_id, record_type, refers_to, target_uri, payload_bytes, payload_digest, payload,
    record (the exact bytes: header, block and the two line ends after it).
    """
    headers = spark.read.parquet(f"{path}/headers")
    stored = spark.read.parquet(f"{path}/payloads")
    stored = stored.select(
        "address", "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(F.unhex(F.sha2("payload", 256)) == F.col("address"), base32_sha1(F.col("payload")))
        .otherwise(F.raise_error(F.lit("a stored payload doesn't have its address")))
        .alias("found_digest"),
    )
    text = F.decode("warc_header", "UTF-8")
    field = lambda name, rest="([^\r\n]*)": F.regexp_extract(text, f"\r\n{name}: {rest}", 1)
    kind = headers.schema["page_id"].dataType
    parsed = headers.select(
        F.regexp_extract(text, "\r\nWARC-Record-ID: <urn:tallystar:page:(.*):[^:>]*>", 1).alias("id"),
        field("WARC-Type").alias("record_type"),
        field("WARC-Refers-To", "<urn:tallystar:page:(.*):[^:>]*>").alias("to"),
        field("WARC-Target-URI").alias("target_uri"),
        field("WARC-Payload-Digest", "sha1:([A-Z2-7]*)").alias("stated_digest"),
        "page_id", "address", "warc_header", "http_header",
    )
    number = lambda c: F.expr(f"try_cast({c} as {kind.simpleString()})")
    end = F.lit(b"\r\n\r\n")
    return parsed.join(stored, "address").select(
        F.when(number("id").eqNullSafe(F.col("page_id")), F.col("page_id"))
        .otherwise(F.raise_error(F.lit("a record's name doesn't fit its row"))).alias("page_id"),
        "record_type",
        number("to").alias("refers_to"),
        F.nullif("target_uri", F.lit("")).alias("target_uri"),
        "payload_bytes",
        F.when(F.col("stated_digest") == F.col("found_digest"), F.col("found_digest"))
        .otherwise(F.raise_error(F.lit("a payload doesn't have its record's digest")))
        .alias("payload_digest"),
        "payload",
        F.when(
            F.col("record_type") == "response",
            F.concat("warc_header", "http_header", "payload", end),
        ).otherwise(F.concat("warc_header", "http_header", end)).alias("record"),
    )


def from_records(archive: DataFrame) -> DataFrame:
    """page_id, record_type, refers_to, payload_bytes, payload_digest, as the bytes of `record` say.

    The WARC header ends at the first empty line and states the block's length, the HTTP header ends
    at the next. What follows in a response is its payload, whose length and SHA-1 must be those that
    the headers state; a revisit has no payload of its own and states those of the record that it
    refers to, which reading has compared. A record that doesn't end after its block fails the job.
    """
    blank = "\r\n\r\n"
    text = F.decode("record", "ISO-8859-1")  # a character for each byte
    ends = archive.withColumn("text", text).withColumn("warc_end", F.locate(blank, "text") + 3)
    ends = ends.withColumn("http_end", F.expr("locate('\\r\\n\\r\\n', text, warc_end + 1)") + 3)
    warc = F.decode(F.expr("substring(record, 1, warc_end)"), "UTF-8")
    http = F.expr("substring(text, warc_end + 1, http_end - warc_end)")
    field = lambda head, name: F.regexp_extract(head, f"\r\n{name}: ([^\r\n]*)", 1)
    kind = archive.schema["page_id"].dataType.simpleString()
    cut = ends.select(
        "page_id",
        field(warc, "WARC-Type").alias("record_type"),
        F.regexp_extract(warc, "\r\nWARC-Refers-To: <urn:tallystar:page:(.*):[^:>]*>", 1).alias("to"),
        F.regexp_extract(warc, "\r\nWARC-Payload-Digest: sha1:([A-Z2-7]*)", 1).alias("stated"),
        field(http, "Content-Length").cast("long").alias("payload_bytes"),
        (F.col("warc_end") + field(warc, "Content-Length").cast("long")).alias("block_end"),
        F.octet_length("record").alias("size"),
        "http_end",
        "record",
    )
    payload = F.expr("substring(record, http_end + 1, cast(block_end as int) - http_end)")
    response = F.col("record_type") == "response"
    whole = (F.col("block_end") + len(blank) == F.col("size")) & (
        F.when(
            response,
            (F.octet_length(payload) == F.col("payload_bytes"))
            & (base32_sha1(payload) == F.col("stated")),
        ).otherwise(F.col("http_end") == F.col("block_end"))
    )
    wrong = F.raise_error(F.lit("a record isn't what its headers state"))
    return cut.select(
        "page_id",
        "record_type",
        F.expr(f"try_cast(`to` as {kind})").alias("refers_to"),
        "payload_bytes",
        F.when(whole, F.col("stated")).otherwise(wrong).alias("payload_digest"),
    )
