"""Content-addressed web archive: payload bytes once per digest, record headers apart, records rebuilt by a join."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir

#: The alphabet of base32, and the profile of revisits to an identical payload.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: The date of records where the caller gives none.
EPOCH = "1970-01-01T00:00:00Z"


def base32(hex_digest: Column) -> Column:
    """Base32 of a digest in hex whose length is a multiple of five digits (20 bits, four letters)."""

    def letters(i: Column) -> Column:
        bits = F.conv(F.substr(hex_digest, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        each = [F.substr(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
        return F.concat(*each)

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), letters), "")


def _urn(page: Column) -> Column:
    """A record id that can be read back: the page id in the last 16 digits of a UUID."""
    digits = F.lpad(F.lower(F.hex(page)), 16, "0")
    return F.concat(F.lit("<urn:uuid:00000000-0000-8000-"), F.substring(digits, 1, 4), F.lit("-"), F.substring(digits, 5, 12), F.lit(">"))


def _urn_of_digest(digest_hex: Column) -> Column:
    """A record id for rows without an id."""
    parts = [F.substring(digest_hex, begin, n) for begin, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _page_of(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"\r\n{name}: <urn:uuid:00000000-0000-8000-([0-9a-f]{{4}})-([0-9a-f]{{12}})>", 0)
    digits = F.regexp_replace(F.regexp_extract(found, r"8000-([0-9a-f-]+)>", 1), "-", "")
    high = F.conv(F.substring(digits, 1, 8), 16, 10).cast("long")
    low = F.conv(F.substring(digits, 9, 8), 16, 10).cast("long")
    return F.when(found != "", F.shiftleft(high, 32).bitwiseOR(low))


def write_archive(
    df: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least: int = 0,
    date: str = EPOCH,
) -> None:
    """Write ``folder/payloads`` (digest, payload, response) and ``folder/headers`` (digest, header).

    A header is all of a record before its payload: the record's own fields, dated ``date``, and for responses the head
    of an HTTP message with the payload as its body.

    One record per row, its payload the UTF-8 bytes of ``payload_col`` (null: empty). Payloads are stored once by
    SHA-256, with SHA-1 and length checked to agree among all that share it. Of records with equal payloads of at least
    ``least`` bytes that with the largest id is a response and the others revisit it; shorter payloads are responses
    all. Rows with a null id revisit, or are responses if no row of the payload has an id; their record id is made of
    the payload's digest and the URL, and equal ones share it. Rows that repeat the response's id are responses too. Line breaks in a URL are escaped; a null URL has no header line.
    Other columns are ignored.
    """
    payload = F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "utf-8")
    rows = df.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.unhex(F.sha2("payload", 256)), "sha1": F.sha1("payload"), "size": F.length("payload").cast("long")})

    stored = rows.groupBy("digest").agg(
        F.first("payload").alias("payload"),
        F.max("page").alias("response"),
        (F.min("sha1") == F.max("sha1")).alias("same_sha1"),
        (F.min("size") == F.max("size")).alias("same_size"),
    )
    stored = stored.withColumn("checked", F.assert_true(F.col("same_sha1") & F.col("same_size"), F.lit("digests collide")))
    stored = stored.where("checked IS NULL").select("digest", "payload", "response")
    stored.write.parquet(f"{folder}/payloads")

    responses = df.sparkSession.read.parquet(f"{folder}/payloads").select("digest", "response")
    joined = rows.drop("payload").join(responses, "digest")
    revisit = (F.col("size") >= least) & ~F.col("page").eqNullSafe(F.col("response"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value), F.lit(""))
    nameless = _urn_of_digest(F.sha2(F.concat(F.hex("digest"), F.coalesce(url, F.lit(""))), 256))
    size = F.col("size").cast("string")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit("\r\n\r\n"))
    head = F.when(revisit, "").otherwise(head)
    header = F.concat(
        F.lit("WARC/1.1"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.coalesce(_urn(F.col("page")), nameless)),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        line("WARC-Profile", F.when(revisit, PROFILE)),
        line("WARC-Refers-To", F.when(revisit, _urn(F.col("response")))),
        line("Content-Type", F.when(~revisit, F.lit("application/http; msgtype=response"))),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise((F.length(head) + F.col("size")).cast("string"))),
        F.lit("\r\n\r\n"),
        head,
    )
    joined.select("digest", header.alias("header")).write.parquet(f"{folder}/headers")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Per record: ``page_id``, ``url``, ``record_type``, ``refers_to``, ``payload_digest``, ``payload_bytes``,
    ``payload`` (of the response for revisits) and ``record`` (the record's exact bytes).

    Headers are parsed and joined with the payloads by digest. A stored payload that does not match its digest, or a
    header's, stops the job.
    """
    payloads = spark.read.parquet(f"{folder}/payloads")
    payloads = payloads.select(
        "digest",
        "payload",
        F.length("payload").cast("long").alias("payload_bytes"),
        base32(F.sha1("payload")).alias("payload_digest"),
        F.assert_true(F.unhex(F.sha2("payload", 256)) == F.col("digest"), F.lit("damaged payload")).alias("intact"),
    )
    records = spark.read.parquet(f"{folder}/headers").join(payloads.where("intact IS NULL"), "digest")
    header = F.col("header")
    field = lambda name: F.regexp_extract(header, rf"\r\n{name}: ([^\r\n]*)", 1)
    kind = field("WARC-Type")
    agree = F.assert_true(field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), "payload_digest"), F.lit("header and payload differ"))
    body = F.when(kind == "response", F.col("payload")).otherwise(F.lit(b""))
    return records.withColumn("agree", agree).where("agree IS NULL").select(
        _page_of(header, "WARC-Record-ID").alias("page_id"),
        F.when(field("WARC-Target-URI") != "", field("WARC-Target-URI")).alias("url"),
        kind.alias("record_type"),
        _page_of(header, "WARC-Refers-To").alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        "payload",
        F.concat(F.encode(header, "utf-8"), body, F.encode(F.lit("\r\n\r\n"), "utf-8")).alias("record"),
    )


def archive_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/llm/archive-{uuid.uuid4().hex}"
