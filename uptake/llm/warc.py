"""A content-addressed web archive.

Payloads are stored once, under their SHA-256. Record headers are stored exactly, one row per
record, with the address of the payload. A join brings a record back byte for byte, and checks
the payload against its address and the digest in the header.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from uptake.llm.common import stored

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base 32 of the SHA-1: five hexadecimal digits are four characters."""
    digest = F.sha1(payload)
    letters = []
    for i in range(8):
        bits = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(bits, shift).bitwiseAND(31) + 1
            letters.append(F.substring(F.lit(BASE32), place, F.lit(1)))
    return F.concat(*letters)


def _urn(page: Column, row: Column) -> Column:
    digest = F.md5(F.concat_ws(":", page.cast("string"), row.cast("string")))
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, none for a null. White space that would end the line is percent-coded."""
    safe = value.cast("string")
    for raw, coded in (("\r", "%0D"), ("\n", "%0A")):
        safe = F.replace(safe, F.lit(raw), F.lit(coded))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(CRLF)), F.lit(""))


def _same_within_address(rows: DataFrame) -> DataFrame:
    """The response of every address, failing if two payloads share an address."""
    proof = F.struct("payload_bytes", "payload_digest")
    clash = F.raise_error(F.lit("different payloads have one SHA-256")).cast("long")
    last = F.max(F.struct("page_id", "row"))
    return rows.groupBy("address").agg(
        F.when(F.min(proof) == F.max(proof), last["page_id"]).otherwise(clash).alias("first_page"),
        F.when(F.min(proof) == F.max(proof), last["row"]).otherwise(clash).alias("first_row"),
    )


def write_archive(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_revisit_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write ``folder/payloads`` and ``folder/headers``, one record per row.

    Of the records with one payload of ``least_revisit_bytes`` or more, that with the largest id
    is the response and the others revisit it; shorter payloads are all responses. A null
    payload is empty; a null id counts as the smallest. Among rows that repeat the largest id
    one is the response. A null URL has no header line. Other columns are not looked at. No rows
    make an empty archive.
    """
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "utf-8")
    address = F.sha2(payload, 256)
    pages.select(address.alias("address"), payload.alias("payload")).groupBy("address").agg(
        F.first("payload").alias("payload")
    ).write.parquet(f"{folder}/payloads")

    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.monotonically_increasing_id().alias("row"),
        address.alias("address"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        base32_sha1(payload).alias("payload_digest"),
    )
    rows = stored(rows, "records")
    revisit = (F.col("payload_bytes") >= least_revisit_bytes) & (
        F.col("row") != F.col("first_row")
    )
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"),
        _line("Content-Length", F.col("payload_bytes")),
        F.lit(CRLF),
    )
    body = F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("payload_bytes"))
    refers = F.when(F.col("revisit"), _urn(F.col("first_page"), F.col("first_row")))
    headers = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("page_id"), F.col("row"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("WARC-Refers-To", refers),
        _line("WARC-Profile", F.when(F.col("revisit"), F.lit(PROFILE))),
        _line("Page-ID", F.col("page_id")),
        _line("Refers-To-Page-ID", F.when(F.col("revisit"), F.col("first_page"))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length("http") + body),
        F.lit(CRLF),
    )
    (
        rows.join(_same_within_address(rows), "address")
        .withColumn("revisit", revisit)
        .withColumn("http", http)
        .select("address", headers.alias("headers"), "http")
        .write.parquet(f"{folder}/headers")
    )


def _field(name: str) -> Column:
    """The value of a header line, null without it."""
    found = F.regexp_extract("headers", rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(F.contains("headers", F.lit(f"{CRLF}{name}: ")), found)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every record: ``page_id``, ``record_type``, ``refers_to``, ``payload_digest``,
    ``payload_bytes``, ``payload`` (of what it revisits, for a revisit) and the bytes of the
    ``record``. A payload that does not fit its address, or a header's digest, fails."""
    payloads = spark.read.parquet(f"{folder}/payloads")
    spoiled = F.raise_error(F.lit("a payload does not have the digest of its address"))
    payloads = payloads.select(
        F.when(F.sha2("payload", 256) == F.col("address"), F.col("address"))
        .otherwise(spoiled.cast("string"))
        .alias("address"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("sha1"),
        "payload",
    )
    wrong = F.raise_error(F.concat(F.lit("payload missing or altered: "), F.col("headers")))
    kind = _field("WARC-Type")
    return (
        spark.read.parquet(f"{folder}/headers")
        .join(payloads, "address", "left")
        .select(
            _field("Page-ID").cast("long").alias("page_id"),
            kind.alias("record_type"),
            _field("Refers-To-Page-ID").cast("long").alias("refers_to"),
            F.when(_field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), "sha1"), F.col("sha1"))
            .otherwise(wrong.cast("string"))
            .alias("payload_digest"),
            "payload_bytes",
            "payload",
            F.concat(
                F.encode(F.concat("headers", "http"), "utf-8"),
                F.when(kind == "response", F.col("payload")).otherwise(F.lit(b"")),
                F.lit(b"\r\n\r\n"),
            ).alias("record"),
        )
    )


def export_warc(records: DataFrame, folder: str) -> None:
    """The records as gzipped WARC files, one per partition."""
    text = F.decode(F.expr("substring(record, 1, octet_length(record) - 4)"), "utf-8")
    records.select(text.alias("value")).write.option("lineSep", "\r\n\r\n").option(
        "compression", "gzip"
    ).text(folder)
