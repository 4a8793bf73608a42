"""Archives: byte-exact round trip, shared payloads, odd rows, altered payloads."""

from __future__ import annotations

import base64
import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from uptake.llm.warc import export_warc, read_archive, write_archive

SCHEMA = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
     T.StructField("html", T.StringType()), T.StructField("address", T.IntegerType())]
)
ROWS = [
    (1, "http://a/", "<p>é</p>", 0), (2, None, "<p>é</p>", 0), (3, "http://a/\r\nX: y", None, 0),
    (4, "http://b", "", 1), (5, "u", "WARC/1.1\r\nWARC-Type: revisit\r\n\r\n", 1),
    (5, "u", "WARC/1.1\r\nWARC-Type: revisit\r\n\r\n", 1), (None, "n", "x" * 200_000, 1),
]


def archive(spark, tmp_path, rows=ROWS, **options):
    folder = str(tmp_path / "archive")
    write_archive(spark.createDataFrame(rows, SCHEMA), folder, **options)
    return folder


def test_round_trip(spark, tmp_path):
    folder = archive(spark, tmp_path)
    records = read_archive(spark, folder).collect()
    assert spark.read.parquet(f"{folder}/payloads").count() == 4
    assert len(records) == len(ROWS)
    for r in records:
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        length = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
        assert rest[length:] == b"\r\n\r\n"
        http, _, body = rest[:length].partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK\r\n")
        payload = bytes(r["payload"])
        assert body == (payload if r["record_type"] == "response" else b"")
        sums = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert r["payload_digest"] == sums and r["payload_bytes"] == len(payload)
    kinds = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in records if r["page_id"] != 5)
    assert kinds == [(0, "response", None), (1, "revisit", 2), (2, "response", None),
                     (3, "revisit", 4), (4, "response", None)]
    again = [(r["record_type"], r["refers_to"]) for r in records if r["page_id"] == 5]
    assert sorted(again, key=str) == [("response", None), ("revisit", 5)]


def test_short_payloads_and_no_rows(spark, tmp_path):
    folder = archive(spark, tmp_path, least_revisit_bytes=9)
    kinds = {r["page_id"]: r["record_type"] for r in read_archive(spark, folder).collect()}
    assert kinds[1] == "revisit" and kinds[3] == kinds[4] == "response"
    empty = str(tmp_path / "none")
    write_archive(spark.createDataFrame([], SCHEMA), empty)
    assert read_archive(spark, empty).count() == 0


def test_exported_files_hold_the_records(spark, tmp_path):
    records = read_archive(spark, archive(spark, tmp_path))
    export_warc(records, str(tmp_path / "files"))
    data = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path / "files").glob("*.gz"))
    assert len(data) == sum(len(r["record"]) for r in records.collect())
    assert all(bytes(r["record"]) in data for r in records.collect())


def test_altered_payload_fails(spark, tmp_path):
    folder = archive(spark, tmp_path)
    changed = spark.read.parquet(f"{folder}/payloads").collect()
    rows = [(r["address"], bytes(r["payload"]) + b"!") for r in changed]
    spark.createDataFrame(rows, "address string, payload binary").write.mode("append").parquet(
        str(tmp_path / "bad/payloads")
    )
    spark.read.parquet(f"{folder}/headers").write.parquet(str(tmp_path / "bad/headers"))
    with pytest.raises(PySparkException, match="digest of its address"):
        read_archive(spark, str(tmp_path / "bad")).collect()
