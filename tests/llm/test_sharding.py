"""Laws of rendezvous sharding: growth, weights, gapless slots, odd rows."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uptake.llm.sharding import rendezvous_shard, shard_documents

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("shard", T.StringType()), T.StructField("_row", T.StringType())]
)


def test_rows_slots_and_growth(spark):
    data = [(i, "é" * (i % 7), "", "") for i in range(2000)]
    data += [(None, None, "x", None), (None, "a", "", ""), (7, "", "", "")] + [(9, "hot", "", "")] * 900
    rows = shard_documents(
        spark.createDataFrame(data, SCHEMA), dict.fromkeys(range(16), 1.0),
        dict.fromkeys(range(17), 1.0), rows_per_part=50,
    ).collect()
    key = lambda t: tuple((v is None, v or 0) for v in t)
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in data), key=key)
    assert sorted(((r["id"], r["size"], r["text_crc32"]) for r in rows), key=key) == want
    slots, shards = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        shards[r["id"]].add((r["shard"], r["grown_shard"]))
        assert r["grown_shard"] in (r["shard"], 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shards.values())
    moved = sum(r["grown_shard"] == 16 for r in rows if r["id"] != 9) / 2000
    assert 0.03 < moved < 0.1


def test_weights_and_changed_weights(spark):
    keys = spark.range(20_000)
    before = {0: 1.0, 1: 2.0, 2: 1.0}
    after = before | {1: 3.0}
    rows = keys.select(
        rendezvous_shard(F.col("id"), before).alias("a"), rendezvous_shard(F.col("id"), after).alias("b")
    ).collect()
    share = Counter(r["a"] for r in rows)
    assert abs(share[1] / 20_000 - 0.5) < 0.02
    assert all(r["a"] == r["b"] or r["b"] == 1 for r in rows)
    with pytest.raises(ValueError):
        rendezvous_shard(F.col("id"), {0: 0.0})


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert shard_documents(empty, {0: 1.0}).count() == 0
