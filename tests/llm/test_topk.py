"""Exact top-k against brute force, on odd vectors and through the registered query."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uptake.llm.topk import search, top_k

SCHEMA = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
     T.StructField("row", T.StringType()), T.StructField("score", T.StringType())]
)


def brute(rows, k=20):
    usable = {}
    for vec_id, v, *_ in rows:
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable[(vec_id, tuple(math.floor(64 * float(np.float32(x))) for x in v))] = None
    out = []
    for q, a in usable:
        if q % 20 == 0:
            scored = [(-sum(x * y for x, y in zip(a, b, strict=False)), c) for c, b in usable if c != q]
            out += [(q, r, c, -s) for r, (s, c) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def test_odd_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=8) * rng.choice([0.1, 1, 5])).tolist(), "", "") for i in range(300)]
    rows += [(0, rows[0][1], "x", None)] * 3 + [(20, [1.0], "", ""), (1000, [], "", "")]
    rows += [(40, [float("nan")] * 8, "", ""), (400, None, "", ""), (401, [None, 1.0], "", "")]
    rows += [(None, [1.0] * 8, "", ""), (402, [float("inf")], "", "")]
    rows += [(i, rows[7][1], "", "") for i in range(500, 540)]  # ties
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 20 == 0).collect())
    assert got == brute(rows)


def test_few_or_no_rows(spark):
    df = spark.createDataFrame([(20, [1.0, 2.0], "", ""), (21, [1.0, -1.0], "", "")], SCHEMA)
    assert [tuple(r) for r in top_k(df, F.col("vec_id") % 20 == 0).collect()] == [(20, 1, 21, -64 * 64)]
    assert top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    empty = spark.createDataFrame([(20, [], "", ""), (21, [], "", "")], SCHEMA)
    assert [tuple(r) for r in top_k(empty, F.col("vec_id") % 20 == 0).collect()] == [(20, 1, 21, 0)]


def test_pruning_keeps_large_and_extreme_scores():
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(3000, 24)) * rng.gamma(1, 50, (3000, 1))).astype(np.int64)
    vectors[5] *= 10**6
    vectors[6] = vectors[5]
    vectors[7, 0] = 1 << 62
    ids = rng.permutation(3000).astype(np.int64)
    basis = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    found = search(vectors[:9], ids[:9], vectors, ids, basis, k=20, head=6, block=128)
    for q in range(9):
        exact = [sum(int(a) * int(b) for a, b in zip(vectors[q], v, strict=True)) for v in vectors]
        exact = [min(max(s, -(1 << 63)), (1 << 63) - 1) for s in exact]
        best = sorted((-s, int(i)) for s, i in zip(exact, ids, strict=True) if i != ids[q])[:20]
        assert [(-int(s), int(i)) for i, s in zip(*found[q], strict=True)] == best
