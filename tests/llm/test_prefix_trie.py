"""The trie of conversation prefixes against a plain one."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from uptake.llm.prefix_trie import ends_sha256, ordered_turns, rebuilt, trie_nodes

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, depth int, n bigint"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows, rebuild=True):
    """The nodes from lists of turns; turns of one number are ordered by role and digest."""
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = sha(f"{len(role.encode())}:{role}{text}")
            key = (turn is not None, turn or 0, role.encode(), digest)
            convs.setdefault(c, []).append((key, (role, text)))
    own = {c: [t for _, t in sorted(ts)] for c, ts in convs.items()}
    whole = own
    if rebuild:
        whole = {}
        for c, turns in own.items():
            h = zlib.crc32(str(c).encode()) % 4
            base = c - int(np.fmod(c, 20))
            whole[c] = own.get(base, [])[:h] + turns[h:]
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for node, own_members in members.items():
        d = len(node)
        below = [x for x in members if x[:d] == node]
        inner = {x[:-1] for x in members if x}
        ends = sorted(c for c in own_members if len(whole[c]) == d)
        saved = sum(
            (len(members[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) for x in below if x
        )
        out.add(
            (min(own_members), d, min(members[node[:-1]]) if d else None, len(own_members),
             sum(len(x) == d + 1 for x in below), sum(x not in inner for x in below), saved,
             sha(",".join(map(str, ends))))
        )
    return out


def query(df):
    conv = F.col("conv")
    shared = (F.crc32(conv.cast("string").cast("binary")) % 4).cast("long")
    return trie_nodes(*rebuilt(ordered_turns(df), shared, conv - conv % 20, most=3))


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def sequences(rng, n, longest, kinds):
    """Conversations that share prefixes of many lengths, some of them equal."""
    rows = []
    for c in range(n):
        size = int(rng.integers(0, longest + 1))
        words = rng.integers(0, kinds, size)
        words[: int(rng.integers(0, size + 1))] = 0
        rows += [(c, t, "user", f"w{w} " * (w + 1)) for t, w in enumerate(words)]
    return rows


@pytest.mark.parametrize("n, longest, kinds", [(60, 4, 2), (40, 9, 2), (12, 33, 1), (1, 16, 3)])
def test_equals_a_plain_trie(spark, n, longest, kinds):
    rows = sequences(np.random.default_rng(n), n, longest, kinds)
    df = spark.createDataFrame([(*r, "x", 1, None) for r in rows], SCHEMA)
    assert got(query(df)) == plain(rows)


def test_without_rebuilding(spark):
    rows = sequences(np.random.default_rng(5), 50, 12, 2)
    df = spark.createDataFrame([(*r, "x", 1, None) for r in rows], SCHEMA)
    nodes = trie_nodes(*rebuilt(ordered_turns(df), F.lit(0), F.col("conv"), most=0))
    assert got(nodes) == plain(rows, rebuild=False)


def test_odd_rows(spark):
    rows = [(20, None, "user", "first"), (20, 3, None, None), (20, 3, None, None), (20, 3, "", "")]
    rows += [(20, 3, "a", "b"), (20, 3, "ab", ""), (20, 3, "", "ab"), (None, 1, "user", "lost")]
    rows += [(21, 0, "user", "é " * 300_000), (-3, 5, "user", "x"), (-20, 1, "user", "y")]
    rows += [(c, t, "user", "same\x0bwords\tthrice") for c in range(40, 70) for t in range(6)]
    rows += [(70, 9000 * t, "user", f"{t}") for t in range(6, 0, -1)] + [(1 << 62, 1, "u", "z")]
    df = spark.createDataFrame([(*r, "x", 1, None) for r in rows], SCHEMA)
    assert got(query(df)) == plain(rows)


def test_no_rows_and_turnless_conversations(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert query(df).collect() == []
    df = spark.createDataFrame([(c, 0, "user", "x", "", 0, 0) for c in (5, 7)], SCHEMA)
    nodes = trie_nodes(*rebuilt(ordered_turns(df), F.lit(3), F.col("conv") - 1, most=3))
    assert got(nodes) == {(5, 0, None, 2, 0, 1, 0, sha("5,7"))}


def test_ids_of_a_large_group_are_hashed_in_pieces(spark):
    ends = spark.range(-500, 5000).select(
        F.col("id").alias("conv"), F.lit(1).cast("long").alias("end_conv"),
        F.lit(2).cast("long").alias("depth"),
    )
    assert [tuple(r) for r in ends_sha256(ends, ids_per_piece=64).collect()] == [
        (1, 2, sha(",".join(map(str, range(-500, 5000)))))
    ]
