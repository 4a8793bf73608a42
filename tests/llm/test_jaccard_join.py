"""Near-duplicate classes against brute force on hot, chained and odd texts."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from uptake.llm.common import text_bytes
from uptake.llm.components import components
from uptake.llm.jaccard_join import _bitmap, keep_one, near_duplicate_classes, overlap_bound
from uptake.llm.shingles import shingle_sets, word_hashes

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("key", T.StringType()), T.StructField("n", T.StringType())]
)


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        lower = lower.replace(c, " ")
    return [w for w in lower.split(" ") if w]


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """(doc_id, n_shingles, component_id) of every row."""
    sets = [shingles(text) for _, text, *_ in rows]
    distinct = list({s for s in sets if s})
    group = {s: i for i, s in enumerate(distinct)}

    def find(i, up):
        while up[i] != i:
            i = up[i]
        return i

    up = list(range(len(distinct)))
    for i, a in enumerate(distinct):
        for j, b in enumerate(distinct[:i]):
            if min(len(a), len(b)) * 4 >= max(len(a), len(b)) * 3:
                if 100 * len(a & b) >= 75 * len(a | b):
                    up[find(i, up)] = find(j, up)
    least = {}
    for (doc_id, *_), s in zip(rows, sets, strict=True):
        if s and doc_id is not None:
            root = find(group[s], up)
            least[root] = min(least.get(root, doc_id), doc_id)
    return [
        (doc_id, len(s), least.get(find(group[s], up)) if s else doc_id)
        for (doc_id, *_), s in zip(rows, sets, strict=True)
    ]


def corpus():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    text = lambda n: [word() for _ in range(n)]
    template, line, out = text(60), text(30), []
    for _ in range(80):  # near copies, linked or not
        own = list(template)
        for _ in range(rng.randrange(4)):
            own[rng.randrange(60)] = word()
        out.append(own)
    out += [text(rng.randrange(2, 60)) + line + text(rng.randrange(60)) for _ in range(80)]
    out += [line] * 25 + [line + [word()] for _ in range(20)]
    chain = text(80)
    for i in range(0, 60, 6):  # each links to the next ones only
        out.append(chain[i : i + 60] + text(1))
    out += [text(rng.randrange(1, 7)) for _ in range(40)] + [["a", "b"], ["A", "B"], ["b", "a"]]
    out += [text(900) for _ in range(3)]
    out.append(out[-1][:880] + text(20))
    ids = list(range(len(out)))
    rng.shuffle(ids)
    return [(i, " ".join(own), "", "") for i, own in zip(ids, out, strict=True)]


def run(spark, rows):
    found = near_duplicate_classes(spark.createDataFrame(rows, SCHEMA))
    return sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in found.collect()), key=str)


def test_classes_equal_brute_force(spark):
    rows = corpus()
    want = sorted(brute(rows), key=str)
    assert len({w[2] for w in want}) < len(want) - 80
    assert run(spark, rows) == want


def test_odd_rows_equal_brute_force(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [
        (1, None, "", ""), (2, "", "", ""), (3, " \t\n", "", ""), (4, "a b c", "", ""), (5, "A\tb\nC ", "", ""),
        (6, "a b c d e f", "", ""), (6, "a b c d e f", None, None), (6, "other text", "", ""),
        (None, "a b c", "", ""), (None, "alone", "", ""), (7, long, "", ""), (8, long + " end", "", ""),
        (9, "x" * 2_500_000, "", ""), (10, "é É ß", "", ""), (11, "é é ß", "", ""), (12, "a\xa0b", "", ""),
    ]
    assert run(spark, rows) == sorted(brute(rows), key=str)
    assert run(spark, []) == [] and run(spark, rows[:3]) == sorted(brute(rows[:3]), key=str)


def test_one_row_of_each_class_stays(spark):
    rows = [*corpus(), (None, None, "", ""), (500, "", "", ""), (501, "new text", "", ""), (501, "new text", "", "")]
    kept = keep_one(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == SCHEMA.fieldNames()
    want = sorted({(c, t != 0) for _, t, c in brute(rows)}, key=str)
    assert sorted(((r["doc_id"], bool(words(r["text"]))) for r in kept.collect()), key=str) == want


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    links += [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)] + [(5, 5)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {x: find(x) for x in up if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(2)
    for _ in range(300):
        pool = rng.integers(0, 1 << 62, 400).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in range(2))
        n, m = len(a) + int(rng.integers(0, 200)), len(b) + int(rng.integers(0, 200))
        bound = overlap_bound(_bitmap(a, n), _bitmap(b, m), len(a) + len(b))
        assert bound >= len(np.intersect1d(a, b))


def test_words_over_block_borders():
    texts = ["ab " * 700_000 + "x" * 1_500_000 + " End\t", " ", "x" * 1_500_000 + " ", "a\nB c\x0bd\x0ce "]
    hashes, first = word_hashes(*text_bytes(pa.array(texts)))
    assert np.diff(first).tolist() == [700_002, 0, 1, 5]
    assert len(set(hashes[:700_000].tolist())) == 1 and hashes[700_000] == hashes[first[2]]
    assert [len(s) for s in shingle_sets(*text_bytes(pa.array(texts)))] == [3, 0, 1, 1]
