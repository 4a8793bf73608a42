"""Phrases against plain counts, on odd texts and at other settings."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from uptake.llm import phrases as module
from uptake.llm.phrases import collocations, count_phrases

SCHEMA = "id bigint, text string, lang string, phrase string, k string, shard string, since int"


def plain_counts(rows, most_words):
    counts, totals = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = [w for w in re.split("[ \t]", piece) if w]
            totals[lang] += len(words)
            for k in range(1, most_words + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, k, " ".join(words[i : i + k])] += 1
    return counts, {lang: n for lang, n in totals.items() if n}


def plain_ranking(counts, totals, least, most):
    frequent = {x: n for x, n in counts.items() if n >= least}
    inside = {}
    for (lang, k, phrase), n in frequent.items():
        words = phrase.split(" ")
        for m in range(2, k):
            for i in range(k - m + 1):
                key = (lang, m, " ".join(words[i : i + m]))
                inside[key] = max(inside.get(key, 0), n)
    rows = {}
    for (lang, k, phrase), a in frequent.items():
        if k == 1 or 100 * inside.get((lang, k, phrase), 0) >= 100 * a:
            continue
        words, cuts = phrase.split(" "), []
        for cut in range(1, k):
            parts = (lang, cut, " ".join(words[:cut])), (lang, k - cut, " ".join(words[cut:]))
            left, right = counts[parts[0]], counts[parts[1]]
            cuts.append((1000 * a * totals[lang] // (left * right), cut, left, right))
        score, _, left, right = min(cuts)
        rows.setdefault(lang, []).append((-score, -a, phrase.encode(), left, right))
    return {
        (lang, rank, p.decode(), -a, left, right, totals[lang], -score)
        for lang, own in rows.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(own)[:most], 1)
    }


def texts(rng, n):
    """Common words in free order, passages that come back, and some that overlap themselves."""
    words = [f"w{i}" for i in range(12)] + ["É", "the", "THE", "x\xa0y", "漢字"]
    passages = ["Alpha beta gamma delta epsilon zeta", "red red red red red red", "one two; three four"]
    rows = []
    for i in range(n):
        run = [str(rng.choice(words)) + str(rng.choice(["", "", "", ",", "\n", "\t", "  "])) for _ in range(20)]
        run.insert(int(rng.integers(0, 20)), str(rng.choice(passages)))
        rows.append((i, " ".join(run), ["en", "de", None, ""][int(rng.integers(0, 4))]))
    return rows


def check(spark, rows, least, most_words=5, shards=4, most=30):
    df = spark.createDataFrame([(*r, "phrase", "k", "s", 1) for r in rows], SCHEMA)
    found, totals = count_phrases(df, least=least, most_words=most_words, shards=shards)
    counts, n = plain_counts(rows, most_words)
    got = {(r["lang"], r["k"], r["phrase"]): r["n"] for r in found.collect()}
    assert got == {x: c for x, c in counts.items() if c >= least}
    assert {r["lang"]: r["words"] for r in totals.collect()} == n
    ranked = {tuple(r) for r in collocations(found, totals, most).collect()}
    assert ranked == plain_ranking(counts, n, least, most)


@pytest.mark.parametrize("least, most_words, shards", [(8, 5, 4), (3, 4, 2), (30, 6, 3)])
def test_counts_and_ranking(spark, monkeypatch, least, most_words, shards):
    monkeypatch.setattr(module, "WINDOW_BYTES", 500)
    check(spark, texts(np.random.default_rng(least), 300), least, most_words, shards)


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, " ,.\n\t", None), (4, "a b c " * 300_000, "en")]
    rows += [(5, "x" * 3_000_000 + " end", "en"), (None, "same words here", "fr")] + [
        (6, "Same\twords  here", "fr")
    ] * 40
    check(spark, rows, least=20)


def test_one_language_named_like_the_missing_one(spark):
    check(spark, [(i, "a b", lang) for i in range(30) for lang in (None, "und")], least=10)


def test_no_rows(spark):
    found, totals = count_phrases(spark.createDataFrame([], SCHEMA))
    assert found.collect() == totals.collect() == collocations(found, totals, 5).collect() == []


def test_products_beyond_64_bits(spark):
    big = 4_000_000_000_000_000
    found = spark.createDataFrame(
        [("en", 1, "a", big), ("en", 1, "b", big - 1), ("en", 2, "a b", big - 7)],
        "lang string, k int, phrase string, n bigint",
    )
    totals = spark.createDataFrame([("en", 9 * big + 1)], "lang string, words bigint")
    (row,) = collocations(found, totals, 5).collect()
    assert row["score"] == 1000 * (big - 7) * (9 * big + 1) // (big * (big - 1))
