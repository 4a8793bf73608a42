"""Forward-backward against enumeration, held-out accuracy, code-switched and odd texts."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from uptake.llm.common import text_bytes
from uptake.llm.language_crf import features, posteriors, split_words
from uptake.llm.language_id import fit, held_out, identify
from uptake.llm.queries import op9_language_id

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("lang", T.StringType()), T.StructField("score", T.StringType()),
     T.StructField("letters", T.StringType())]
)


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return fit(docs.where(~held_out("doc_id")))


def test_posteriors_equal_enumeration():
    rng = np.random.default_rng(0)
    line = np.array([0, 0, 0, 0, 1, 2, 2])
    scores, moves, begin = rng.normal(size=(7, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    got, pairs, total = posteriors(scores, line, moves, begin, pairs=True)
    want, want_pairs, want_total = np.zeros((7, 3)), np.zeros((3, 3)), 0.0
    for part in (range(0, 4), range(4, 5), range(5, 7)):
        weights = {}
        for path in itertools.product(range(3), repeat=len(part)):
            weights[path] = begin[path[0]] + sum(scores[i, y] for i, y in zip(part, path, strict=True))
            weights[path] += sum(moves[a, b] for a, b in zip(path, path[1:], strict=False))
        z = sum(np.exp(w) for w in weights.values())
        want_total += np.log(z)
        for path, w in weights.items():
            for i, y in zip(part, path, strict=True):
                want[i, y] += np.exp(w) / z
            for a, b in zip(path, path[1:], strict=False):
                want_pairs[a, b] += np.exp(w) / z
    assert np.allclose(got, want) and np.allclose(pairs, want_pairs)
    assert np.isclose(total + np.log(np.exp(0)), want_total)


def test_words_and_features():
    words = split_words(*text_bytes(pa.array(["Été zwei-DREI 4x\nb\n", "\n", "Ét\n"])))
    spelled = [bytes(words.data[a:b]).decode() for a, b in zip(words.starts, words.ends, strict=True)]
    assert spelled == ["été", "zwei", "drei", "x", "b", "ét"]
    assert words.line.tolist() == [0, 0, 0, 0, 1, 2] and words.first.tolist() == [0, 5, 5, 6]
    numbers, place = features(words, np.array([3, 5]))
    # A bias, an affix at either end per length up to four, and n-grams of two and three bytes.
    assert np.diff(np.r_[place, len(numbers)]).tolist() == [3, 1 + 6 + 2 + 1]


def test_held_out_accuracy_and_what_is_learned(spark):
    rows = op9_language_id(spark, "/root/testdata/sf0.01").collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(truth)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in {"de", "en", "es", "fr", "und"}
    tested = [r for r in rows if r["held_out"]]
    right = sum(r["lang_pred"] == truth[r["doc_id"]] for r in tested)
    assert len(tested) > 150 and right >= 0.98 * len(tested)


def test_code_switched_text(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("length(text) > 800")
    lines = {
        r["lang"]: max(r["text"].split("\n"), key=len)[:300].rsplit(" ", 1)[0]
        for r in docs.orderBy("doc_id").limit(200).collect()
        if "***" not in r["text"] and "!!" not in r["text"]
    }
    text = f"{lines['en']} {lines['fr']}\n{lines['de']}"
    df = spark.createDataFrame([(1, text, None, "", "")], SCHEMA)
    row = identify(df, model, segments=True).first()
    data, share = text.encode(), {}
    for s in row["segments"]:
        share[s["lang"]] = share.get(s["lang"], 0) + s["end"] - s["start"]
        assert data[s["start"] : s["end"]].decode().strip() != ""
    for lang in ("en", "fr", "de"):
        assert share[lang] > 0.7 * len(lines[lang].encode())
    assert row["score"] < 0.8


def test_odd_rows(spark, model):
    texts = [None, "", " \n\n", "12 + 3 = 15!", "日本語", "a", "x" * 300_000, "the " * 100_000, "¿?", "é\n" * 3]
    docs = spark.createDataFrame([(i if i % 2 else None, t, "zz", "", "") for i, t in enumerate(texts)], SCHEMA)
    rows = identify(docs, model, segments=True).collect()
    assert [r["lang_pred"] == "und" for r in rows] == [t in (None, "", " \n\n", "12 + 3 = 15!", "¿?") for t in texts]
    assert all((r["score"] == 0) == (r["lang_pred"] == "und") for r in rows)
    nothing = fit(docs.limit(0))
    assert nothing.labels == [] and identify(docs.limit(0), model).count() == 0
    unlearned = identify(docs, nothing, segments=True).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlearned} == {("und", 0.0)}
    one = fit(spark.createDataFrame([(1, "only text", "xx", "", ""), (2, None, "yy", "", "")], SCHEMA))
    assert identify(docs, one).where("lang_pred = 'xx'").count() == 5
