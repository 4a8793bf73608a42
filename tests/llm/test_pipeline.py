"""Every stage of the pipeline against a plain version of what it should do to its input."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_decontamination import brute as brute_leaks
from tests.llm.test_packing import check_laws, ids_of
from tests.llm.test_sanitisation import brute_terms, words
from uptake.llm.sanitisation import base_spans, generalised

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before the first stage and after each."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).toArrow())
        out.append(docs.collect())
    return out


def shingles(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_columns_stay(stages):
    for rows in stages[:-1]:
        assert list(rows[0].asDict()) == COLUMNS


def test_language_stage_keeps_clean_documents(stages):
    kept = {r["doc_id"] for r in stages[1]}
    assert all(r in stages[0] for r in stages[1])
    lost = [r for r in stages[0] if r["doc_id"] not in kept]
    assert len(lost) <= 0.01 * len(stages[0])


def test_one_document_of_each_group_stays(stages):
    before, after = stages[1], {r["doc_id"] for r in stages[2]}
    sets = {r["doc_id"]: shingles(r["text"]) for r in before}
    group = {i: i for i in sets}
    for _ in range(len(sets)):
        changed = False
        for a in sets:
            for b in sets:
                if group[a] < group[b] and sets[a] and sets[b]:
                    if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                        group[b], changed = group[a], True
        if not changed:
            break
    assert after == set(group.values()) and len(after) < len(before)


def test_leaking_documents_go_and_others_stay(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    leaky = {r[0] for r in brute_leaks([(r["doc_id"], r["text"]) for r in stages[2]], items)}
    assert {r["doc_id"] for r in stages[3]} == {r["doc_id"] for r in stages[2]} - leaky
    assert leaky


def test_personal_data_goes_and_clean_texts_stay(stages):
    before = {r["doc_id"]: r for r in stages[3]}
    terms = brute_terms([r["text"] or "" for r in stages[3]])
    assert set(before) == {r["doc_id"] for r in stages[4]}
    changed = 0
    for r in stages[4]:
        old = before[r["doc_id"]]
        text = old["text"]
        spans = base_spans(text)
        spans += [("term", a, b) for a, b, w in words(text)
                  if (text, w) in terms and not any(a < y and b > x for _, x, y in spans)]
        assert r["text"] == generalised(text, spans) and r["n_chars"] == len(r["text"])
        assert [r[c] for c in ("lang", "source")] == [old[c] for c in ("lang", "source")]
        changed += r["text"] != old["text"]
    assert changed


def test_sequences_hold_the_ids_of_all_documents(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs, _ = check_laws(stages[5])
    assert set(docs) == {r["doc_id"] for r in stages[4]}
    for r in stages[4]:
        pieces = sorted(docs[r["doc_id"]], key=lambda p: p["start"])
        ids = np.frombuffer(b"".join(p["ids"] for p in pieces), "<u4").tolist()
        assert ids == ids_of(tokenizer, r["text"])
        assert all(zlib.crc32(p["ids"]) == p["ids_crc32"] for p in pieces)


def test_odd_documents(spark):
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
         T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
         T.StructField("n_chars", T.LongType()), T.StructField("_key", T.StringType()),
         T.StructField("score", T.StringType()), T.StructField("row", T.StringType()),
         *[T.StructField(c, T.StringType()) for c in ("key", "_id", "terms", "_text_key")]]
    )
    text = "the words of a text that is copied some times over"
    rows = [(None, text, "en", None, None, "", "", ""), (1, None, None, None, None, None, None, None),
            (2, "", "en", "s", 0, "", "", ""), (4, text, "en", "s", 9, "k", "s", "r")]
    rows += [(3, text, "en", "s", 9, "k", "s", "r")] * 4 + [(5, "word " * 50_000, "en", "", 1, "", "", "")]
    rows = [(*r, f"key {r[0]}", "id", f"terms {r[0]}", "t") for r in rows]
    docs = spark.createDataFrame(rows, schema)
    for data, counts in ((docs, [7, 2, 2, 2]), (docs.limit(0), [0] * 4)):
        for (_, stage), count in zip(corpus_pipeline.STAGES, counts, strict=False):
            data = stage(spark, data, SF_DIR)
            assert data.columns == docs.columns
            data = spark.createDataFrame(data.toArrow(), schema)
            assert data.count() == count
        assert corpus_pipeline.packing(spark, data, SF_DIR).count() == (0 if not count else 1 + 50_001 // 1024 + 1)
        if count:
            assert {r["doc_id"] for r in data.collect()} == {3, 5}
            kept = {(*r[:4], *r[5:]) for r in data.collect()}  # n_chars is counted anew
            assert kept <= {(*r[:4], *r[5:]) for r in rows}
