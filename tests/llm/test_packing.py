"""Token ids against the tokenizer itself; packing laws on hand-made and given rows."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from uptake.llm.packing import Encoder, first_fit_decreasing, pack, tokenised_pieces
from uptake.llm.queries import op1_packing

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_encoder_equals_the_tokenizer(tokenizer):
    texts = ["", " ", "a", " a  b", "a \n\nb \t c  ", "don't I'll", "x<|endoftext|> y", "é́ 😀\x1c a",
             "12 345", " a  b", "a" * 5000, "\n", "a\n", "a\n b"]
    encoder = Encoder(RANKS, PATTERN)
    for text in texts:
        assert np.frombuffer(encoder(text), "<u4").tolist() == ids_of(tokenizer, text)[:-1]


def test_first_fit_decreasing_against_a_plain_scan():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 300):
        lengths = rng.integers(1, 101, n).tolist()
        sequence, offset = first_fit_decreasing(lengths, 100)
        left, expected = [], [0] * n
        for i in sorted(range(n), key=lambda i: -lengths[i]):
            at = next((j for j, room in enumerate(left) if room >= lengths[i]), len(left))
            left += [100] * (at == len(left))
            expected[i], left[at] = at, left[at] - lengths[i]
        assert sequence == expected
        spans = sorted(zip(sequence, offset, lengths, strict=True))
        for (s, a, n_a), (t, b, _) in zip(spans, spans[1:], strict=False):
            assert b == (a + n_a if s == t else 0)


def check_laws(rows):
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in sequences.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end and length > 0
            end += length
        assert end <= 1024
    return docs, sequences


def test_query_packs_every_id_once_and_densely(spark, sf_dir, tokenizer):
    rows = op1_packing(spark, sf_dir).collect()
    docs, sequences = check_laws(rows)
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids, place = np.array(ids_of(tokenizer, r["text"]), "<u4"), 0
        for piece in sorted(docs.pop(r["doc_id"]), key=lambda p: p["start"]):
            assert piece["start"] == place and piece["doc_tokens"] == len(ids)
            place += piece["length"]
            assert piece["ids_crc32"] == zlib.crc32(ids[piece["start"] : place].tobytes())
        assert place == len(ids)
    assert not docs
    assert len(sequences) <= 1 + 1.03 * sum(r["length"] for r in rows) / 1024


def test_odd_rows(spark):
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
         T.StructField("row", T.StringType()), T.StructField("offset", T.StringType())]
    )
    data = [(1, None, "x", "y"), (1, "", None, None), (None, "a b", "", ""), (2, "word " * 9000, "", "")]
    data += [(3, "same", "", "")] * 5
    docs = spark.createDataFrame(data, schema)
    pieces = tokenised_pieces(docs, RANKS, PATTERN)
    rows = pack(pieces, docs.count(), group_documents=2).collect()
    assert sorted(r["doc_tokens"] for r in rows if r["id"] in (1, None)) == [1, 1, 3]
    assert sum(r["id"] == 3 for r in rows) == 5
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in rows)
    check_laws([{**r.asDict(), "doc_id": r["id"]} for r in rows])
    assert pack(tokenised_pieces(docs.limit(0), RANKS, PATTERN), 0).count() == 0
