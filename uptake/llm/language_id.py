"""Language of documents from the labels of their words (see ``language_crf``)."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uptake.llm.common import runs, text_bytes, text_slices
from uptake.llm.language_crf import Model, Words, split_words, train

SAMPLE_DOCUMENTS = 600  # expected; the fit is on the driver
MOST_SAMPLE_CHARACTERS = 20_000  # of one document of the sample
SLICE_BYTES = 1 << 20  # of text that is labelled at once
FOLDS, HELD_OUT_FOLD = 5, 0
UNDETERMINED = "und"


def held_out(id_col: str) -> Column:
    """Whether a row is in the fold that nothing is learned from; so is one with a null id."""
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(True))


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    documents: int = SAMPLE_DOCUMENTS,
) -> Model:
    """Train on a sample of about ``documents`` different texts with a language.

    Texts are chosen by their hash, so the sample is the same wherever it is drawn. Texts
    without letters or longer than ``MOST_SAMPLE_CHARACTERS`` are not in it. Only the sample
    reaches the driver, at most twice its expected size.
    """
    text = F.col(text_col)
    rows = docs.where(F.col(lang_col).isNotNull() & has_letters(text)).select(
        text.alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    rows = rows.where(F.length("text") <= MOST_SAMPLE_CHARACTERS)
    share = min(1.0, documents / max(1, docs.count()))
    drawn = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = rows.where(drawn).groupBy("text").agg(F.min("lang").alias("lang"))
    sample = sample.orderBy(F.xxhash64("text")).limit(2 * documents).collect()
    sample.sort(key=lambda r: (zlib.crc32(r["text"].encode()), r["text"]))
    texts = pa.array([r["text"] + "\n" for r in sample], pa.string())
    return train(*text_bytes(texts), [r["lang"] for r in sample])


_SEGMENT = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])


def _segments(words: Words, offsets: np.ndarray, lang: np.ndarray) -> pa.Array:
    """The runs of words of one language in each text, as byte ranges."""
    out = []
    for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
        begin, length = runs(lang[a:b])
        out.append(
            [
                {
                    "start": int(words.starts[a + s] - offsets[i]),
                    "end": int(words.ends[a + s + n - 1] - offsets[i]),
                    "lang": str(lang[a + s]),
                }
                for s, n in zip(begin, length, strict=True)
            ]
        )
    return pa.array(out, pa.list_(_SEGMENT))


def _labelled(model: Model, text: pa.Array, letters: np.ndarray, segments: bool = False) -> list[pa.Array]:
    """Language, score and confidence of texts that each end in a line feed; with ``segments``
    also their runs of words of one language."""
    data, offsets = text_bytes(text)
    words = split_words(data, offsets)
    found = model.label(words)
    count = np.diff(words.first)

    def means(values: np.ndarray) -> np.ndarray:
        sums = np.vstack([np.zeros(values.shape[1]), np.cumsum(values, axis=0)])[words.first]
        return np.diff(sums, axis=0) / np.maximum(count, 1)[:, None]

    mean = means(found)
    best = mean.argmax(1)
    names = np.array([*model.labels, UNDETERMINED])
    known = letters & (count > 0)
    sure = means(found.max(1, keepdims=True))[:, 0]
    numbers = (mean[np.arange(len(best)), best], sure)
    out = [pa.array(names[np.where(known, best, -1)].tolist(), pa.string())]
    out += [pa.array(np.where(known, np.clip(n, 0, 1), 0.0)) for n in numbers]
    return out + ([_segments(words, offsets, names[found.argmax(1)])] if segments else [])


def _predict(model: Model, segments: bool, schema: T.StructType) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, size=SLICE_BYTES):
            letters = batch.column("letters").to_numpy(zero_copy_only=False).astype(bool)
            columns = _labelled(model, batch.column("text"), letters, segments)
            del columns[2]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], schema.fieldNames())

    return rows


def _line(text: Column) -> Column:
    """A text with letters, or an empty one, and a line feed."""
    return F.concat(F.coalesce(F.when(has_letters(text), text), F.lit("")), F.lit("\n"))


def language_of(text: Column, model: Model) -> Column:
    """A structure of ``lang_pred``, ``score`` and ``confidence``, the mean over the words of the
    probability of the likeliest language of each. Only the text goes to Python.

    ``lang_pred`` and ``score`` are as in ``identify``; the confidence of ``und`` is 0.
    """
    kind = "lang_pred string, score double, confidence double"
    names = ["lang_pred", "score", "confidence"]
    if not model.labels:
        return F.struct(F.lit(UNDETERMINED).alias(names[0]), *[F.lit(0.0).alias(n) for n in names[1:]])

    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            batch = pa.RecordBatch.from_arrays([texts], ["text"])
            slices = []
            for part in text_slices(iter([batch]), size=SLICE_BYTES):
                lengths = np.diff(text_bytes(part.column("text"))[1])
                columns = _labelled(model, part.column("text"), lengths > 1)
                slices.append(pa.StructArray.from_arrays(columns, names))
            empty = pa.array([], pa.struct([(names[0], pa.string()), *[(n, pa.float64()) for n in names[1:]]]))
            yield pa.concat_arrays(slices or [empty])

    label.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(label, kind)(_line(text))


def identify(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    segments: bool = False,
) -> DataFrame:
    """``id``, ``lang_pred`` and ``score`` of every row; with ``segments`` also the runs of words
    of one language, as byte ranges of the text.

    The score is the mean probability of the predicted language over the words; ties go to the
    first language in order. A null text, one without letters, and any text if nothing was
    learned, is ``und`` with score 0. Texts are processed whole, line by line; rows that repeat
    are each labelled. Only the text column is an input of a prediction.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"), has_letters(text).alias("letters"), _line(text).alias("text")
    )
    fields = [
        rows.schema["id"],
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
    if segments:
        run = "array<struct<start: bigint, end: bigint, lang: string>>"
        fields.append(T.StructField("segments", T._parse_datatype_string(run)))
    schema = T.StructType(fields)
    if not model.labels:
        undetermined = rows.select(
            "id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score")
        )
        none = F.array().cast(fields[-1].dataType).alias("segments")
        return undetermined.select("*", none) if segments else undetermined
    return rows.mapInArrow(_predict(model, segments, schema), schema)
