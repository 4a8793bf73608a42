"""Personal data: fixed patterns, and terms that give away a protected value.

The base patterns find e-mail and IP addresses, card and phone numbers. Their values are the
protected entities. A corpus-wide co-occurrence then estimates what other words reveal of them: the
pointwise mutual information of a word t and an entity e is log(n(e,t) N / (n(e) n(t))) over rows,
the information of the entity itself is log(N / n(e)). A word discloses an entity if the first
reaches 1 / alpha of the second, and if that is more than chance: a bound on the probability that
so many different texts of the entity hold an independent word of the same frequency, times the
number of words and entities of the corpus, is at most ``CHANCE``. A word seen with a value in one
text only is never more than chance, as every text has words of its own. Found values, and
disclosing words in texts that hold the entity, are generalised to their kind.

Counts cover all rows. Words are counted per task before they are shuffled, so frequent words and
copies cost one row a task. Only entities in enough texts for a significant pair, and words in at
most n(e)^(1/alpha) N^(1 - 1/alpha) rows, meet; entities that are in the same texts have the same
counts with every word and are judged as one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uptake.llm.common import (
    BITMAP_BITS, bitmap_of, bits_set, power_of_two, stored, text_bytes, text_slices,
)
from uptake.llm.language_crf import Words, split_words

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
ALPHA = 1.1
CHANCE = 0.01  # expected number of pairs that pass by chance, at most
HOT_SHARE = 1 / 256  # words in a larger share of the rows are dropped before a shuffle
MOST_BITS = 1 << 28
BITS_PER_TERM = 64
UPPER = 32  # lower bits of a hash that the second bitmap skips

# Runs are entered at their start only: a value that fails from there fails from inside as well.
_EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_EMAIL_HERE, _EMAIL_NEXT = re.compile(_EMAIL), re.compile(rf"(?<![A-Za-z0-9._%+-]){_EMAIL}")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile("[^0-9]")
MAY_HAVE_VALUES = r"[0-9@]"

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while text.find("@", at) >= 0:
        match = _EMAIL_HERE.match(text, at) or _EMAIL_NEXT.search(text, at)
        if match is None:
            return
        yield match.span()
        at = match.end()


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The values of a text by kind and place; code points, end exclusive."""
    found = [("email", *span) for span in _emails(text)]
    for m in _IP.finditer(text):
        parts = [part.lstrip("0") for part in m[0].split(".")]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 2 * 19:
            digits = _NO_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def entity(kind: str, value: str) -> int:
    """A number for a value: e-mail in lower case, otherwise its digits, parted as in an IP."""
    if kind == "email":
        plain = value.lower()
    else:
        plain = re.sub("[^0-9.]" if kind == "ip" else "[^0-9]", "", value)
    return xxhash.xxh64_intdigest(f"{kind}:{plain}") - (1 << 63)


def text_key(text: Column) -> Column:
    """128 bits that name a text."""
    return F.concat(F.hex(F.xxhash64(F.lit(1), text)), F.hex(F.xxhash64(F.lit(2), text)))


def _byte_places(text: str, places: Sequence[int]) -> list[int]:
    return list(places) if text.isascii() else [len(text[:p].encode()) for p in places]


def _free_words(words: Words, taken: Sequence[tuple[int, int]]) -> np.ndarray:
    """Whether each word of one text lies outside all byte ranges."""
    free = np.ones(len(words.starts), bool)
    for a, b in taken:
        free[np.searchsorted(words.ends, a, "right") : np.searchsorted(words.starts, b)] = False
    return free


def _occurrences(bitmap: np.ndarray, upper: np.ndarray) -> Callable:
    """Code-point ranges of the words of both bitmaps, that of the hashes and that of their upper
    bits, that are no part of a value."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            data, offsets = text_bytes(batch.column("text"))
            words = split_words(data, offsets)
            at = np.flatnonzero(bits_set(bitmap, words.hashes))
            at = at[bits_set(upper, words.hashes[at] >> np.uint64(UPPER))]
            if not len(at):
                continue
            text = np.searchsorted(words.first, at, "right") - 1
            points = np.r_[0, np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)]
            start = points[words.starts[at]] - points[offsets[text]]
            end = points[words.ends[at]] - points[offsets[text]]
            free = np.ones(len(at), bool)
            for i in np.unique(text).tolist():
                own = np.flatnonzero(text == i)
                for _, a, b in base_spans(batch.column("text")[i].as_py()):
                    free[own[(start[own] < b) & (end[own] > a)]] = False
            at, text, start, end = at[free], text[free], start[free], end[free]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(pa.array(text)), pa.array(words.hashes[at].view(np.int64)),
                    pa.array(start), pa.array(end),
                ],
                names=["key", "term", "start", "end"],
            )

    return rows


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(text_key(text).alias("key"), text.alias("text"))


def _row_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different entities of each text."""
    for batch in text_slices(batches):
        keys, entities = [], []
        for key, text in zip(*(batch.column(c).to_pylist() for c in ("key", "text")), strict=True):
            own = {entity(kind, text[a:b]) for kind, a, b in base_spans(text)}
            keys += [key] * len(own)
            entities += own
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array(entities, pa.int64())], names=["key", "entity"]
        )


def _row_words(hot: np.ndarray) -> Callable:
    """The different words of each text with values, outside them and without the ``hot`` ones;
    a text that a task has met before is left out."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = set()
        for batch in text_slices(batches):
            for key, text in zip(*(batch.column(c).to_pylist() for c in ("key", "text")), strict=True):
                spans = () if key in met else base_spans(text)
                if not spans:
                    continue
                met.add(key)
                words = split_words(*text_bytes(pa.array([text + "\n"])))
                free = _free_words(words, sorted(tuple(_byte_places(text, s[1:])) for s in spans))
                terms = np.unique(words.hashes[free].view(np.int64))
                terms = terms[~np.isin(terms, hot)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(terms), pa.string()), pa.array(terms)], names=["key", "term"]
                )

    return rows


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many rows of a slice each word occurs."""
    for batch in text_slices(batches):
        words = split_words(*text_bytes(batch.column("text")))
        if not len(words.hashes):
            continue
        text = np.searchsorted(words.first, np.arange(len(words.hashes)), "right")
        order = np.argsort(words.hashes, kind="stable")  # by text within a word
        hashes, text = words.hashes[order], text[order]
        begins = np.r_[True, hashes[1:] != hashes[:-1]]
        counted = begins | np.r_[True, text[1:] != text[:-1]]
        first = np.flatnonzero(begins)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes[first].view(np.int64)),
             pa.array(np.add.reduceat(counted.astype(np.int64), first))],
            names=["term", "rows"],
        )


def chance(texts: Column, entity_texts: Column, term_rows: Column, total_texts: int) -> Column:
    """The logarithm of a bound on the probability that ``texts`` or more of the texts of an
    independent word, at most ``term_rows``, are among those of the entity: (n choose x) p ** x
    with (n choose x) <= (e n / x) ** x."""
    return texts * (F.log(entity_texts / total_texts) + F.log(term_rows / texts) + 1)


def disclosing_terms(docs: DataFrame, text_col: str = "text", alpha: float = ALPHA) -> DataFrame:
    """The words, as hashes, that disclose an entity of their text: ``key`` (of the text) and
    ``term``, each pair once. ``alpha`` is at least 1; a larger one finds more words."""
    if alpha < 1:
        raise ValueError("alpha is 1 or more")
    texts = _texts(docs, text_col)
    with_values = texts.where(F.col("text").rlike(MAY_HAVE_VALUES))
    total, total_texts = docs.count(), max(1, texts.select("key").distinct().count())
    values = with_values.mapInArrow(_row_values, "key string, entity long")
    values = stored(values.groupBy("key", "entity").agg(F.count(F.lit(1)).alias("rows")), "row-values")
    # Entities with the same set of texts: the first stands for all.
    sums = [F.sum(F.xxhash64(F.lit(i), "key").cast("decimal(38,0)")).alias(f"s{i}") for i in (1, 2)]
    entities = values.groupBy("entity").agg(
        F.sum("rows").alias("entity_rows"), F.count(F.lit(1)).alias("texts"), *sums
    )
    entities = entities.groupBy("s1", "s2", "entity_rows", "texts").agg(
        F.min("entity").alias("entity"), F.count(F.lit(1)).alias("same")
    )
    entities = stored(entities.drop("s1", "s2"), "entities")

    lines = texts.select(F.concat("text", F.lit("\n")).alias("text"))
    counts = lines.mapInArrow(_word_rows, "term long, rows long").groupBy("term")
    counts = stored(counts.agg(F.sum("rows").alias("term_rows")), "word-rows")
    tests = counts.count() * (entities.agg(F.sum("same")).first()[0] or 0)
    limit = math.log(CHANCE / max(1, tests))
    share = F.pow(F.col("entity_rows") / max(1, total), F.lit(1 - 1 / alpha))
    able = chance(F.col("texts"), F.col("texts"), F.col("texts"), total_texts) <= limit
    judged = entities.where(able).withColumn("least", share)
    known = values.join(judged, "entity").select(
        "key", "entity", "rows", "least", F.col("texts").alias("entity_texts"),
        (F.col("entity_rows") / share + 1e-6).alias("most"),
    )
    known = stored(known, "row-entities")
    most = known.agg(F.max("most")).first()[0] or 0.0

    hot = counts.where(F.col("term_rows") > max(most, HOT_SHARE * total)).select("term").collect()
    of_interest = known.select("key").distinct()
    words = with_values.join(of_interest, "key", "left_semi").mapInArrow(
        _row_words(np.array([r["term"] for r in hot], np.int64)), "key string, term long"
    )
    rare = words.join(counts.where(F.col("term_rows") <= most), "term").distinct()
    pairs = stored(rare.join(known, "key").where(F.col("term_rows") <= F.col("most")), "row-pairs")
    together = pairs.groupBy("entity", "term").agg(
        F.sum("rows").alias("together"), F.count(F.lit(1)).alias("texts"),
        F.max("term_rows").alias("term_rows"), F.max("least").alias("least"),
        F.max("entity_texts").alias("entity_texts"),
    )
    reached = F.col("together") / F.col("term_rows") >= F.col("least")
    significant = chance(F.col("texts"), F.col("entity_texts"), F.col("term_rows"), total_texts) <= limit
    disclosed = together.where(reached & significant).select("entity", "term")
    found = pairs.join(disclosed, ["entity", "term"]).select("key", "term").distinct()
    return stored(found, "disclosing-terms")


_SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
     T.StructField("end", T.LongType())]
)
_SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _base_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        spans = [
            [{"kind": k, "start": a, "end": b} for k, a, b in base_spans(text)]
            for text in batch.column("text").to_pylist()
        ]
        kept = [batch.column(c) for c in ("id", "key")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(spans, _SPAN_ARROW)], names=["id", "key", "base"]
        )


def _term_spans(docs: DataFrame, terms: DataFrame, text_col: str) -> DataFrame:
    """``key`` of a text and the places of its disclosing words."""
    texts = _texts(docs, text_col).where(F.col("text").rlike(MAY_HAVE_VALUES))
    lines = texts.select("key", F.concat("text", F.lit("\n")).alias("text"))
    bits = min(MOST_BITS, max(BITMAP_BITS, power_of_two(BITS_PER_TERM * terms.count())))
    skipped = terms.select(F.shiftrightunsigned("term", UPPER).alias("upper"))
    found = lines.mapInArrow(
        _occurrences(bitmap_of(terms, "term", bits), bitmap_of(skipped, "upper", bits)),
        "key string, term long, start long, end long",
    )
    spans = found.join(terms, ["key", "term"], "left_semi").select("key", "start", "end").distinct()
    span = F.struct(F.lit(TERM).alias("kind"), "start", "end")
    spans = spans.groupBy("key").agg(F.array_sort(F.collect_list(span)).alias("terms"))
    return stored(spans, "term-spans")  # so a join with many copies of a text can be split


def find_spans(
    docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id``, ``base`` and ``terms`` of every row: arrays of (``kind``, ``start``, ``end``), in
    code points with the end exclusive, ``base`` by kind and place, ``terms`` by place.

    A null text is empty and an empty text has no spans. Rows that repeat have their spans each.
    Texts are processed whole. Other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        text_key(text).alias("key"),
        F.when(text.rlike(MAY_HAVE_VALUES), text).otherwise("").alias("text"),
    )
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("base", T.ArrayType(_SPAN))])
    base = rows.mapInArrow(_base_rows, schema)
    none = F.array().cast(T.ArrayType(_SPAN))
    return base.join(_term_spans(docs, terms, text_col), "key", "left").select(
        "id", "base", F.coalesce("terms", none).alias("terms")
    )


def generalised(text: str, spans: Sequence[Span]) -> str:
    """The text with every span replaced by its kind in brackets; of spans that overlap, the
    whole range gets the first one's kind."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, terms: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns, values and disclosing words of the text generalised to their kind.

    A null text stays null. Other columns may have any names.
    """
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    text = F.col(text_col)
    keyed = docs.select(text_key(F.coalesce(text, F.lit(""))).alias("key"), text.alias("text"), row)
    marked = keyed.join(_term_spans(docs, terms, text_col), "key", "left")

    def clean(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, terms in batches:
            out = []
            for text, own in zip(texts.to_pylist(), terms.to_pylist(), strict=True):
                if text is not None:
                    found = [(s["kind"], s["start"], s["end"]) for s in own or ()]
                    text = generalised(text, base_spans(text) + found)
                out.append(text)
            yield pa.array(out, pa.string())

    clean.__annotations__ = {
        "batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]
    }
    with_values = F.when(F.col("text").rlike(MAY_HAVE_VALUES), F.col("text"))
    text = F.coalesce(F.arrow_udf(clean, "string")(with_values, F.col("terms")), F.col("text"))
    return marked.select(
        *[(text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns]
    )
