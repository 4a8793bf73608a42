"""Benchmark decontamination by template windows.

A text becomes three streams of tokens: words or, in scripts without spaces, characters. The
*plain* one has them lower-cased. In the *template* one a number, a name (capitalised words inside
a sentence) and a unit after a number are typed placeholders, so a question with other numbers
and names has the same windows; in the *opening* one capitalised words that open a sentence are
names too. Eight tokens are a window, or up to sixteen where placeholders leave few words in
eight. Windows of the documents are hash-joined with those of the benchmark; a bitmap, made from
all benchmark windows and sized by their number, lets a task drop most of its windows before the
join. A template match also needs consistent slots: along one alignment, equal values of the item
stand for equal values of the document, different ones may become equal, and windows against
the most frequent reading are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uptake.llm.common import bitmap_of, bits_set, power_of_two, stored, text_bytes, text_slices
from uptake.llm.shingles import BLOCK_BYTES, mix, powers

WIDTH = 8
WIDE = 16  # where half of the windows of a template or more have too few words
LEAST_WIDTH = 3  # shorter texts cannot be told from ordinary text and are compared as a whole
LEAST_WORDS = 5  # words, not placeholders, in a wide template window; half of others are words
COVERAGE = 0.5
LONG_RUN = 20  # tokens in a row, found whatever their share of the item
MOST_BROADCAST_WINDOWS = 1 << 20
BITS_A_WINDOW = 64
MOST_BITS = 1 << 28
PLAIN, TEMPLATE, OPENING = 0, 1, 2

# Code points of scripts written without spaces (Thai and Lao, Burmese, Khmer,
# kana, ideographs).
UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF),
            (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]

# Unit words and signs.
UNITS = """% mm cm m km mg g kg t ml l inch inches foot feet yard yards mile miles metre metres meter
meters kilometre kilometres kilometer kilometers gram grams kilogram kilograms ounce ounces oz lb
lbs pound pounds ton tons litre litres liter liters gallon gallons second seconds minute minutes
hour hours day days week weeks month months year years percent degree degrees cent cents dollar
dollars euro euros""".split()

_ENDS_SENTENCE = np.zeros(256, bool)
_ENDS_SENTENCE[list(b".!?:\n\r")] = True
_TOKEN = np.zeros(256, bool)
_TOKEN[[*b"0123456789%", *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[list(b"0123456789")] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True

_MARKS = mix(np.array([101, 102, 103], np.uint64))  # number, name, unit
_PLACES = np.array([pow(0xA24BAED4963EE407, i + 1, 1 << 64) for i in range(WIDE)], np.uint64)


def _lower_case(code: int) -> int:
    """The lower-case letter of a code point if it is one letter of as many bytes."""
    lower = chr(code).lower()
    if len(lower) != 1 or len(lower.encode()) != len(chr(code).encode()):
        return code
    return ord(lower)


# By code point: letters of two bytes, and of three bytes up to U+1FFF.
_LOWER = np.array([c if c < 0x80 else _lower_case(c) for c in range(0x2000)], np.uint16)


class Tokens(NamedTuple):
    """One stream: hashes of the tokens, of the values in slots, which tokens are slots and which
    single characters of a script without spaces, and where each text starts."""

    hashes: np.ndarray
    values: np.ndarray
    slot: np.ndarray
    single: np.ndarray
    first: np.ndarray


def _lower(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters up to U+1FFF, and where a capital one begins."""
    upper = _UPPER[data]
    lower = data + upper.astype(np.uint8) * np.uint8(32)
    two = np.flatnonzero((data[:-1] >= 0xC2) & (data[:-1] <= 0xDF))
    code = (data[two] & np.uint16(0x1F)) << 6 | (data[two + 1] & np.uint16(0x3F))
    low = _LOWER[code]
    capital = low != code
    at, low = two[capital], low[capital]
    upper[at] = True
    lower[at], lower[at + 1] = 0xC0 | low >> 6, 0x80 | low & 0x3F
    three = np.flatnonzero(data[:-2] == 0xE1)
    code = np.uint16(0x1000) | (data[three + 1] & np.uint16(0x3F)) << 6 | (data[three + 2] & np.uint16(0x3F))
    low = _LOWER[code]
    capital = low != code
    at, low = three[capital], low[capital]
    upper[at] = True
    lower[at + 1], lower[at + 2] = 0x80 | low >> 6 & 0x3F, 0x80 | low & 0x3F
    return lower, upper


def _unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every character of a script without spaces."""
    at = np.flatnonzero(data >= 0xE0)
    longer = data[at] >= 0xF0
    at = at[at + 3 + longer <= len(data)]
    longer = data[at] >= 0xF0
    code = data[at].astype(np.int32) & np.where(longer, 0x07, 0x0F)
    for i in (1, 2):
        code = code << 6 | data[at + i] & 0x3F
    code = np.where(longer, code << 6 | data[np.minimum(at + 3, len(data) - 1)] & 0x3F, code)
    chosen = np.zeros(len(at), bool)
    for first, last in UNSPACED:
        chosen |= (code >= first) & (code <= last)
    return at[chosen], at[chosen] + 3 + longer[chosen]


def _spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of letters and digits, and which are single characters of a script
    without spaces; a point or comma between digits joins, a percent sign stands alone."""
    n = len(data)
    inside = _TOKEN[data]
    if n > 2:
        digit = _DIGIT[data]
        mark = (data == ord(".")) | (data == ord(","))
        inside[1:-1] |= mark[1:-1] & digit[:-2] & digit[2:]
    percent = np.flatnonzero(data == ord("%"))
    alone, after = _unspaced(data)
    cut = np.zeros(n + 1, bool)
    cut[percent] = cut[percent + 1] = cut[alone] = cut[after] = True
    before = np.r_[False, inside]
    here = np.r_[inside, False]
    starts = np.flatnonzero(here & (~before | cut))
    ends = np.flatnonzero(before & (~here | cut))
    single = np.zeros(n + 1, bool)
    single[alone] = True
    return starts, ends, single[starts]


def _hashed(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges, block by block; a block ends between two ranges."""
    out = np.empty(len(starts), np.uint64)
    done = 0
    while done < len(starts):
        stop = max(done + 1, int(np.searchsorted(ends, starts[done] + BLOCK_BYTES, "right")))
        a, b = int(starts[done]), int(ends[stop - 1])
        up, down = powers(b - a + 1)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum((lower[a:b].astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        s, e = starts[done:stop] - a, ends[done:stop] - a
        out[done:stop] = mix((total[e] - total[s]) * down[s])
        done = stop
    return out


def _hash_words(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    return np.sort(_hashed(data, starts, ends))


def _template(
    plain: Tokens, number: np.ndarray, name: np.ndarray, unit: np.ndarray, opens: np.ndarray
) -> Tokens:
    """Placeholders for numbers, names and units."""
    slot = number | name | unit
    # Neighbouring names are one name; its value is made of all of them.
    joined = np.zeros(len(slot), bool)
    joined[1:] = name[1:] & name[:-1] & ~opens[1:]
    kept = np.flatnonzero(~joined)
    values = np.add.reduceat(np.where(slot, plain.hashes, 0), kept)
    marks = np.where(number, _MARKS[0], np.where(unit, _MARKS[2], _MARKS[1]))
    masked = np.where(slot, marks, plain.hashes)[kept]
    return Tokens(masked, values, slot[kept], plain.single[kept], np.searchsorted(kept, plain.first))


def streams(data: np.ndarray, offsets: np.ndarray) -> tuple[Tokens, Tokens, Tokens]:
    """The plain, template and opening tokens of texts that each end in a white-space character."""
    starts, ends, single = _spans(data)
    lower, upper = _lower(data)
    hashes = _hashed(lower, starts, ends)
    first = np.searchsorted(starts, offsets)
    n = len(starts)
    plain = Tokens(hashes, np.zeros(n, np.uint64), np.zeros(n, bool), single, first)
    if not n:
        return plain, plain, plain

    opens = np.zeros(n, bool)  # first token of a text
    opens[first[:-1][first[:-1] < first[1:]]] = True
    stops = np.r_[np.int32(0), np.cumsum(_ENDS_SENTENCE[data], dtype=np.int32)]
    after_stop = opens.copy()
    after_stop[1:] |= stops[starts[1:]] > stops[ends[:-1]]
    number = _DIGIT[data[starts]]
    unit = np.zeros(n, bool)
    unit[1:] = number[:-1] & ~opens[1:] & np.isin(hashes[1:], _UNIT_HASHES)
    capital = upper[starts] & ~unit
    return (
        plain,
        _template(plain, number, capital & ~after_stop, unit, opens),
        _template(plain, number, capital, unit, opens),
    )


def windows(tokens: Tokens, width: int, kind: int, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of the windows of ``width`` tokens that lie within one text.

    Those that are too narrow to say much, of less than three words or with single characters,
    are whole texts only. Half of a template window that is not wide has to be words.
    """
    n = len(tokens.hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    rolled = np.full(n, kind * 32 + width, np.uint64)
    for i in range(width):
        rolled += tokens.hashes[i : i + n] * _PLACES[i]
    text = np.searchsorted(tokens.first, np.arange(len(tokens.hashes)), "right")
    fits = text[:n] == text[width - 1 :]
    if width < WIDTH:
        narrow = np.full(n, width < LEAST_WIDTH)
        singles = np.r_[0, np.cumsum(tokens.single)]
        narrow |= singles[width:] > singles[:-width]
        fits &= ~narrow | (np.diff(tokens.first)[text[:n] - 1] == width)
    if kind != PLAIN:
        slots = np.r_[0, np.cumsum(tokens.slot)]
        held = slots[width:] - slots[:-width]
        fits &= width - held >= (least_words if width > WIDTH else (width + 1) // 2)
    at = np.flatnonzero(fits)
    return at, mix(rolled[at])


_UNIT_HASHES = _hash_words(UNITS)

_WINDOW = T.StructType(
    [T.StructField(c, t) for c, t in (
        ("kind", T.IntegerType()), ("width", T.IntegerType()), ("window", T.LongType()),
        ("place", T.LongType()), ("slots", T.ArrayType(T.LongType())),
    )]
)


def _item_windows(streamed: tuple[Tokens, ...], kind: int):
    """Width, starts and hashes of the windows that stand for each text of the benchmark."""
    tokens = streamed[kind]
    sizes = np.diff(tokens.first)
    slots = np.r_[0, np.cumsum(tokens.slot)][tokens.first]
    held = np.diff(slots)
    if kind == PLAIN:
        wanted = sizes > 0
    elif kind == TEMPLATE:  # without a slot the plain windows say the same
        wanted = held > 0
    else:  # and without another name the template does
        template = streamed[TEMPLATE]
        wanted = held > np.diff(np.r_[0, np.cumsum(template.slot)][template.first])
        wanted |= sizes != np.diff(template.first)
    width = np.minimum(sizes, WIDTH)
    if kind != PLAIN:
        at, _ = windows(tokens, WIDTH, kind, LEAST_WORDS)
        enough = np.bincount(np.searchsorted(tokens.first, at, "right") - 1, minlength=len(sizes))
        dense = (sizes > WIDTH) & (2 * enough < sizes - WIDTH + 1)
        width = np.where(dense, np.minimum(sizes, WIDE), width)
    for w in np.unique(width[wanted]).tolist():
        at, hashes = windows(tokens, w, kind, LEAST_WORDS)
        text = np.searchsorted(tokens.first, at, "right") - 1
        chosen = wanted[text] & (width[text] == w)
        yield w, at[chosen], hashes[chosen]


def _cut(ids: list[str], sought: list[tuple[int, int]] | None, bitmap: np.ndarray | None) -> Callable:
    """Arrow batches of texts to rows of windows.

    Without ``sought`` they are those of the benchmark, where a text shorter than a window is one
    window. For documents the windows of all kinds and widths ``sought`` are looked up in the
    bitmap.
    """

    def found(streamed: tuple[Tokens, ...]):
        if sought is None:
            for kind in range(len(streamed)):
                for window in _item_windows(streamed, kind):
                    yield kind, *window
            return
        for kind, width in sought:
            at, hashes = windows(streamed[kind], width, kind, LEAST_WORDS)
            chosen = bits_set(bitmap, hashes)
            yield kind, width, at[chosen], hashes[chosen]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            streamed = streams(*text_bytes(batch.column("text")))
            for kind, width, at, hashes in found(streamed):
                if not len(at):
                    continue
                tokens = streamed[kind]
                text = np.searchsorted(tokens.first, at, "right") - 1
                slots = [
                    tokens.values[a : a + width][tokens.slot[a : a + width]].view(np.int64)
                    for a in at.tolist()
                ]
                taken = batch.select(ids).take(pa.array(text))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[taken.column(c) for c in ids],
                        pa.array(np.full(len(at), kind, np.int32)),
                        pa.array(np.full(len(at), width, np.int32)),
                        pa.array(hashes.view(np.int64)),
                        pa.array(at - tokens.first[text]),
                        pa.array(slots, pa.list_(pa.int64())),
                    ],
                    names=[*ids, *_WINDOW.names],
                )

    return rows


def _windows(texts: DataFrame, ids: list[str], sought=None, bitmap=None) -> DataFrame:
    schema = T.StructType([*texts.select(*ids).schema.fields, *_WINDOW.fields])
    return texts.mapInArrow(_cut(ids, sought, bitmap), schema)


_ALONG = ["row", "item", "kind", "shift"]  # one alignment of an item


def _agreeing(hits: DataFrame) -> DataFrame:
    """The hits in which every value of the item stands for the value that it has most often along
    the alignment, ties to the larger hash."""
    slots = hits.select(*_ALONG, "nth", F.inline("pairs"))
    counted = slots.groupBy(*_ALONG, "item_value", "doc_value").agg(F.count(F.lit(1)).alias("n"))
    read = counted.groupBy(*_ALONG, "item_value").agg(
        F.max(F.struct("n", "doc_value"))["doc_value"].alias("read"), F.count(F.lit(1)).alias("readings")
    )
    read = read.where("readings > 1").drop("readings")
    against = slots.join(read, [*_ALONG, "item_value"]).where("doc_value <> read")
    return hits.join(against.select(*_ALONG, "nth").distinct(), [*_ALONG, "nth"], "left_anti")


def _longest_run(numbers: str):
    """The length of the longest run of consecutive numbers in a sorted array."""
    zero = F.lit(0).cast("long")
    start = F.struct(F.lit(-1).cast("long").alias("last"), zero.alias("run"), zero.alias("best"))

    def step(so_far, number):
        run = F.when(number == so_far["last"] + 1, so_far["run"] + 1).otherwise(F.lit(1).cast("long"))
        best = F.greatest(so_far["best"], run)
        return F.struct(number.alias("last"), run.alias("run"), best.alias("best"))

    return F.aggregate(numbers, start, step, lambda x: x["best"])


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    coverage: float = COVERAGE,
    long_run: int = LONG_RUN,
) -> DataFrame:
    """``id``, ``row``, ``item_id``, ``windows`` of the item, ``matched`` of them, ``coverage``,
    ``exact`` and ``run`` of every document row that has ``coverage`` of an item's windows or more,
    or ``long_run`` tokens of it in a row.

    ``exact`` tells a copy in the item's own words from one with other numbers, names or units;
    of these the largest coverage counts. ``run`` is the most windows that follow one another,
    among the different ones of the item, along an alignment. ``row`` tells rows with a null
    or repeated id apart. Null and empty texts and items match nothing. An item of fewer than eight
    tokens is one window; one of fewer than three, or of fewer than eight with characters of a
    script without spaces, matches whole texts only. Items that repeat are matched each. Texts are
    processed whole. Other columns are not looked at.
    """
    space = F.lit(" ")
    items = benchmark.select(
        F.col(item_id_col).alias("item_id"),
        F.monotonically_increasing_id().alias("item"),
        F.concat(F.coalesce(F.col(item_text_col), F.lit("")), space).alias("text"),
    )
    # A window that an item repeats counts once, where the item first has it.
    first = Window.partitionBy("item", "kind", "window").orderBy("place")
    order = Window.partitionBy("item", "kind").orderBy("place")
    items = _windows(items, ["item_id", "item"]).withColumn("nth", F.row_number().over(first))
    items = items.where("nth = 1").withColumn("nth", F.row_number().over(order).cast("long"))
    items = stored(items, "benchmark-windows")
    totals = items.groupBy("item", "kind").agg(F.count(F.lit(1)).alias("windows"))
    sought = sorted((r["kind"], r["width"]) for r in items.select("kind", "width").distinct().collect())
    n = items.count()
    if n <= MOST_BROADCAST_WINDOWS:
        items, totals = F.broadcast(items), F.broadcast(totals)
    bits = min(max(power_of_two(BITS_A_WINDOW * n), 1 << 15), MOST_BITS)
    found = _windows(
        docs.select(
            F.col(id_col).alias("id"),
            F.monotonically_increasing_id().alias("row"),
            F.concat(F.coalesce(F.col(text_col), F.lit("")), space).alias("text"),
        ),
        ["id", "row"],
        sought,
        bitmap_of(items, "window", bits),
    )
    found = found.withColumnsRenamed({"place": "at", "slots": "doc_slots"})
    pairs = F.arrays_zip(F.col("slots").alias("item_value"), F.col("doc_slots").alias("doc_value"))
    hits = found.join(items, ["kind", "width", "window"]).select(
        "id", "row", "item_id", "item", "kind", "width", "nth",
        (F.col("at") - F.col("place")).alias("shift"), pairs.alias("pairs"),
    )
    hits = stored(hits, "benchmark-hits")  # texts are cut once, and rows keep their numbers
    aligned = _agreeing(hits).groupBy("id", "item_id", *_ALONG).agg(
        F.array_sort(F.collect_set("nth")).alias("places"), F.max("width").alias("width")
    )
    aligned = aligned.withColumn("run", _longest_run("places"))
    matched = (
        aligned
        .groupBy("id", "row", "item_id", "item", "kind")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("matched"),
            F.max("run").alias("run"), F.max("width").alias("width"),
        )
        .join(totals, ["item", "kind"])
        .withColumn("coverage", F.col("matched") / F.col("windows"))
        .where((F.col("coverage") >= coverage) | (F.col("run") + F.col("width") - 1 >= long_run))
    )
    exact = (F.col("kind") == PLAIN).alias("exact")
    best = F.max(F.struct("coverage", exact, "matched", "windows", "run"))
    return matched.groupBy("id", "row", "item_id", "item").agg(best.alias("best")).select(
        "id", "row", "item_id", "best.windows", "best.matched", "best.coverage", "best.exact", "best.run"
    )
