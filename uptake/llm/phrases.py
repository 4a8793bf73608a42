"""Collocations by dynamic itemset counting.

Documents are dealt into shards, which are scanned in a cycle. Words are counted from the first
shard on. A longer phrase is active once both phrases of one word less inside it have reached the
threshold in what has been counted so far; it is counted from the next shard on, while shorter
and longer ones are, until each of its shards has been scanned once. Scanning ends when no phrase
is active. A phrase at the threshold has both of its parts at the threshold, so none is missed,
and all counts of the result are exact.

A scan looks at every pair of words, but only a few can reach the threshold. Two filters, which
let through more than needed and never less, spare the rest: a bitmap of phrases that have reached
the threshold, and one of the hashed word pairs whose number, all pairs of one hash together,
reaches it, from a pass over all documents before the cycle. What they let through is counted and
then held against the real phrases by joins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uptake.llm.common import bitmaps_of, bits_set, power_of_two, stored, text_bytes
from uptake.llm.shingles import mix, powers

SHARDS = 3
LEAST_COUNT = 100
MOST_WORDS = 5
NO_LANGUAGE = "und"
WINDOW_BYTES = 2 << 20  # of text that is split into words at once
MOST_BITS = 1 << 28  # of a bitmap, 32 MB
PAIRS_PER_BIT = 24  # word occurrences; far fewer than the threshold share a hash by chance
PAIR_BLOCK = 1 << 16

_SPACE = pa.scalar(" ", pa.large_string())
_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_OUTSIDE = _BREAK.copy()
_OUTSIDE[list(b" \t")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _windows(data: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``size`` bytes that end behind a break; the last byte is one."""
    begin = 0
    while begin < len(data):
        end = min(begin + size, len(data))
        if end < len(data):
            breaks = np.flatnonzero(_BREAK[data[begin:end]])
            while not len(breaks):
                more = data[end : end + size]
                breaks = np.flatnonzero(_BREAK[more]) + (end - begin)
                end += len(more)
            end = begin + int(breaks[-1]) + 1
        yield begin, end
        begin = end


class Words:
    """The words of a stretch of text: ``word`` (a number for each different one), ``piece`` and
    ``lang`` (a number) of every occurrence, and ``hashes`` of language and word."""

    def __init__(self, data: np.ndarray, doc_ends: np.ndarray, langs: np.ndarray, salts: np.ndarray):
        data = _LOWER[data]
        outside = _OUTSIDE[data]
        edges = np.flatnonzero(np.diff(np.r_[True, outside, True].view(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        self.piece = np.cumsum(_BREAK[data], dtype=np.int32)[starts]
        self.lang = langs[np.searchsorted(doc_ends, starts, "right")]
        offsets = np.r_[0, np.cumsum(ends - starts)]
        inside = data[~outside]
        text = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(inside))
        ).dictionary_encode()
        self.word = text.indices.to_numpy().astype(np.int64)
        self.names = text.dictionary.cast(pa.large_string())
        self.hashes = self._hashes()[self.word] ^ salts[self.lang]

    def _hashes(self) -> np.ndarray:
        data, offsets = text_bytes(self.names)
        up, down = powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        return mix((total[offsets[1:]] - total[offsets[:-1]]) * down[offsets[:-1]])

    def __len__(self) -> int:
        return len(self.word)


def longer_hash(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from those of all its words but the last, and of the last."""
    return mix(prefix * np.uint64(0xA24BAED4963EE407) + word)


def _salts(langs: list[str]) -> np.ndarray:
    names = pa.array(langs, pa.large_string())
    data, offsets = text_bytes(names)
    return np.array(
        [mix(np.array([_fold(data[a:b].tobytes())], np.uint64))[0] for a, b in zip(offsets[:-1], offsets[1:], strict=True)],
        np.uint64,
    )


def _fold(name: bytes) -> int:
    value = len(name)
    for byte in name:
        value = (value * 0x100000001B3 + byte + 1) & ((1 << 64) - 1)
    return value


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, pa.Array]]:
    """The words of batches with ``lang`` and ``text``, which ends in a break; and the languages."""
    for batch in batches:
        if not batch.num_rows:
            continue
        coded = batch["lang"].dictionary_encode()
        codes, salts = coded.indices.to_numpy(), _salts(coded.dictionary.to_pylist())
        data, offsets = text_bytes(batch["text"])
        for begin, end in _windows(data, WINDOW_BYTES):
            a = int(np.searchsorted(offsets, begin, "right")) - 1
            b = int(np.searchsorted(offsets, end, "left"))
            words = Words(data[begin:end], offsets[a + 1 : b + 1] - begin, codes[a:b], salts)
            if len(words):
                yield words, coded.dictionary


def _pair_counts(bits: int) -> Callable:
    """How often each hash of a word pair occurs, in blocks of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, _ in _words(batches):
            inside = words.piece[:-1] == words.piece[1:]
            pairs = longer_hash(words.hashes[:-1][inside], words.hashes[1:][inside])
            hashed, counts = np.unique(pairs & np.uint64(bits - 1), return_counts=True)
            hashed = hashed.astype(np.int64)
            blocks, first = np.unique(hashed // PAIR_BLOCK, return_index=True)
            cuts = np.r_[first, len(hashed)]
            rows = range(len(blocks))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(blocks),
                    pa.array([(hashed[cuts[i] : cuts[i + 1]] % PAIR_BLOCK).astype("<u2").tobytes() for i in rows], pa.binary()),
                    pa.array([np.minimum(counts[cuts[i] : cuts[i + 1]], 65535).astype("<u2").tobytes() for i in rows], pa.binary()),
                ],
                ["block", "place", "n"],
            )

    return run


def _frequent_bits(least: int) -> Callable:
    """Sums the counts of each block, which come together, to one bit per hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = None, np.zeros(PAIR_BLOCK, np.int64)

        def done() -> pa.RecordBatch:
            bits = np.packbits(total >= least, bitorder="little").tobytes()
            return pa.RecordBatch.from_pydict({"block": [block], "bits": [bits]})

        for batch in batches:
            for b, place, n in zip(*batch.to_pydict().values(), strict=True):
                if b != block:
                    if block is not None:
                        yield done()
                    block, total = b, np.zeros(PAIR_BLOCK, np.int64)
                total[np.frombuffer(place, "<u2")] += np.frombuffer(n, "<u2")
        if block is not None:
            yield done()

    return run


def pair_bitmap(docs: DataFrame, least: int, occurrences: int) -> np.ndarray:
    """A bit for every hash of a word pair that occurs ``least`` times or more. It has a bit for
    ``PAIRS_PER_BIT`` words, 32 MB at most; above that it lets through more pairs."""
    bits = max(PAIR_BLOCK, min(MOST_BITS, power_of_two(occurrences / PAIRS_PER_BIT)))
    counted = docs.select("lang", "text").mapInArrow(
        _pair_counts(bits), "block bigint, place binary, n binary"
    )
    frequent = (
        counted.repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(_frequent_bits(least), "block bigint, bits binary")
    )
    whole = np.zeros(bits // 8, np.uint8)
    for row in frequent.collect():
        begin = row["block"] * PAIR_BLOCK // 8
        whole[begin : begin + PAIR_BLOCK // 8] = np.frombuffer(row["bits"], np.uint8)
    return whole


class Filters:
    """What a scan may skip: bitmaps of the phrases that have reached the threshold, of those
    of them that did so during the last cycle, and of word pairs that may."""

    def __init__(self, reached: np.ndarray, recent: np.ndarray, pairs: np.ndarray):
        self.reached, self.recent, self.pairs = reached, recent, pairs


def _scan(count_words: bool, filters: Filters | None, most_words: int) -> Callable:
    """Counts of words and of phrases that may be active."""

    def counted(words: Words, langs: pa.Array, k: int, at: np.ndarray, name: np.ndarray):
        """A row for each different name, from the places of the occurrences."""
        _, first, counts = np.unique(name, return_index=True, return_counts=True)
        first = at[first]
        parts = [words.names.take(pa.array(words.word[first + i])) for i in range(k)]
        phrase = parts[0] if k == 1 else pc.binary_join_element_wise(*parts, _SPACE)
        return pa.RecordBatch.from_arrays(
            [
                langs.take(pa.array(words.lang[first])),
                pa.array(np.full(len(first), k, np.int32)),
                phrase.cast(pa.string()),
                pa.array(counts.astype(np.int64)),
            ],
            ["lang", "k", "phrase", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, langs in _words(batches):
            size = len(words.names)
            name = words.word + words.lang.astype(np.int64) * size
            places = np.arange(len(words))
            if count_words:
                yield counted(words, langs, 1, places, name)
            if filters is None:
                continue
            hashes = words.hashes
            reached = bits_set(filters.reached, hashes)
            at, hashes, name = places[reached], hashes[reached], name[reached]
            recent = bits_set(filters.recent, hashes)
            # at: where the phrases of k - 1 words that have reached the threshold begin
            for k in range(2, most_words + 1):
                next_to = at[:-1] + 1 == at[1:]
                pair = np.flatnonzero(next_to)
                pair = pair[words.piece[at[pair]] == words.piece[at[pair] + k - 1]]
                whole = longer_hash(hashes[pair], words.hashes[at[pair] + k - 1])
                if k == 2:
                    kept = bits_set(filters.pairs, whole)
                    pair, whole = pair[kept], whole[kept]
                # The same prefix and the same last word: the same phrase, numbered anew.
                own = np.unique(name[pair], return_inverse=True)[1] * np.int64(size)
                own = np.unique(own + words.word[at[pair] + k - 1], return_inverse=True)[1]
                active = recent[pair] | recent[pair + 1]
                if active.any():
                    yield counted(words, langs, k, at[pair][active], own[active])
                reached = bits_set(filters.reached, whole)
                at, hashes, name = at[pair][reached], whole[reached], own[reached]
                recent = bits_set(filters.recent, hashes)

    return run


def _hash_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the hash of each phrase; ``text`` is the phrase and a line break."""
    for batch in batches:
        hashes = [np.empty(0, np.uint64)]
        for words, _ in _words(iter([batch])):
            first = np.flatnonzero(np.r_[True, words.piece[1:] != words.piece[:-1]])
            size = np.diff(np.r_[first, len(words)])
            hashed = words.hashes[first]
            for k in range(1, int(size.max())):
                more = size > k
                hashed[more] = longer_hash(hashed[more], words.hashes[first[more] + k])
            hashes.append(hashed)
        hashed = pa.array(np.concatenate(hashes).view(np.int64))
        yield pa.RecordBatch.from_arrays([hashed, batch["recent"]], ["hash", "recent"])


def _filters(state: DataFrame, pairs: np.ndarray, step: int, shards: int) -> Filters | None:
    """For the next step; None if no phrase can be active any more."""
    reached = state.where("since IS NOT NULL").select(
        "lang",
        F.concat("phrase", F.lit("\n")).alias("text"),
        (F.col("since") + shards > step).alias("recent"),
    )
    n, n_recent = reached.agg(F.count(F.lit(1)), F.count_if("recent")).first()
    if not n_recent:
        return None
    bits = max(1 << 18, min(MOST_BITS, power_of_two(16 * n)))
    hashed = reached.mapInArrow(_hash_phrases, "hash bigint, recent boolean")
    whole, recent = bitmaps_of(hashed, "hash", bits, [F.lit(True), F.col("recent")])
    return Filters(whole, recent, pairs)


def _prefix() -> Column:
    return F.expr("substring_index(phrase, ' ', k - 1)")


def _suffix() -> Column:
    return F.expr("substring(phrase, length(substring_index(phrase, ' ', 1)) + 2)")


def count_phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST_COUNT,
    most_words: int = MOST_WORDS,
    shards: int = SHARDS,
) -> tuple[DataFrame, DataFrame]:
    """``lang``, ``k``, ``phrase`` and ``n`` of all phrases of at most ``most_words`` words that
    occur ``least`` times or more in a language; and ``lang`` and ``words``, the number of all its
    words.

    A-Z are lower-cased. Texts are split at ``. , ; : ! ?`` and line breaks into pieces, and these
    into words at spaces and tabs; a phrase is a run of words inside a piece, joined by spaces, and
    overlapping occurrences all count. A null text is empty, a null language is ``und``. Repeated
    rows count like any other; other columns are not looked at; no words give no rows.
    """
    rows = docs.select(
        F.coalesce(F.col(lang_col), F.lit(NO_LANGUAGE)).alias("lang"),
        F.concat(F.coalesce(text_col, F.lit("")), F.lit("\n")).alias("text"),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int").alias("shard"),
    )
    rows = stored(rows, "shards", partition_by=["shard"])
    occurrences = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    pairs = pair_bitmap(rows, least, occurrences // 5)
    key = ["lang", "k", "phrase"]
    state, totals, filters = None, None, None
    step = 0
    while step < shards or filters is not None:
        shard = rows.where(F.col("shard") == step % shards).select("lang", "text")
        raw = shard.mapInArrow(
            _scan(step < shards, filters, most_words), "lang string, k int, phrase string, n bigint"
        )
        # Stored, as the words and the longer phrases each take theirs: texts are scanned once.
        counts = stored(raw.groupBy(key).agg(F.sum("n").alias("n")), "shard-counts")
        counts = _active(counts, state, step, shards).withColumn("since", F.lit(None).cast("int"))
        if state is not None:
            counts = state.unionByName(counts).groupBy(key).agg(
                F.sum("n").alias("n"), F.min("start").alias("start"), F.max("since").alias("since")
            )
        since = F.coalesce("since", F.when(F.col("n") >= least, F.lit(step + 1)))
        counts = counts.withColumn("since", since)
        if step + 1 == shards:
            counts = stored(counts, "counts")
            totals = stored(
                counts.where("k = 1").groupBy("lang").agg(F.sum("n").alias("words")), "totals"
            )
        over = (F.col("start") + shards <= step + 1) & F.col("since").isNull()
        state = stored(counts.where(~over), "counts")
        step += 1
        filters = _filters(state.where(F.col("k") < most_words), pairs, step, shards)
    return state.where(F.col("n") >= least).select(*key, "n"), totals


def _active(counts: DataFrame, state: DataFrame | None, step: int, shards: int) -> DataFrame:
    """Words, and the phrases that are active in this step, with the step they started in."""
    words = counts.where("k = 1").withColumn("start", F.lit(0))
    if state is None:
        return words
    reached = state.where("since IS NOT NULL").select("lang", "phrase", "since")
    prefix, suffix = (
        reached.select("lang", F.col("phrase").alias(x), F.col("since").alias(f"{x}_since"))
        for x in ("prefix", "suffix")
    )
    longer = counts.where("k > 1").withColumns({"prefix": _prefix(), "suffix": _suffix()})
    longer = longer.join(prefix, ["lang", "prefix"]).join(suffix, ["lang", "suffix"])
    start = F.greatest("prefix_since", "suffix_since")
    longer = longer.withColumn("start", start).where(F.col("start") + shards > step)
    return words.unionByName(longer.select(words.columns))


def collocations(phrases: DataFrame, totals: DataFrame, most: int) -> DataFrame:
    """The ``most`` strongest phrases of two words and more of each language, from the tables of
    ``count_phrases``: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``.

    Cut in two, a phrase scores the floor of 1000 a n / (l r), with the counts of the phrase, of all
    words, and of both parts; the lowest-scoring cut counts, of equal ones the first. Phrases that
    occur only inside one longer phrase of the table are left out. Ranks are by score, count, then
    phrase. Products have up to 38 digits.
    """
    count = phrases.select("lang", F.col("phrase").alias("part"), F.col("n").alias("count"))
    whole = phrases.where("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"))
    longer = whole.where("k > 2").select("lang", "k", "phrase", "a")
    inside = longer.select("lang", F.explode(F.array(_prefix(), _suffix())).alias("phrase"), "a")
    own = whole.join(inside.distinct(), ["lang", "phrase", "a"], "left_anti")
    cuts = own.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumns(
        {
            "left": F.expr("substring_index(phrase, ' ', cut)"),
            "right": F.expr("substring_index(phrase, ' ', cut - k)"),
        }
    )
    left = count.select("lang", F.col("part").alias("left"), F.col("count").alias("l"))
    right = count.select("lang", F.col("part").alias("right"), F.col("count").alias("r"))
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "words")}
    scored = scored.withColumns(
        {"top": exact["a"] * exact["words"] * F.lit(1000).cast("decimal(4,0)"), "bottom": exact["l"] * exact["r"]}
    ).withColumn("score", F.expr("top div bottom"))
    best = scored.groupBy("lang", "phrase", "a", F.col("words").alias("n")).agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("best")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        best.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= most)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
