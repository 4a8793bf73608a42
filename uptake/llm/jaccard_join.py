"""Near-duplicate classes by an exact Jaccard join of word shingles.

A text is the set of its distinct five-word shingles. Two texts link when their Jaccard
similarity is 0.75 or more; classes are what links connect.

1. *Sets.* Numpy cuts the texts of an Arrow batch into shingle numbers and deals them out by
   their leading bits. A row of this shuffle is a block of numbers, not one number.
2. *Frequencies.* Each bucket counts in how many different texts a number occurs. Numbers of
   one text cannot be in an overlap: they are dropped here and only counted. A number that many
   texts of a task have is counted there, so a bucket gets one count per task for it.
3. *Prefixes.* Per text, numbers are ordered from rare to frequent. Two texts that link share
   one among the first n - ceil(0.75 n) + 1, so only these become rows.
4. *Tiles.* A tile is a shared prefix number within a band of set sizes; a band and the next
   one hold all partners. Sizes and the places of the shared number bound the overlap. The
   first pass links every text of a number with one pivot only; the second compares texts of
   different components, so copies never become all pairs.
5. *Bitmaps.* Signatures as wide as the band needs: half the numbers of two sets, less half
   the bits in which they differ, bounds the overlap from above. Surviving pairs intersect
   their sorted numbers exactly.

Equal texts are one set from the start. A hot number is split by adaptive execution like any
skewed join, and no pair inside a component is made.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uptake.llm.common import power_of_two, runs, stored, text_bytes, text_slices
from uptake.llm.components import components
from uptake.llm.shingles import shingle_sets

#: Two sets of sizes a and b link when 7 * overlap >= 3 * (a + b), that is Jaccard >= 3/4.
BUCKET_TEXT_BYTES = 1 << 24  # text per bucket, about 2 million shingles
FLUSH_SHINGLES = 1 << 20
NUMBER_BITS = 48  # of a shingle hash, besides the bucket
_NUMBER = np.uint64((1 << NUMBER_BITS) - 1)

SALTS = 32  # tasks that name the members of one component
#: A number that so many texts of one flush have is counted there, not sent once per text.
FREQUENT = 16

# Rows of the first shuffle: numbers of texts (COLD); counts of frequent numbers (HOT); which
# texts have them (MEMBERS), which may go through any bucket.
MEMBERS, HOT, COLD = 0, 1, 2
_BLOCKS = pa.schema(
    [("bucket", pa.int32()), ("kind", pa.int32())]
    + [(c, pa.binary()) for c in ("keys", "counts", "low", "high")]
)
_BLOCK_COLUMNS = "bucket int, kind int, keys binary, counts binary, low binary, high binary"
_SHARED = pa.schema(
    [("shard", pa.int32()), ("kind", pa.int32())]
    + [(c, pa.binary()) for c in ("keys", "single", "kept", "numbers", "texts")]
)
_SHARED_COLUMNS = (
    "shard int, kind int, keys binary, single binary, kept binary, numbers binary, texts binary"
)
_SETS = "key long, n int, shared int, numbers binary, bitmap binary, prefix array<long>"


def has_words(text: Column) -> Column:
    return F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


def _key(text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), text)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each row's id and the key of its text, null without words. Keys of different texts differ:
    if a 64-bit hash has a collision, the next seed is taken."""
    for seed in range(8):
        text = F.col(text_col)
        rows = docs.select(
            F.col(id_col).alias("id"),
            F.when(has_words(text), _key(text, seed)).alias("key"),
            F.when(has_words(text), F.sha2(text, 256)).alias("digest"),
        )
        rows = stored(rows, "keys")
        clash = rows.groupBy("key").agg((F.min("digest") != F.max("digest")).alias("clash"))
        if clash.where("clash").isEmpty():
            return rows.drop("digest").withColumn("seed", F.lit(seed))
    raise ValueError("no seed gives every text its own key")


def _blocks(bucket_bits: int):
    """Arrow batches of (key, text) to blocks of shingle numbers by bucket."""

    def flush(keys: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not keys:
            return
        text = np.repeat(np.arange(len(keys)), [len(s) for s in sets])
        numbers, own = np.concatenate(sets), np.array(keys, np.int64)
        order = np.argsort(numbers, kind="stable")
        begin, texts = runs(numbers[order])
        frequent = np.zeros(len(numbers), bool)
        frequent[order] = np.repeat(texts >= FREQUENT, texts)
        rows = {c: [] for c in _BLOCKS.names}

        def add(bucket: int, kind: int, *values: np.ndarray) -> None:
            rows["bucket"].append(bucket)
            rows["kind"].append(kind)
            for c, value in zip(_BLOCKS.names[2:], values, strict=False):
                rows[c].append(value.tobytes())

        if frequent.any():
            names, counts = numbers[order][begin[texts >= FREQUENT]], texts[texts >= FREQUENT]
            bucket = names >> np.uint64(64 - bucket_bits)
            nothing = np.empty(0, np.uint8)
            for a, n in zip(*runs(bucket), strict=True):
                here = slice(a, a + n)
                found = names[here], counts[here].astype(np.uint32)
                add(int(bucket[a]), HOT, *found, nothing, nothing)
            any_bucket = int(abs(keys[0])) % (1 << bucket_bits)
            add(any_bucket, MEMBERS, own[text[frequent]], numbers[frequent], nothing, nothing)
            text, numbers = text[~frequent], numbers[~frequent]
        bucket = (numbers >> np.uint64(64 - bucket_bits)).astype(np.uint32)
        order = np.argsort(bucket, kind="stable")
        bucket, text, numbers = bucket[order], text[order], numbers[order] & _NUMBER
        # A text's numbers in one bucket are neighbours now.
        first, counts = runs(bucket.astype(np.int64) * len(keys) + text)
        own, counts = own[text[first]], counts.astype(np.uint32)
        low, high = numbers.astype(np.uint32), (numbers >> np.uint64(32)).astype(np.uint16)
        begin, size = runs(bucket)
        places = np.searchsorted(first, np.r_[begin, len(bucket)])
        for i, (a, n) in enumerate(zip(begin.tolist(), size.tolist(), strict=True)):
            here, all_here = slice(places[i], places[i + 1]), slice(a, a + n)
            add(int(bucket[a]), COLD, own[here], counts[here], low[all_here], high[all_here])
        yield pa.RecordBatch.from_pydict(rows, schema=_BLOCKS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sets, held = [], [], 0
        seen: set[int] = set()
        for batch in text_slices(batches):
            own = batch.column("key").to_numpy(zero_copy_only=False)
            new = np.array([k not in seen and not seen.add(k) for k in own.tolist()], bool)
            batch = batch.filter(pa.array(new))
            if not batch.num_rows:
                continue
            keys += own[new].tolist()
            data, offsets = text_bytes(batch.column("text"))
            for numbers in shingle_sets(data, offsets, mask=_mask(bucket_bits)):
                sets.append(numbers)
                held += len(numbers)
                if held >= FLUSH_SHINGLES:
                    yield from flush(keys[: len(sets)], sets)
                    keys, sets, held = keys[len(sets) :], [], 0
        yield from flush(keys, sets)

    return cut


def _mask(bucket_bits: int) -> int:
    """The bits kept of a shingle hash: those of the bucket and the lower ones."""
    return ((1 << 64) - 1) ^ max(0, (1 << (64 - bucket_bits)) - (1 << NUMBER_BITS))


def _joined(blocks, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(blocks), dtype)


def _by_shard(
    shards: int,
    keys: np.ndarray,
    single: np.ndarray,
    kept: np.ndarray,
    numbers: np.ndarray,
    texts: np.ndarray,
) -> Iterator[tuple]:
    """The rows of the second shuffle: texts, how many numbers only they have, and the others."""
    shard = keys.astype(np.uint64) % np.uint64(shards)
    order = np.argsort(shard, kind="stable")
    entries = np.argsort(np.repeat(shard, kept), kind="stable")
    numbers, texts = numbers[entries], texts[entries]
    keys, single, kept, shard = keys[order], single[order], kept[order], shard[order]
    place = np.r_[0, np.cumsum(kept, dtype=np.int64)]
    for a, n in zip(*runs(shard), strict=True):
        here, own = slice(a, a + n), slice(place[a], place[a + n])
        yield int(shard[a]), COLD, keys[here], single[here], kept[here], numbers[own], texts[own]


def _bucket(
    bucket: int, bits: int, shards: int, cold: list[dict], hot: list[dict]
) -> Iterator[tuple]:
    """The rows of one bucket for the second shuffle."""

    def column(rows: list[dict], name: str, dtype) -> np.ndarray:
        return _joined([r[name] for r in rows], dtype)

    frequent, at = np.unique(column(hot, "keys", np.uint64), return_inverse=True)
    counted = np.bincount(at, column(hot, "counts", np.uint32), len(frequent)).astype(np.int64)
    keys, owner = np.unique(column(cold, "keys", np.int64), return_inverse=True)
    owner = np.repeat(owner, column(cold, "counts", np.uint32))
    numbers = column(cold, "low", np.uint32) | (
        column(cold, "high", np.uint16).astype(np.uint64) << np.uint64(32)
    )
    numbers |= np.uint64(bucket) << np.uint64(64 - bits)

    order = np.argsort(numbers)
    begin, size = runs(numbers[order])
    several = (size > 1) | np.isin(numbers[order][begin], frequent)
    several = np.repeat(several, size)
    single = np.bincount(owner[order[~several]], minlength=len(keys))
    # A text met by several tasks has a number once: pairs are made distinct.
    rest = order[several]
    rest = rest[np.lexsort((owner[rest], numbers[rest]))]
    number, text = numbers[rest], owner[rest]
    new = np.ones(len(rest), bool)
    new[1:] = (number[1:] != number[:-1]) | (text[1:] != text[:-1])
    number, text = number[new], text[new]
    begin, size = runs(number)
    total = size.astype(np.int64)
    if len(frequent):
        place = np.searchsorted(frequent, number[begin])
        place[place == len(frequent)] = 0
        total += np.where(frequent[place] == number[begin], counted[place], 0)
        everywhere = counted.copy()
        both = np.isin(frequent, number[begin])
        everywhere[both] += size[np.searchsorted(number[begin], frequent[both])]
        none = np.empty(0, np.int64)
        for shard in range(shards):
            yield shard, HOT, none, none, none, frequent, everywhere.astype(np.uint32)
    shared = np.repeat(total > 1, size)
    single += np.bincount(text[~shared], minlength=len(keys))
    frequency = np.repeat(total, size)[shared].astype(np.uint32)
    number, text = number[shared], text[shared]
    by_text = np.argsort(text, kind="stable")
    kept = np.bincount(text, minlength=len(keys)).astype(np.uint32)
    yield from _by_shard(
        shards, keys, single.astype(np.uint32), kept, number[by_text], frequency[by_text]
    )


def _frequencies(bits: int, shards: int):
    """In how many texts each number occurs, bucket by bucket, for rows sorted by bucket.

    Frequent numbers come as counts, one per task and number, so no bucket gathers all texts of
    a number; which texts have them only passes through.
    """

    def batch(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if rows:
            columns = [list(c) for c in zip(*rows, strict=True)]
            plain = columns[:2] + [[v.tobytes() for v in c] for c in columns[2:]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(plain, _SHARED, strict=True)], schema=_SHARED
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, cold, hot = None, [], []
        for block in batches:
            for i in range(block.num_rows):
                row = {c: block.column(c)[i].as_py() for c in _BLOCKS.names}
                if row["bucket"] != bucket:
                    if bucket is not None:
                        yield from batch([*_bucket(bucket, bits, shards, cold, hot)])
                    bucket, cold, hot = row["bucket"], [], []
                if row["kind"] == MEMBERS:
                    keys = np.frombuffer(row["keys"], np.int64)
                    numbers = np.frombuffer(row["counts"], np.uint64)
                    one, zero = np.ones(len(keys), np.uint32), np.zeros(len(keys), np.uint32)
                    parts = _by_shard(shards, keys, zero, one, numbers, zero)
                    yield from batch([(shard, MEMBERS, *part) for shard, _, *part in parts])
                else:
                    (hot if row["kind"] == HOT else cold).append(row)
        if bucket is not None:
            yield from batch([*_bucket(bucket, bits, shards, cold, hot)])

    return count


def bitmap_bits(n: int) -> int:
    """Width of the signature of a set of ``n``: two bits or more per number, a power of two."""
    return max(64, power_of_two(2 * n))


def _bitmap(numbers: np.ndarray, n: int) -> bytes:
    bits = np.zeros(bitmap_bits(n), bool)
    bits[(numbers % np.uint64(len(bits))).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def _sets(rows: pd.DataFrame) -> pd.DataFrame:
    """Per text of one shard: its size, its shared numbers, and those in its prefix."""
    cold, members, hot = (rows[rows["kind"] == kind] for kind in (COLD, MEMBERS, HOT))
    frequent = _joined(hot["numbers"], np.uint64)
    counted = _joined(hot["texts"], np.uint32)
    by_number = np.argsort(frequent)
    of_members = _joined(members["numbers"], np.uint64)
    place = by_number[np.searchsorted(frequent, of_members, sorter=by_number)]
    keys = np.r_[_joined(cold["keys"], np.int64), _joined(members["keys"], np.int64)]
    names, text = np.unique(keys, return_inverse=True)
    single = _joined(cold["single"], np.uint32)
    n = np.bincount(text[: len(single)], single, len(names)).astype(np.int64)
    kept = np.r_[_joined(cold["kept"], np.uint32), _joined(members["kept"], np.uint32)]
    owner = np.repeat(text, kept)
    numbers = np.r_[_joined(cold["numbers"], np.uint64), of_members]
    frequency = np.r_[_joined(cold["texts"], np.uint32), counted[place]]
    order = np.lexsort((numbers, frequency, owner))
    numbers, owner = numbers[order], owner[order]
    new = np.ones(len(order), bool)
    new[1:] = (numbers[1:] != numbers[:-1]) | (owner[1:] != owner[:-1])
    numbers, owner = numbers[new], owner[new]
    n += np.bincount(owner, minlength=len(names))
    place = np.searchsorted(owner, np.arange(len(names) + 1))
    out = {c: [] for c in ("key", "n", "shared", "numbers", "bitmap", "prefix")}
    for i, key in enumerate(names.tolist()):
        own = numbers[place[i] : place[i + 1]]
        size = int(n[i])
        length = size - (3 * size + 3) // 4 + 1 - (size - len(own))
        out["key"].append(key)
        out["n"].append(size)
        out["shared"].append(len(own))
        out["numbers"].append(np.sort(own).tobytes())
        out["bitmap"].append(_bitmap(own, size))
        out["prefix"].append(own[: max(0, length)].astype(np.int64))
    return pd.DataFrame(out)


def _entries(sets: DataFrame) -> DataFrame:
    """Prefix numbers as rows: the number, the text, its size and band, and the number's place."""
    return sets.select(
        "key",
        "n",
        F.floor(F.log(F.col("n").cast("double")) / math.log(4 / 3)).cast("int").alias("band"),
        F.posexplode("prefix").alias("j", "number"),
        (F.col("n") - F.col("shared")).alias("before"),
    ).select("number", "key", "n", "band", (F.col("before") + F.col("j")).alias("place"))


def _may_link(n, place, other_n, other_place) -> Column:
    """Whether sizes and the numbers left behind the shared one allow the overlap needed."""
    behind = F.least(n - place, other_n - other_place)
    return (
        (4 * F.least(n, other_n) >= 3 * F.greatest(n, other_n))
        & (7 * behind >= 3 * (n + other_n))
    )


def _ordered(a: Column, b: Column) -> tuple[Column, Column]:
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def _pivot_pairs(entries: DataFrame) -> DataFrame:
    """Every text of a number with the one text that has it earliest."""
    pivots = (
        entries.groupBy("number")
        .agg(F.min(F.struct("place", "n", "key")).alias("pivot"), F.count(F.lit(1)).alias("texts"))
        .where("texts > 1")
        .drop("texts")
    )
    pivot = F.col("pivot")
    return (
        entries.join(pivots, "number")
        .where(F.col("key") != pivot["key"])
        .where(_may_link(F.col("n"), F.col("place"), pivot["n"], pivot["place"]))
        .select(*_ordered(F.col("key"), pivot["key"]))
        .distinct()
    )


def _tile_pairs(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of texts in different components that share a number within a band or two."""
    entries = entries.join(
        labels.select(F.col("node").alias("key"), F.col("root")), "key", "left"
    ).select(*entries.columns, F.coalesce("root", "key").alias("root"))
    open_numbers = (
        entries.groupBy("number")
        .agg(F.min("root").alias("least"), F.max("root").alias("most"))
        .where("least <> most")
        .select("number")
    )
    entries = stored(entries.join(open_numbers, "number", "left_semi"), "tiles")
    small = entries.withColumn(
        "tile", F.explode(F.array(F.col("band"), F.col("band") + 1))
    ).alias("s")
    large = entries.withColumn("tile", F.col("band")).alias("l")
    s, t = (lambda c: F.col(f"s.{c}")), (lambda c: F.col(f"l.{c}"))
    upwards = (s("n") < t("n")) | ((s("n") == t("n")) & (s("key") < t("key")))
    return (
        small.join(
            large,
            (s("number") == t("number"))
            & (s("tile") == t("tile"))
            & (s("root") != t("root"))
            & upwards
            & _may_link(s("n"), s("place"), t("n"), t("place")),
        )
        .select(*_ordered(s("key"), t("key")))
        .distinct()
    )


def overlap_bound(a: bytes, b: bytes, shared: int) -> int:
    """An upper bound of the overlap of two sets with ``shared`` numbers together."""
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    y = np.bitwise_or.reduce(y.reshape(-1, len(x)))  # a number modulo the narrower width
    return (shared - int(np.bitwise_count(x ^ y).sum())) // 2


def _by_bitmap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        c = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        fits = [
            7 * overlap_bound(x, y, kx + ky) >= 3 * (nx + ny)
            for x, y, kx, ky, nx, ny in zip(
                c["x_bitmap"], c["y_bitmap"], c["x_shared"], c["y_shared"], c["x_n"], c["y_n"],
                strict=True,
            )
        ]
        yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        links = []
        for x, y, nx, ny in zip(
            *(batch.column(c).to_pylist() for c in ("x_numbers", "y_numbers", "x_n", "y_n")),
            strict=True,
        ):
            x, y = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
            found = np.minimum(np.searchsorted(y, x), len(y) - 1)
            links.append(7 * int((y[found] == x).sum()) >= 3 * (nx + ny))
        yield batch.select(["a", "b"]).filter(pa.array(links, pa.bool_()))


def _with_sets(pairs: DataFrame, sets: DataFrame, columns: list[str]) -> DataFrame:
    for side, name in (("a", "x"), ("b", "y")):
        own = sets.select(
            F.col("key").alias(side), *[F.col(c).alias(f"{name}_{c}") for c in columns]
        )
        pairs = pairs.join(own, side)
    return pairs


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that link: first by their bitmaps, then by exact intersection."""
    bounded = _with_sets(pairs, sets, ["n", "shared", "bitmap"]).mapInArrow(
        _by_bitmap, "a long, b long"
    )
    return _with_sets(bounded, sets, ["n", "numbers"]).mapInArrow(_exact, "a long, b long")


def _classes(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, int]:
    """Rows with the key of their text, the texts with their component, and the seed of the keys."""
    rows = _keyed(docs, id_col, text_col)
    total = docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("long"))).first()[0] or 0
    buckets = max(64, power_of_two(total / BUCKET_TEXT_BYTES))
    first = rows.select("seed").limit(1).first()
    seed = first[0] if first else 0
    text = F.col(text_col)
    texts = docs.where(has_words(text)).select(
        _key(text, seed).alias("key"), F.concat(text, F.lit(" ")).alias("text")
    )
    bits = buckets.bit_length() - 1
    sets = (
        texts.mapInArrow(_blocks(bits), _BLOCK_COLUMNS)
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_frequencies(bits, max(16, buckets // 2)), _SHARED_COLUMNS)
        .groupBy("shard")
        .applyInPandas(_sets, _SETS)
    )
    sets = stored(sets, "sets")
    entries = _entries(sets)
    links = stored(verified(_pivot_pairs(entries), sets), "pivot-links")
    labels = components(links)
    more = verified(_tile_pairs(entries, labels), sets)
    labels = components(links.unionByName(more))

    classes = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("least"))
    classes = (
        classes.join(sets.select("key", "n"), "key")
        .join(labels.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    return rows, classes, seed


def near_duplicate_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id``, ``key`` of the text, ``n_shingles`` and ``component_id`` of every row.

    Columns other than the two are not looked at. Null, empty and blank texts have no key and
    no shingles and are their own component. Equal texts share a key. Rows that repeat an id
    stay separate rows. A null id never names a component unless all its ids are null. An empty
    table gives no rows. Texts are processed whole, whatever their length.
    """
    rows, classes, _ = _classes(docs, id_col, text_col)
    # The members of a large component meet its smallest id in several tasks.
    least = (
        classes.groupBy("root")
        .agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("texts"))
        .where("texts > 1")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    salted = classes.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
    named = salted.join(least, ["root", "salt"], "left").select(
        "key", "n", F.coalesce("component_id", "least").alias("component_id")
    )
    return rows.join(named, "key", "left").select(
        "id",
        "key",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id")).alias(
            "component_id"
        ),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every component, all columns: that with the smallest id, nulls last.

    Of repeated rows with that id and text any one stays. Rows without words are all kept.
    """
    rows, classes, seed = _classes(docs, id_col, text_col)
    order = F.struct(F.col("least").isNull(), "least", "key")
    kept = classes.groupBy("root").agg(F.min_by(F.struct("key", "least"), order).alias("kept"))
    kept = kept.select(F.col("kept.key").alias("_key"), F.col("kept.least").alias("_id"))
    kept = stored(kept, "kept")
    text, own = F.col(text_col), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    words = has_words(text)
    keyed = docs.where(words).select(_key(text, seed).alias("key"), F.col(id_col).alias("id"), own)
    same = (keyed["key"] == kept["_key"]) & keyed["id"].eqNullSafe(kept["_id"])
    chosen = keyed.join(kept, same, "left_semi").dropDuplicates(["key", "id"]).select("row.*")
    return chosen.unionByName(docs.where(~words))
