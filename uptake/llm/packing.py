"""Packing of tokenised documents into sequences of a fixed length.

Documents are tokenised, cut into pieces no longer than a sequence, and dealt out at random to
groups of a few thousand documents. Each group is packed on its own by first-fit decreasing:
pieces from long to short, each into the first sequence with enough room, found in a tournament
tree over the room left. First-fit decreasing leaves next to no room unfilled once a group has
some hundred pieces, so groups cost no density and any number of them run in parallel.
"""

from __future__ import annotations

import base64
import re
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CAPACITY = 1024
GROUP_DOCUMENTS = 4096
END_ID = 0
_NUMBERS = ("row", "start", "length", "doc_tokens", "ids_crc32")

_RUN = re.compile(r"\s\s")


class Encoder:
    """Token ids of texts as little-endian 32-bit numbers.

    Takes the byte-pair ranks of a tokenizer, its splitting pattern and its special tokens, and
    gives the ids of that tokenizer for the whole text. A special token written in a text gets
    its id. Texts without a run of white space need no look-ahead to be split, which makes
    splitting them several times faster.
    """

    def __init__(self, path: str, pattern: str, special: Sequence[str] = ("<|endoftext|>",)):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
        self._special = {token: len(ranks) + i for i, token in enumerate(special)}
        self._plain, self._full = (
            tiktoken.Encoding(
                name, pat_str=text, mergeable_ranks=ranks, special_tokens=self._special
            )
            for name, text in (("plain", pattern.replace(r"|\s+(?!\S)", "")), ("full", pattern))
        )

    def __call__(self, text: str) -> bytes:
        encoding = self._full if _RUN.search(text) else self._plain
        if any(token in text for token in self._special):
            ids = encoding.encode(text, allowed_special="all")
        else:
            ids = encoding.encode_ordinary(text)
        numbers = array("I", ids)
        if sys.byteorder == "big":
            numbers.byteswap()
        return numbers.tobytes()


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def _pieces(
    path: str, pattern: str, capacity: int, end_id: int, keep_ids: bool, schema: pa.Schema
) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = _encoder(path, pattern), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            place, start, length, total, sums, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                own = encode(text) + end
                n = len(own) // 4
                for a in range(0, n, capacity):
                    part = own[4 * a : 4 * (a + capacity)]
                    place.append(i)
                    start.append(a)
                    length.append(len(part) // 4)
                    total.append(n)
                    sums.append(zlib.crc32(part))
                    ids.append(part if keep_ids else None)
            if not place:
                continue
            taken = batch.select(["id", "row"]).take(pa.array(place))
            numbers = (start, length, total, sums)
            columns = [
                *[taken.column(c) for c in ("id", "row")],
                *[pa.array(n, pa.int64()) for n in numbers],
                *([pa.array(ids, pa.binary())] if keep_ids else []),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return cut


def tokenised_pieces(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = True,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every row: ``id``, ``row``, ``start``, ``length``,
    ``doc_tokens``, ``ids_crc32`` and, if kept, ``ids`` (32-bit little-endian).

    ``ranks`` is the path of a byte-pair rank file, ``pattern`` how its tokenizer splits texts.

    A null or empty text is the end id alone. ``row`` tells rows apart whose id is null or
    repeated; it follows the place of a row in its file. Other columns are not looked at.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = docs.select(F.col(id_col)).schema[0].dataType
    schema = T.StructType(
        [
            T.StructField("id", id_type),
            *[T.StructField(c, T.LongType()) for c in _NUMBERS],
            *([T.StructField("ids", T.BinaryType())] if keep_ids else []),
        ]
    )
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    cut = _pieces(ranks, pattern, capacity, end_id, keep_ids, arrow)
    return rows.mapInArrow(cut, schema)


class TournamentTree:
    """The room left in up to ``size`` sequences; finds the first with enough of it."""

    def __init__(self, size: int, capacity: int):
        self._leaves = 1 << max(0, size - 1).bit_length()
        self._most = [capacity] * (2 * self._leaves)

    def place(self, length: int) -> int:
        """Take ``length`` from the first sequence that has it, and return its number."""
        most, node = self._most, 1
        while node < self._leaves:
            node *= 2
            if most[node] < length:
                node += 1
        most[node] -= length
        at = node - self._leaves
        while node > 1:
            node //= 2
            winner = max(most[2 * node], most[2 * node + 1])
            if most[node] == winner:
                break
            most[node] = winner
        return at


def first_fit_decreasing(lengths: Sequence[int], capacity: int) -> tuple[list[int], list[int]]:
    """The sequence and the offset of every piece. Equal lengths keep their order."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    full = sum(1 for n in lengths if n == capacity)
    tree = TournamentTree(max(1, len(lengths) - full), capacity)
    sequence, offset, filled = [0] * len(lengths), [0] * len(lengths), {}
    for rank, i in enumerate(order):
        if lengths[i] > capacity:
            raise ValueError(f"a piece of {lengths[i]} is longer than a sequence of {capacity}")
        at = rank if rank < full else full + tree.place(lengths[i])
        sequence[i], offset[i] = at, filled.get(at, 0)
        filled[at] = offset[i] + lengths[i]
    return sequence, offset


def pack(
    pieces: DataFrame,
    documents: int,
    capacity: int = CAPACITY,
    group_documents: int = GROUP_DOCUMENTS,
    seed: int = 0,
) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with ``row``, ``start`` and ``length``.

    ``documents`` is the number of rows the pieces come from and sets the number of groups; a
    group holds ``group_documents`` of them on average. Sequence ids are unique, not gapless;
    offsets are gapless from 0. All other columns stay; those with the names of the new ones
    are replaced. No pieces give no rows.
    """
    groups = max(1, -(-documents // group_documents))
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    schema = T.StructType(
        [
            *pieces.select(*kept).schema.fields,
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def packed(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["row", "start"])
        sequence, offset = first_fit_decreasing(group["length"].tolist(), capacity)
        return group[kept].assign(
            sequence_id=(int(key[0]) << 40) + np.array(sequence, np.int64),
            offset=np.array(offset, np.int64),
        )

    group = F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(groups))
    return pieces.select(*kept).groupBy(group.alias("group")).applyInPandas(packed, schema)
