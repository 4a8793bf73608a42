"""Conversations as training texts with a loss mask, assembled column by column.

A turn becomes ``<|im_start|>``, its role, a line break, its text, ``<|im_end|>`` and a line break.
Control strings inside a text are escaped: a backslash after their first character, one more if
there are some already. So no text can open or close a turn, and taking one backslash away gives
the text back. The loss mask lists the assistant texts as ranges of code points.

Nothing is put together row by row. For a batch of turns numpy computes the lengths of all
segments (headers, stretches of text between escapes, escapes, footers), their cumulative offsets
and one scatter index, and copies all bytes into one buffer, which is the data of the Arrow column.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from uptake.llm.common import stored, text_bytes, text_slices

START, MIDDLE, END = b"<|im_start|>", b"\n", b"<|im_end|>\n"

# Strings that mark turns, here or in other templates.
CONTROLS = """<|im_start|> <|im_end|> <|endoftext|> <s> </s> [INST] [/INST] <<SYS>> <</SYS>>""".split()

LEARNED_ROLE = "assistant"
PART_BYTES = 1 << 20  # a conversation that is longer becomes several parts
LONG_TURNS = 1 << 16  # conversations with more turns are spread over tasks,
BLOCK_TURNS = 1 << 12  # so many turn numbers at a time
MOST_BROADCAST = 1 << 14  # long conversations

_CONTROL = re.compile(
    b"|".join(re.escape(c[:1].encode()) + rb"\\*" + re.escape(c[1:].encode()) for c in CONTROLS)
)
_ESCAPED = re.compile(
    b"|".join(
        b"(?<=" + re.escape(c[:1].encode()) + rb")\\(?=\\*" + re.escape(c[1:].encode()) + b")"
        for c in CONTROLS
    )
)
# What stands for characters that a role must not hold.
_ROLE_ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("<", "\\l"), ("[", "\\b"))
_ROLE_PLAIN = {escape: plain for plain, escape in _ROLE_ESCAPES}


def escaped_role(role: str) -> str:
    """One line without the first character of any control string."""
    for plain, escape in _ROLE_ESCAPES:
        role = role.replace(plain, escape)
    return role


def plain_role(role: str) -> str:
    return re.sub(r"\\.", lambda m: _ROLE_PLAIN[m[0]], role)


def plain_text(text: bytes) -> bytes:
    """The text before its control strings were escaped."""
    return _ESCAPED.sub(b"", text) if b"\\" in text else text


def _copy(source: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The segments of ``source`` one after the other, by one scatter index."""
    offsets = np.cumsum(lengths) - lengths
    return source[np.arange(int(lengths.sum())) + np.repeat(starts - offsets, lengths)]


def assemble(
    texts: pa.Array, roles: pa.Array
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all formatted turns, where each begins (and the last ends), and the first
    and last byte of its text. ``texts`` end in a line break each, which is not part of them.
    """
    data, offsets = text_bytes(texts)
    named = roles.dictionary_encode()
    headers = [START + escaped_role(r).encode() + MIDDLE for r in named.dictionary.to_pylist()]
    code = named.indices.to_numpy().astype(np.int64)
    pool = np.frombuffer(data.tobytes() + b"".join(headers) + END + b"\\", np.uint8)
    header_size = np.array([len(h) for h in headers], np.int64)
    header_at = len(data) + np.cumsum(header_size) - header_size
    footer_at = len(data) + int(header_size.sum())
    escape_at = footer_at + len(END)

    # A line break after each text keeps a match inside one text: no control string has one.
    cuts = np.array([m.start() + 1 for m in _CONTROL.finditer(memoryview(data))], np.int64)
    row = np.searchsorted(offsets, cuts, "right") - 1
    n = len(texts)
    n_cuts = np.bincount(row, minlength=n)
    n_segments = 2 * n_cuts + 3
    first = np.cumsum(n_segments) - n_segments  # header, text, (escape, text)*, footer
    starts = np.empty(int(n_segments.sum()), np.int64)
    lengths = np.empty_like(starts)
    starts[first], lengths[first] = header_at[code], header_size[code]
    last = first + n_segments - 1
    starts[last], lengths[last] = footer_at, len(END)
    nth = np.arange(len(cuts)) - np.repeat(np.cumsum(n_cuts) - n_cuts, n_cuts)
    place = first[row] + 2 + 2 * nth
    starts[place], lengths[place] = escape_at, 1
    starts[first + 1] = offsets[:-1]
    starts[place + 1] = cuts
    ends = np.empty_like(starts)
    ends[last - 1] = offsets[1:] - 1
    ends[place - 1] = cuts
    text = np.ones(len(starts), bool)
    text[first] = text[last] = text[place] = False
    lengths[text] = ends[text] - starts[text]

    begin = np.r_[0, np.cumsum(lengths)]
    turns = np.r_[begin[first], begin[-1]]
    return _copy(pool, starts, lengths), turns, begin[first + 1], begin[last]


def _codes(column: pa.Array) -> np.ndarray:
    return column.dictionary_encode(null_encoding="encode").indices.to_numpy()


def _parts(names: list[str], part_bytes: int) -> Callable:
    """Formats sorted turns; a conversation waits for its last turn, up to ``part_bytes``."""

    def formatted(turns: pa.RecordBatch, continued: int) -> tuple[pa.RecordBatch, int]:
        """Parts of the conversations of a batch, the first from number ``continued``."""
        changes = (np.diff(_codes(turns["id"])) != 0) | (np.diff(turns["block"].to_numpy()) != 0)
        data, at, text_from, text_to = assemble(turns["text"], turns["role"])
        change = np.r_[True, changes, True]
        nth = (at[1:] - at[np.flatnonzero(change)[np.cumsum(change[:-1]) - 1]] - 1) // part_bytes
        cut = np.r_[True, changes | (np.diff(nth) != 0), True]
        rows = np.flatnonzero(cut)
        group = np.cumsum(change[:-1])[rows[:-1]] - 1
        number = np.arange(len(group)) - np.searchsorted(group, group)
        number[group == 0] += continued
        # Code points: bytes that do not continue a character.
        points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
        learned = np.array([r == LEARNED_ROLE for r in turns["role"].to_pylist()], bool)
        begin = at[rows]
        owner = np.searchsorted(rows, np.flatnonzero(learned), "right") - 1
        spans = pa.StructArray.from_arrays(
            [pa.array(points[x[learned]] - points[begin[owner]]) for x in (text_from, text_to)],
            ["start", "end"],
        )
        loss = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(group)))].astype(np.int32)
        text = pa.LargeStringArray.from_buffers(
            len(group), pa.py_buffer(np.ascontiguousarray(begin, np.int64)), pa.py_buffer(data)
        )
        columns = [
            turns["id"].take(pa.array(rows[:-1])),
            turns["block"].take(pa.array(rows[:-1])),
            pa.array(number, pa.int64()),
            pa.array(np.diff(rows), pa.int64()),
            text.cast(pa.string()),
            pa.ListArray.from_arrays(pa.array(loss, pa.int32()), spans),
        ]
        out = pa.RecordBatch.from_arrays(columns, names)
        return out, int(number[-1]) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sent, number = None, None, 0  # number: parts sent of the conversation ``sent``
        for batch in chain(text_slices(batches), [None]):
            both = [x for x in (held, batch) if x is not None]
            if not both:
                continue
            turns = pa.Table.from_batches(both).combine_chunks().to_batches()[0]
            same = (np.diff(_codes(turns["id"])) == 0) & (np.diff(turns["block"].to_numpy()) == 0)
            tail = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if batch is None or not tail and turns.nbytes > part_bytes:
                tail = len(turns)
            done, held = turns.slice(0, tail), turns.slice(tail) if tail < len(turns) else None
            if not tail:
                continue
            key = [(done["id"][i].as_py(), done["block"][i].as_py()) for i in (0, tail - 1)]
            out, number = formatted(done, number if key[0] == sent else 0)
            sent = key[1]
            yield out

    return run


def _by_turn() -> list[Column]:
    return [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]


def _blocks(rows: DataFrame, long_turns: int) -> tuple[DataFrame, DataFrame | None]:
    """The turns of ordinary conversations and those of long ones, or None, with ``block``: 0, or
    a range of turn numbers of a long conversation."""
    long = stored(
        rows.groupBy("id").agg(F.count(F.lit(1)).alias("_turns")).where(F.col("_turns") > long_turns),
        "long",
    ).select(F.col("id").alias("_long"))
    n = long.count()
    zero = F.lit(0).cast("long").alias("block")
    if not n:
        return rows.select("*", zero), None
    long = F.broadcast(long) if n <= MOST_BROADCAST else long
    match = F.col("id").eqNullSafe(F.col("_long"))
    ordinary = rows.join(long, match, "left_anti").select("*", zero)
    block = F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 63))).cast("long")
    return ordinary, rows.join(long, match, "left_semi").select("*", block.alias("block"))


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    part_bytes: int = PART_BYTES,
    long_turns: int = LONG_TURNS,
) -> tuple[DataFrame, DataFrame | None]:
    """Formatted conversations: ``id``, ``block``, ``part``, ``n_turns``, ``text`` and ``loss``,
    the assistant texts as ranges of code points of ``text``.

    The parts of a conversation in the order of ``block`` and ``part`` are its text; a part holds
    whole turns, one at least, and only conversations beyond ``part_bytes`` have several. Turns
    are ordered by turn, null first, then role and text; repeated rows are turns like any other.
    A null role or text is empty. Rows with a null conversation are one conversation. Other
    columns are not looked at; no rows give no rows.

    Two tables are returned: the ordinary conversations, in which all parts of a conversation
    are in one partition and in order, and the conversations of more than ``long_turns`` turns,
    spread over tasks by ranges of turn numbers, or None if there are none.
    """
    rows = turns.select(
        F.col(conv_col).alias("id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"),
        F.concat(F.coalesce(text_col, F.lit("")), F.lit("\n")).alias("text"),
    )
    schema = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            *T._parse_datatype_string("block bigint, part bigint, n_turns bigint, text string"),
            T.StructField("loss", T._parse_datatype_string("array<struct<start:bigint,end:bigint>>")),
        ]
    )

    def formatted(some: DataFrame | None, *keys: str) -> DataFrame | None:
        if some is None:
            return None
        ordered = some.repartition(*keys).sortWithinPartitions("id", "block", *_by_turn())
        ordered = ordered.select("id", "block", "role", "text")
        return ordered.mapInArrow(_parts(schema.names, part_bytes), schema)

    ordinary, long = _blocks(rows, long_turns)
    return formatted(ordinary, "id"), formatted(long, "id", "block")


class _Digests:
    """What has been read back of one conversation."""

    def __init__(self, key):
        self.key, self.n_turns, self.loss_chars, self.chars = key, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, loss: list[dict]) -> None:
        turns = text.encode().split(END)
        if turns.pop():
            raise ValueError("a formatted part does not end with a turn")
        for turn in turns:
            head, middle, body = turn.partition(MIDDLE)
            if not middle or not head.startswith(START):
                raise ValueError("a formatted turn does not begin with its header")
            role = plain_role(head[len(START) :].decode())
            self.turns.update(role.encode() + b"\n" + plain_text(body) + b"\n")
        self.n_turns += len(turns)
        for span in loss:
            learned = plain_text(text[span["start"] : span["end"]].encode())
            self.loss.update(learned)
            self.loss_chars += len(learned.decode())
        self.chars += len(text)

    def row(self) -> tuple:
        return (
            self.key, self.n_turns, self.turns.hexdigest(), self.loss_chars,
            self.loss.hexdigest(), self.chars,
        )


def _read(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    current = None
    for batch in text_slices(batches):
        rows = []
        columns = (batch[c].to_pylist() for c in ("id", "text", "loss"))
        for key, text, loss in zip(*columns, strict=True):
            if current is None or current.key != key:
                rows += [current.row()] if current else []
                current = _Digests(key)
            current.add(text, loss)
        yield _batch(rows, schema)
    if current:
        yield _batch([current.row()], schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema
    )


def read_chats(ordinary: DataFrame, long: DataFrame | None) -> DataFrame:
    """Per conversation what its formatted text says: ``id``, ``n_turns``, ``turns_sha256`` (of
    role, line break, text and line break of each turn), ``loss_chars`` and ``loss_sha256`` (of
    the texts under the mask, escapes taken back) and ``formatted_chars``.

    Parts are read one after the other. Those of long conversations are brought together by
    conversation first, as a digest is made in one go; no task holds more than a part.
    """
    schema = T.StructType(
        [
            T.StructField("id", ordinary.schema["id"].dataType),
            *T._parse_datatype_string(
                "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
                " formatted_chars bigint"
            ),
        ]
    )
    arrow = to_arrow_schema(schema)

    def digests(parts: DataFrame) -> DataFrame:
        return parts.select("id", "text", "loss").mapInArrow(lambda b: _read(b, arrow), schema)

    read = digests(ordinary)
    if long is not None:
        read = read.unionByName(
            digests(long.repartition("id").sortWithinPartitions("id", "block", "part"))
        )
    return read
