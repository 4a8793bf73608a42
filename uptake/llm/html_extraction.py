"""Main text of web pages by differencing a page with the page of the nearest URL.

Pages of one host, in the order of their URL paths, have their nearest URLs next to them. The
text lines of a page and of its nearest page are aligned by a longest common subsequence. Lines
in the alignment come from the site, not from the page, and are deleted. Inside an article
element they are so only if the page on the other side has them too, where the host has one, as
articles quote each other. A nearest page that shares most of the text is a copy and tells nothing about the site:
neighbours that are copies of each other form a run, and a page is compared with the nearest page
outside its run, or keeps its lines if its host has none. Lines inside elements that are never
part of an article, such as menus, footers and forms, go on every page; where an article element
holds most of the other text, lines around it go as well.

Only hashes of lines are shuffled to compare pages. Neighbours come from a range-partitioned
order, so a host with any share of the pages is many tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uptake.llm.common import stored, text_slices
from uptake.llm.html_blocks import Block, blocks

TABLE_BITS = 1 << 28  # of one alignment table; larger ones are split
TEASER = 0.5  # an article with less of the text outside menus and the like is a teaser
ROWS = 256  # pages whose texts are put together at once
COPY_TEXT = 0.9  # copies share that much of their text, or COPY_BOTH of text and lines
COPY_BOTH = 0.75


def _rows(a: Sequence, b: Sequence) -> list[int]:
    """Bit-parallel LCS: after each item of ``a``, a zero bit where the length over ``b`` grows."""
    places: dict = {}
    for j, item in enumerate(b):
        places[item] = places.get(item, 0) | (1 << j)
    full = (1 << len(b)) - 1
    state, out = full, []
    for item in a:
        hit = state & places.get(item, 0)
        state = ((state + hit) | (state - hit)) & full
        out.append(state)
    return out


def _lengths(state: int, n: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(state.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")
    return np.r_[0, np.cumsum(1 - bits[:n].astype(np.int64))]


def common_lines(a: Sequence, b: Sequence) -> list[int]:
    """Places in ``a`` of a longest common subsequence of ``a`` and ``b``."""
    begin, end_a, end_b = 0, len(a), len(b)
    while begin < min(end_a, end_b) and a[begin] == b[begin]:
        begin += 1
    while end_a > begin and end_b > begin and a[end_a - 1] == b[end_b - 1]:
        end_a, end_b = end_a - 1, end_b - 1
    head, tail = list(range(begin)), list(range(end_a, len(a)))
    mid_a, mid_b = a[begin:end_a], b[begin:end_b]
    if not len(mid_a) or not len(mid_b):
        return head + tail
    if len(mid_a) * len(mid_b) > TABLE_BITS and len(mid_a) > 1:
        half, n = len(mid_a) // 2, len(mid_b)
        front = _lengths(_last(mid_a[:half], mid_b), n)
        back = _lengths(_last(mid_a[half:][::-1], mid_b[::-1]), n)[::-1]
        cut = int(np.argmax(front + back))
        found = common_lines(mid_a[:half], mid_b[:cut])
        found += [half + i for i in common_lines(mid_a[half:], mid_b[cut:])]
    else:
        states = _rows(mid_a, mid_b)
        found, j = [], len(mid_b)
        for i in range(len(mid_a) - 1, -1, -1):
            # The length up to j falls when item i is left out: it is in the alignment.
            before = states[i - 1] if i else (1 << len(mid_b)) - 1
            while j and states[i] >> (j - 1) & 1:
                j -= 1
            if j and before >> (j - 1) & 1:
                found.append(i)
                j -= 1
        found.reverse()
    return head + [begin + i for i in found] + tail


def _last(a: Sequence, b: Sequence) -> int:
    places: dict = {}
    for j, item in enumerate(b):
        places[item] = places.get(item, 0) | (1 << j)
    full = (1 << len(b)) - 1
    state = full
    for item in a:
        hit = state & places.get(item, 0)
        state = ((state + hit) | (state - hit)) & full
    return state


def candidate_lines(page: Sequence[Block]) -> tuple[bool, list[tuple[int, str]]]:
    """Whether a page marks its article, and its lines that may stay with their places: those of
    the article or, without one or if it is a teaser, all that are not in a menu, a footer or the
    like."""
    body = [(i, b) for i, b in enumerate(page) if not b.aside]
    article = [(i, b) for i, b in body if b.article]
    if sum(len(b.text) for _, b in article) < TEASER * sum(len(b.text) for _, b in body):
        article = []
    return bool(article), [(i, b.text) for i, b in article or body]


def kept_text(lines: str, places: Sequence[int], shared: Sequence[int] | None, copy: bool | None) -> str:
    """The candidate lines, joined by line feeds, without those shared with the nearest page.

    A page that shares them all, or most of its text, is a copy, which tells nothing about its
    site, and keeps them.
    """
    if copy or not shared or not places:
        return lines
    gone = set(shared)
    own = [text for i, text in zip(places, lines.split("\n"), strict=True) if i not in gone]
    return "\n".join(own) if own else lines


def _kept_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("lines", "places", "shared", "copy")
    for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
        rows = zip(*(batch.column(c).to_pylist() for c in names), strict=True)
        texts = [kept_text(zlib.decompress(lines).decode(), *rest) for lines, *rest in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], ["id", "url", "text"]
        )


def _line_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether the article is marked, hashes of all lines, and lengths of the candidate ones, 0
    for others."""
    for batch in text_slices(batches, "html"):
        marked, lines, sizes = [], [], []
        for html in batch.column("html").to_pylist():
            page = blocks(html)
            lines.append([xxhash.xxh64_intdigest(b.text) - (1 << 63) for b in page])
            size = [0] * len(page)
            has_article, found = candidate_lines(page)
            for i, text in found:
                size[i] = len(text)
            marked.append(has_article)
            sizes.append(size)
        kept = [batch.column(c) for c in ("key", "host", "path")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(marked, pa.bool_()), pa.array(lines, pa.list_(pa.int64())),
             pa.array(sizes, pa.list_(pa.int32()))],
            names=["key", "host", "path", "marked", "lines", "sizes"],
        )


def is_copy(shared: Sequence[int], own: Sequence[int], other: Sequence[int]) -> bool:
    """Whether two pages with candidate lines of these lengths share most of both of them."""
    both = [own[i] for i in shared if own[i]]
    text = sum(both) / max(sum(own), sum(other), 1)
    lines = len(both) / max(np.count_nonzero(own), np.count_nonzero(other), 1)
    return text >= COPY_TEXT or min(text, lines) >= COPY_BOTH


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = ("lines", "other", "sizes", "other_sizes", "second", "marked")
        shared, copy = [], []
        for a, b, own, other, second, marked in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            places = common_lines(a, b)
            copy.append(is_copy(places, own, other))
            if marked:
                known = {line for line, size in zip(b, other, strict=True) if size}
                known &= known if second is None else set(second)
                places = [i for i in places if a[i] in known]
            shared.append(places)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(shared, pa.list_(pa.int32())), pa.array(copy, pa.bool_())],
            names=["key", "shared", "copy"],
        )


def _aligned(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """``key``, ``shared`` places and ``copy`` of rows of ``key``, ``other`` and ``second``; of a
    page that marks its article only those that are candidates on the other page and on the
    second, if there is one."""
    own = lines.select("key", "lines", "sizes", "marked")
    theirs = lines.select(
        F.col("key").alias("other"), F.col("lines").alias("theirs"), F.col("sizes").alias("other_sizes")
    )
    body = F.filter("lines", lambda _, i: F.get("sizes", i) > 0)
    witness = lines.select(F.col("key").alias("second"), body.alias("second_lines"))
    return (
        pairs.where("other IS NOT NULL")
        .join(own, "key")
        .withColumn("second", F.when(F.col("marked"), F.col("second")))
        .join(theirs, "other")
        .join(witness, "second", "left")
        .select(
            "key", "lines", "sizes", F.col("theirs").alias("other"), "other_sizes",
            F.col("second_lines").alias("second"), "marked",
        )
        .mapInArrow(_align, "key binary, shared array<int>, copy boolean")
    )


def _in_order(pages: DataFrame) -> DataFrame:
    """Pages in range-partitioned order, with the ``path`` and ``key`` of their neighbours."""
    order = ["host", "path", "key"]
    rows = pages.select(*order).repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    rows = stored(rows, "page-order")
    own = F.struct("path", "key")
    inside = Window.partitionBy("part", "host").orderBy("path", "key")
    ends = rows.groupBy("part", "host").agg(F.min(own).alias("first"), F.max(own).alias("last"))
    across = Window.partitionBy("host").orderBy("part")
    ends = ends.select(
        "part", "host", F.lag("last").over(across).alias("earlier"),
        F.lead("first").over(across).alias("later"),
    )
    return (
        rows.withColumn("before", F.lag(own).over(inside))
        .withColumn("after", F.lead(own).over(inside))
        .join(ends, ["part", "host"])
        .withColumn("before", F.coalesce("before", "earlier"))
        .withColumn("after", F.coalesce("after", "later"))
        .drop("earlier", "later")
    )


def _nearer(rows: DataFrame) -> DataFrame:
    """``key`` and ``other``, the key of ``before`` or ``after``."""

    def alike(side: str) -> Column:
        """Length of the common start of two paths; -1 without a page on that side."""
        other = F.col(side)["path"]
        n = F.when(other.isNotNull(), F.least(F.length("path"), F.length(other)))

        def longer(length: Column, step: Column) -> Column:
            """A further step if the starts still agree: the length is found bit by bit."""
            to = length + step
            agree = F.substring(F.col("path"), F.lit(1), to) == F.substring(other, F.lit(1), to)
            return F.when((to <= n) & agree, to).otherwise(length)

        steps = F.array(*[F.lit(1 << i) for i in reversed(range(31))])
        same = F.aggregate(steps, F.lit(0), longer)
        return F.when(n.isNotNull(), same).otherwise(-1)

    nearest = F.when(alike("before") >= alike("after"), F.col("before")).otherwise(F.col("after"))
    return rows.select("key", F.coalesce(nearest, F.col("before"))["key"].alias("other"))


def nearest_pages(pages: DataFrame) -> DataFrame:
    """Adds ``other``, the key of the nearest page, to rows of ``key``, ``host`` and ``path``.

    Nearest is the page before or after in the order of host and path with the longer common
    start of the path, ties to the one before; null for the only page of a host.
    """
    return _nearer(_in_order(pages))


def nearest_other_pages(lines: DataFrame) -> DataFrame:
    """As ``nearest_pages``, the nearest page outside the run of copies that a page is in, and
    ``second``, the page outside the run on the other side; beyond the nearest one if that side
    has none.

    A run begins with a page that is no copy of the one before it.
    """
    rows = _in_order(lines)
    pairs = rows.select(
        "key", F.col("before")["key"].alias("other"), F.lit(None).cast("binary").alias("second")
    )
    copies = _aligned(pairs, lines).where("copy").select("key", "copy")
    begin = F.struct("path", "key", "before")
    rows = rows.join(copies, "key", "left").select(
        "part", "host", "path", "key", F.when(F.col("copy").isNull(), begin).alias("begin")
    )
    rows = stored(rows, "page-runs")
    inside = Window.partitionBy("part", "host").orderBy("path", "key")
    back = Window.partitionBy("part", "host").orderBy(F.desc("path"), F.desc("key"))
    ends = rows.groupBy("part", "host").agg(F.min("begin").alias("first"), F.max("begin").alias("last"))
    across = Window.partitionBy("host").orderBy("part")
    across_back = Window.partitionBy("host").orderBy(F.desc("part"))
    before_this = (Window.unboundedPreceding, -1)
    ends = ends.select(
        "part", "host",
        F.last("last", True).over(across.rowsBetween(*before_this)).alias("earlier"),
        F.last("first", True).over(across_back.rowsBetween(*before_this)).alias("later"),
    )
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (
        rows.withColumn("own", F.last("begin", True).over(upto))
        .withColumn("next", F.last("begin", True).over(back.rowsBetween(*before_this)))
        .join(ends, ["part", "host"])
        .withColumn("own", F.coalesce("own", "earlier"))
        .withColumn("next", F.coalesce("next", "later"))
    )
    after = F.when(F.col("next").isNotNull(), F.struct("next.path", "next.key"))
    rows = rows.select("key", "path", F.col("own")["before"].alias("before"), after.alias("after"))
    rows = stored(rows, "page-neighbours")
    first, last = F.col("before")["key"], F.col("after")["key"]
    beyond = rows.select(
        F.col("key").alias("other"), first.alias("other_first"), last.alias("other_last")
    )
    sides = rows.select("key", first.alias("first"), last.alias("last"))
    second = (
        F.when(F.col("first").isNull(), F.col("other_last"))
        .when(F.col("last").isNull(), F.col("other_first"))
        .when(F.col("other") == F.col("first"), F.col("last"))
        .otherwise(F.col("first"))
    )
    pairs = _nearer(rows).join(sides, "key").join(beyond, "other", "left")
    return pairs.select("key", "other", second.alias("second"))


def _page_key(id_col: str, url_col: str, html: Column) -> Column:
    """128 bits from all that a page's text depends on, and its id."""
    fields = (F.col(id_col), F.col(url_col), html)
    parts = [F.xxhash64(F.lit(seed), *fields, F.col(url_col).isNull()) for seed in (1, 2)]
    return F.unhex(F.concat(*[F.lpad(F.hex(part), 16, "0") for part in parts]))


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``id``, ``url`` and ``text``, its lines joined by line feeds, of every row.

    A null page is empty and an empty page has an empty text. A page without a URL, or alone on
    its host, has no nearest page; nothing of it is shared. Rows equal in id, URL and page are
    one page for the comparison and separate rows of the result. Other columns are not looked at.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    url = F.col(url_col)
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    rows = pages.select(
        _page_key(id_col, url_col, html).alias("key"),
        F.col(id_col).alias("id"), url.alias("url"), html.alias("html"),
    )

    lines = (
        rows.select("key", host.alias("host"), path.alias("path"), "html")
        .mapInArrow(_line_hashes, "key binary, host string, path string, marked boolean, lines array<long>, sizes array<int>")
        .where("host <> ''")
        .dropDuplicates(["key"])
    )
    lines = stored(lines, "page-lines")
    shared = _aligned(nearest_other_pages(lines), lines)

    kept = ["key", "id", "url"]
    schema = T.StructType(
        [
            *rows.select(*kept).schema.fields,
            T.StructField("places", T.ArrayType(T.IntegerType())),
            T.StructField("lines", T.BinaryType()),
        ]
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "html"):
            places, lines = [], []
            for html in batch.column("html").to_pylist():
                own = candidate_lines(blocks(html))[1]
                places.append([i for i, _ in own])
                # Texts go through one shuffle only, which is made smaller by this.
                lines.append(zlib.compress("\n".join(t for _, t in own).encode(), 3))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept),
                    pa.array(places, pa.list_(pa.int32())), pa.array(lines, pa.binary()),
                ],
                names=schema.fieldNames(),
            )

    parsed = rows.mapInArrow(parse, schema)
    out = T.StructType([*schema.fields[1:3], T.StructField("text", T.StringType())])
    return parsed.join(shared, "key", "left").mapInArrow(_kept_texts, out)
