"""Tables kept between the jobs of an operator, and what the numpy steps share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from uptake.sources.files import scratch_path


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application.

    Operators that run Python in tasks import it there. An archive of its sources goes to
    Spark's own file server, so nothing has to be installed on the executors.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="uptake-"), "uptake.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, root))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A function of a session and more that first gives the executors this package."""

    @wraps(query)
    def run(spark: SparkSession, *args) -> DataFrame:
        ship(spark)
        return query(spark, *args)

    return run


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: later jobs start from the files.

    Columns of ``partition_by`` become folders; a filter on them reads only its own.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, partitionBy=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def power_of_two(x: float) -> int:
    """The smallest power of two that is at least ``x``."""
    return 1 << max(0, int(np.ceil(np.log2(max(x, 1)))))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow text column without nulls, and where each text starts."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to some megabytes of text each, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = text_bytes(batch.column(column))[1][1:]
        a = 0
        while a < len(ends):
            before = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(a, b - a)
            a = b


BITMAP_BITS = 1 << 22


def bitmaps_of(df: DataFrame, column: str, bits: int, chosen: list[Column]) -> list[np.ndarray]:
    """A bit for the lower bits of every hash of a column, in a bitmap for each condition of
    ``chosen``; ``bits`` is a power of two, at least 2 ** 15.

    They are gathered in blocks of 4 KB. A word that is not in the bitmap is not in the column.
    """
    bit = F.col(column).bitwiseAND(bits - 1) + 1
    place = F.bitmap_bit_position(bit)
    blocks = (
        df.groupBy(F.bitmap_bucket_number(bit).alias("block"))
        .agg(*[F.bitmap_construct_agg(F.when(c, place)).alias(f"b{i}") for i, c in enumerate(chosen)])
        .collect()
    )
    whole = [np.zeros(bits // 8, np.uint8) for _ in chosen]
    for r in blocks:
        for bitmap, part in zip(whole, r[1:], strict=True):
            size = len(part)
            bitmap[(r["block"] - 1) * size : r["block"] * size] = np.frombuffer(part, np.uint8)
    return whole


def bitmap_of(df: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """One bitmap of all hashes of a column, half a megabyte unless ``bits`` says otherwise."""
    return bitmaps_of(df, column, bits, [F.lit(True)])[0]


def bits_set(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = (hashes & np.uint64(8 * len(bitmap) - 1)).astype(np.int64)
    return bitmap[bit >> 3] >> (bit & 7) & 1 > 0


def runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and length of every run of equal values."""
    if not len(sorted_values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])
    return first, np.diff(np.r_[first, len(sorted_values)])
