"""Row numbering and carrying values forward over rows in a global order.

A window over the whole order would run in one task. Here the order is cut into chunks: each
chunk is summed up in one row, only those rows go through the global window, and the rows
inside a chunk are handled in parallel. ``chunk`` must sort the chunks, ``ordinal`` the rows
inside one; a chunk should hold no more rows than a task can sort, such as an input split or
a million consecutive positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_ROWS = 1_000_000


def chunk_of(ordinal: str, rows: int = CHUNK_ROWS) -> Column:
    """Chunk number of a row position."""
    return F.floor(F.col(ordinal) / rows)


def _before(by: Sequence[str], chunk: Sequence[str]):
    return (
        Window.partitionBy(*by).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    )


def consecutive_ids(
    df: DataFrame, chunk: Sequence[str], ordinal: str, name: str = "id", after: Column | None = None
) -> DataFrame:
    """Number the rows 1, 2, 3... in order, or onwards from the value of ``after``."""
    sizes = df.groupBy(*chunk).agg(F.count("*").alias("_size"))
    starts = sizes.select(
        *chunk, F.coalesce(F.sum("_size").over(_before([], chunk)), F.lit(0)).alias("_start")
    )
    first = F.lit(0) if after is None else after
    within = F.row_number().over(Window.partitionBy(*chunk).orderBy(ordinal))
    return (
        df.join(starts, list(chunk))
        .withColumn(name, F.col("_start") + within + F.coalesce(first, F.lit(0)))
        .drop("_start")
    )


def carry_forward(
    df: DataFrame, value: Column, name: str, by: Sequence[str], chunk: Sequence[str], ordinal: str
) -> DataFrame:
    """The last non-null value at or before each row, among the rows with equal ``by``."""
    df = df.withColumn("_value", value)
    lasts = df.groupBy(*by, *chunk).agg(
        F.max(F.when(F.col("_value").isNotNull(), F.struct(ordinal, "_value")))["_value"].alias(
            "_last"
        )
    )
    carried = lasts.select(
        *by, *chunk, F.last("_last", ignorenulls=True).over(_before(by, chunk)).alias("_carried")
    )
    within = Window.partitionBy(*by, *chunk).orderBy(ordinal).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        df.join(carried, [*by, *chunk])
        .withColumn(
            name, F.coalesce(F.last("_value", ignorenulls=True).over(within), F.col("_carried"))
        )
        .drop("_value", "_carried")
    )
