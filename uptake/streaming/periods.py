"""Windows and first touches over streams of files.

Every result is an aggregation by event time with a watermark. A group whose time has passed the
watermark is closed: it is written once, to a Parquet sink, and leaves the state. ``advance`` runs
a query until the files that are there are used up and goes on from its checkpoint the next time.
``so_far`` is the whole result at that moment: what is closed, and from the state store what is
still open. Aggregates are combined in the tasks that read the files, so a key with any share of
the rows reaches its state as one row a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def instant(day: Column) -> Column:
    """Midnight of a day in UTC, whatever the session's time zone."""
    return F.timestamp_seconds(F.unix_date(day.cast("date")) * F.lit(86_400).cast("long"))


def utc_day(at: Column) -> Column:
    """The day that ``instant`` made a moment of."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(at) / 86_400).cast("int"))


def windowed(
    stream: DataFrame,
    day: str,
    by: Sequence[str],
    size_days: int,
    slide_days: int | None = None,
    late_days: int = 0,
    sums: Sequence[str] = (),
) -> DataFrame:
    """``period`` (a window of days as moments in UTC, its end excluded), ``by``, ``rows`` and the sums of whole
    numbers ``sums``, per tumbling or, with ``slide_days``, sliding window.

    Windows are aligned to 1970-01-01. A row is late for a window that has ended ``late_days`` or
    more before the newest day of an earlier run; see ``late_rows``. Rows without a day are left
    out; a null key is a key.
    """
    period = F.window("_at", f"{size_days} days", f"{slide_days or size_days} days").alias("period")
    return (
        stream.where(F.col(day).isNotNull())
        .withColumn("_at", instant(F.col(day)))
        .withWatermark("_at", f"{late_days} days")
        .groupBy(period, *by)
        .agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in sums])
    )


def first_touch(
    stream: DataFrame, day: str, by: Sequence[str], touch: str, late_days: int = 31
) -> DataFrame:
    """``month_end`` (a moment in UTC), ``by`` and ``first`` (``day``, ``touch``): the earliest touch of a key in every
    month, ties to the smallest.

    The state of a key goes ``late_days`` after its month's end, in terms of the ends of the months
    that were read. Rows without a day are left out.
    """
    return (
        stream.where(F.col(day).isNotNull())
        .withColumn("month_end", instant(F.last_day(day)))
        .withWatermark("month_end", f"{late_days} days")
        .groupBy("month_end", *by)
        .agg(F.min(F.struct(day, touch)).alias("first"))
    )


def advance(result: DataFrame, path: str, checkpoint: str) -> None:
    """Read the files that have come since the last run with this checkpoint, write the groups
    that are closed by now to ``path`` and keep the others in the checkpoint.

    A run that fails is repeated from the checkpoint; the sink's log counts the files of a batch
    once.
    """
    (
        result.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
        .awaitTermination()
    )


def so_far(spark: SparkSession, result: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """The closed and the open groups of a ``result`` that has been advanced, which ``closed`` tells.

    Counts, sums, minima and maxima only: their state is their value so far.
    """
    closed = spark.read.schema(result.schema).parquet(path)
    state = spark.read.format("statestore").load(checkpoint)
    parts = [F.col(side)[f.name] for side in ("key", "value") for f in state.schema[side].dataType]
    opened = state.select(*[p.alias(c) for p, c in zip(parts, result.columns, strict=True)])
    return closed.withColumn("closed", F.lit(True)).unionByName(
        opened.withColumn("closed", F.lit(False))
    )


def late_rows(rows_read: int, groups: DataFrame, windows_a_row: int = 1) -> int:
    """How many times a row came too late for a window, of ``windows_a_row`` that it is in: the rows
    read that have a day, less those counted in ``groups``."""
    counted = groups.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()["rows"]
    return rows_read * windows_a_row - counted
