"""Joins by time (the last row before, the ranges around a point), sessions, frames of days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uptake.functions.ordered import carry_forward

CHUNK_DAYS = 32
MOST_LEVELS = 32


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_day: str,
    right_day: str,
    columns: Sequence[str],
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """All rows of ``left`` with the ``columns`` of the last row of ``right`` that has equal keys
    ``by`` and a day not after ``left_day``; null without one.

    Of several rows on that day the one counts whose ``columns`` are greatest, compared in order
    with nulls first. A null key or day matches nothing. Both sides are merged by key and day,
    and the latest values carried forward. A key is cut into chunks of ``chunk_days`` days, one
    task each, and only a chunk's last value passes to the next, so a key may have any share
    of the rows.
    """
    taken = F.struct(*columns).alias("_taken")
    row = F.struct(*[left[f"`{c}`"] for c in left.columns]).alias("_row")
    usable = F.col(left_day).isNotNull()
    for c in by:
        usable = usable & F.col(c).isNotNull()
    keys = [F.col(c).alias(f"_{i}") for i, c in enumerate(by)]
    names = [f"_{i}" for i in range(len(by))]
    ours = left.where(usable).select(*keys, F.col(left_day).cast("date").alias("_day"), row)
    theirs = right.dropna(subset=[*by, right_day]).select(
        *keys, F.col(right_day).cast("date").alias("_day"), taken
    )
    # One row per key and day: the greatest.
    theirs = theirs.groupBy(*names, "_day").agg(F.max("_taken").alias("_taken"))
    both = ours.unionByName(theirs, allowMissingColumns=True).withColumns(
        {
            "_chunk": F.floor(F.unix_date("_day") / chunk_days),
            "_order": F.struct("_day", F.col("_row").isNotNull().alias("left")),
        }
    )
    carried = carry_forward(both, F.col("_taken"), "_last", names, ["_chunk"], "_order")
    matched = carried.where(F.col("_row").isNotNull()).select("_row", "_last")
    none = F.lit(None).cast(both.schema["_taken"].dataType).alias("_last")
    rest = left.where(~F.coalesce(usable, F.lit(False))).select(row, none)
    return matched.unionByName(rest).select("_row.*", *[F.col("_last")[c].alias(c) for c in columns])


def _level(days: Column) -> Column:
    """The least power of two, as an exponent, that is at least a number of days above 0."""
    return F.length(F.bin(days - 1)) * (days > 1).cast("int")


def interval_join(
    points: DataFrame, ranges: DataFrame, by: Sequence[str], day: str, start: str, end: str
) -> DataFrame:
    """Every row of ``points`` with every row of ``ranges`` that has equal keys ``by`` and a range
    ``start`` to ``end``, both included, around ``day``: the columns of both, keys once.

    Null keys, days or ends match nothing, nor does a range that ends before it starts. The
    calendar is cut into buckets of 1, 2, 4, ... days. A range lies in at most two buckets of the
    first size that is not shorter than it; a point is in one bucket of each size that some range
    needs. So a row becomes at most two, or one per size, whatever its length, and a pair meets
    once. A key with many rows is spread over its buckets.
    """
    length = F.datediff(end, start) + 1
    sized = ranges.where(length > 0).withColumn("_level", _level(length))

    def bucket(of: Column) -> Column:
        return F.floor(F.unix_date(of) / F.pow(F.lit(2), F.col("_level")))

    first, last = bucket(F.col(start).cast("date")), bucket(F.col(end).cast("date"))
    placed = sized.withColumn("_bucket", F.explode(F.sequence(first, last)))
    levels = sorted(r["_level"] for r in sized.select("_level").distinct().limit(MOST_LEVELS).collect())
    each = F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>"))
    spread = points.dropna(subset=[day]).withColumn("_level", each)
    spread = spread.withColumn("_bucket", bucket(F.col(day).cast("date")))
    return (
        spread.join(placed, [*by, "_level", "_bucket"])
        .where(F.col(day).between(F.col(start), F.col(end)))
        .drop("_level", "_bucket")
    )


def day_sessions(df: DataFrame, by: Sequence[str], day: str, gap_days: int) -> DataFrame:
    """Runs of rows per key of which no two neighbours are more than ``gap_days`` days apart: ``by``,
    ``first_day``, ``last_day``, ``days`` (different ones) and ``rows``.

    Rows are counted per key and day before they are brought together, so a key has a row per day
    at most, whatever its share. A null key is a key; rows without a day are left out.
    """
    daily = (
        df.where(F.col(day).isNotNull())
        .groupBy(*by, F.col(day).cast("date").alias("_day"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    at = F.col("_day").cast("timestamp_ntz")
    return (
        daily.groupBy(*by, F.session_window(at, f"{gap_days} days").alias("_session"))
        .agg(
            F.min("_day").alias("first_day"), F.max("_day").alias("last_day"),
            F.count(F.lit(1)).alias("days"), F.sum("_rows").alias("rows"),
        )
        .drop("_session")
    )


def rolling_reach(
    df: DataFrame, by: Sequence[str], day: str, member: str, days: int
) -> DataFrame:
    """``by``, ``day``, ``reach`` (different members seen on that day or the ``days`` - 1 days before
    it) and ``rows`` (in the same frame), for every day on which ``by`` has a row.

    A member's rows are one per day first. Each such day reaches ``days`` days ahead, or until the
    member's next one; the ends are summed per key and day and added up in order. So no frame holds
    members: a key has two rows per day of the calendar, a member one per day, whatever their
    share. A null key is a key; rows without a day are left out, null members are not counted.
    """
    daily = (
        df.where(F.col(day).isNotNull())
        .groupBy(*by, F.col(day).cast("date").alias("_day"), F.col(member).alias("_member"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    upcoming = F.lead("_day").over(Window.partitionBy(*by, "_member").orderBy("_day"))
    until = F.least(F.date_add("_day", days), upcoming)  # the least of those that are not null
    daily = daily.withColumns({"_until": until, "_end": F.date_add("_day", days)})
    one, none = F.col("_member").isNotNull().cast("long"), F.lit(0).cast("long")

    def change(at: str, members: Column, rows: Column) -> Column:
        own = F.lit(at == "_day")
        return F.struct(
            F.col(at).alias("_at"), members.alias("_one"), rows.alias("_n"), own.alias("_own")
        )

    ends = F.array(
        change("_day", one, F.col("_rows")), change("_until", -one, none), change("_end", none, -F.col("_rows"))
    )
    changes = (
        daily.select(*by, F.inline(ends))
        .groupBy(*by, "_at")
        .agg(F.sum("_one").alias("_one"), F.sum("_n").alias("_n"), F.max("_own").alias("_own"))
    )
    so_far = Window.partitionBy(*by).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    summed = changes.withColumns({"reach": F.sum("_one").over(so_far), "rows": F.sum("_n").over(so_far)})
    return summed.where("_own").select(*by, F.col("_at").alias(day), "reach", "rows")


def days_since_last(df: DataFrame, by: Sequence[str], day: str) -> DataFrame:
    """``by``, ``day``, ``rows`` of that day and ``days_since`` the key's last earlier day, null for
    the first one.

    A key has a row per day before it is put in order. A null key is a key; rows without a day are
    left out.
    """
    daily = (
        df.where(F.col(day).isNotNull())
        .groupBy(*by, F.col(day).cast("date").alias("_day"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    last = F.lag("_day").over(Window.partitionBy(*by).orderBy("_day"))
    return daily.select(*by, F.col("_day").alias(day), "rows", F.datediff("_day", last).alias("days_since"))
