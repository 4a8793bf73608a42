"""Choosing among daily snapshots.

Every daily extract appends a full copy of the month tagged with its extract date. The chosen
dates form a table of at most two rows per campaign month, so the calendar bounds its size,
not the data: 2,400 rows in a century of months, and 7 million for every day a date can hold.
It is broadcast, and the snapshots are filtered where they are read. A shuffle instead would
put each snapshot into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uptake.functions.constants import EXTRACT_LAG_DAYS

MONTH = "strmonth"


def latest_dates(snapshots: DataFrame, date_col: str = "extract_date") -> DataFrame:
    """The newest snapshot date of each month."""
    return snapshots.groupBy(MONTH).agg(F.max(date_col).alias(date_col))


def latest_dates_by_data_day(snapshots: DataFrame) -> DataFrame:
    """The newest extract date among the rows of the newest data day."""
    newest = F.max(F.struct("d_date", "extract_date"))
    return snapshots.groupBy(MONTH).agg(newest["extract_date"].alias("extract_date"))


def at_dates(df: DataFrame, dates: DataFrame, date_col: str = "extract_date") -> DataFrame:
    """Rows of the chosen snapshots. ``dates`` has the month and one date column."""
    chosen = dates.toDF(MONTH, date_col)
    return df.join(F.broadcast(chosen), [MONTH, date_col], "left_semi")


def shifted(dates: DataFrame, *days: int) -> DataFrame:
    """Each chosen date moved by each number of days."""
    month, day = dates.columns
    moved: list[Column] = [F.date_add(day, n) for n in days]
    return dates.select(month, F.explode(F.array_distinct(F.array(*moved))).alias(day))


def latest_snapshot(
    df: DataFrame, of: DataFrame | None = None, date_col: str = "extract_date"
) -> DataFrame:
    """Rows of the newest snapshot of ``of`` (by default of the table itself)."""
    return at_dates(df, latest_dates(df if of is None else of), date_col)


def latest_snapshot_tolerant(
    df: DataFrame, of: DataFrame, late_days: int, date_col: str = "extract_date"
) -> DataFrame:
    """Also the rows tagged ``late_days`` later. Where both snapshots exist, both are kept."""
    return at_dates(df, shifted(latest_dates(of), 0, late_days), date_col)


def lagged_snapshot(
    df: DataFrame, of: DataFrame, lag_days: int = EXTRACT_LAG_DAYS, date_col: str = "extract_date"
) -> DataFrame:
    """Rows tagged ``lag_days`` before the newest snapshot of ``of``."""
    return at_dates(df, shifted(latest_dates(of), -lag_days), date_col)
