"""Dates that follow from the day a daily run starts."""

from __future__ import annotations

from datetime import date, timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uptake.functions.constants import EXTRACT_LAG_DAYS


class RunDates(NamedTuple):
    extract_date: date
    data_date: date
    strmonth: date
    wl_dim_date: date
    taker_dim_date: date


def run_dates(run_date: date) -> RunDates:
    """Parameters of one run: data day, campaign month and the two dimension snapshots."""
    data_date = run_date - timedelta(days=EXTRACT_LAG_DAYS)
    strmonth = data_date.replace(day=1)
    return RunDates(
        run_date, data_date, strmonth, strmonth, run_date.replace(day=1) - timedelta(days=1)
    )


def with_run_dates(df: DataFrame, run_date: str) -> DataFrame:
    """The same four dates as columns, for a column of run dates."""
    run = F.col(run_date).cast("date")
    data_date = F.date_sub(run, EXTRACT_LAG_DAYS)
    return df.withColumns(
        {
            "extract_date": run,
            "data_date": data_date,
            "strmonth": month_of(data_date),
            "wl_dim_date": month_of(data_date),
            "taker_dim_date": F.last_day(F.add_months(run, -1)),
        }
    )


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def in_month(df: DataFrame, month: date | None, column: str = "strmonth") -> DataFrame:
    """Rows of one month (a partition predicate), or of all months if none is given."""
    return df if month is None else df.where(F.col(column) == F.lit(month))


def tagged(
    df: DataFrame,
    extract_date: date | None,
    data_date: date | None = None,
    data_name: str = "d_date",
) -> DataFrame:
    """Put the extract and data day in front of the columns."""
    if extract_date is None:
        return df
    data_date = data_date or extract_date - timedelta(days=EXTRACT_LAG_DAYS)
    return df.select(
        F.lit(extract_date).alias("extract_date"), F.lit(data_date).alias(data_name), "*"
    )
