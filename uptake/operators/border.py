"""Takers and targets per geography value and campaign attributes.

All levels are computed together with ``level`` as a key. Stored partitioned by level, the
result replaces one table per level.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uptake.functions.constants import CORE_TOWERS, LEVELS
from uptake.functions.dates import in_month
from uptake.operators.measures import OFFER, campaign_rows
from uptake.operators.snapshots import at_dates, latest_dates, latest_dates_by_data_day

CELL = ["border", "tower", "wltype", "campaign_initiatives"]


def _newest(summary: DataFrame, mtd: bool) -> DataFrame:
    return latest_dates_by_data_day(summary) if mtd else latest_dates(summary)


def _weighted_campaigns(rows: DataFrame, day: list[str]) -> DataFrame:
    """Distinct campaign attributes per offer with the number of campaign rows behind them.

    An offer with many campaign rows then meets its geography values once, not once per row.
    """
    attributes = [*OFFER, *day, *CELL[1:]]
    return (
        campaign_rows(rows, CORE_TOWERS).groupBy(*attributes).agg(F.count("*").alias("campaigns"))
    )


def _weighted_sum(column: str, name: str) -> Column:
    return F.sum(F.col(column) * F.col("campaigns")).alias(name)


def _at_levels(border: DataFrame, newest: DataFrame) -> DataFrame:
    return at_dates(border.where(F.col("level").isin(*LEVELS)), newest)


def border_taker(
    summary: DataFrame, taker_border: DataFrame, month: date | None = None, mtd: bool = False
) -> DataFrame:
    """Revenue, transactions and takers per level and border, at the newest snapshot."""
    summary, taker_border = in_month(summary, month), in_month(taker_border, month)
    newest = _newest(summary, mtd)
    day = ["d_date"] if mtd else []
    return (
        _weighted_campaigns(at_dates(summary, newest), day)
        .join(
            _at_levels(taker_border, newest).select(
                *OFFER, "level", "border", "total_msisdn", "trx", "revenue"
            ),
            OFFER,
        )
        .groupBy("level", *day, "strmonth", *CELL)
        .agg(
            _weighted_sum("revenue", "revenue"),
            _weighted_sum("trx", "trx"),
            _weighted_sum("total_msisdn", "unique_taker"),
        )
    )


def border_wl(
    summary: DataFrame,
    wl_border: DataFrame,
    month: date | None = None,
    mtd: bool = False,
    all_snapshots: bool = False,
) -> DataFrame:
    """Targets and deliveries per level and border, at the newest snapshot.

    ``all_snapshots`` joins the newest targets to the campaign rows of every snapshot, which
    counts an offer once per snapshot it appears in.
    """
    summary, wl_border = in_month(summary, month), in_month(wl_border, month)
    newest = _newest(summary, mtd)
    day = ["d_date"] if mtd else []
    rows = summary if all_snapshots else at_dates(summary, newest)
    return (
        _weighted_campaigns(rows, day)
        .join(
            _at_levels(wl_border, newest).select(
                *OFFER, "level", "border", "total_msisdn", "msisdn_delivered"
            ),
            OFFER,
        )
        .groupBy("level", *day, "strmonth", *CELL)
        .agg(
            _weighted_sum("total_msisdn", "total_target"),
            _weighted_sum("msisdn_delivered", "total_delivered"),
        )
    )


def border_of_level(borders: DataFrame, level: str) -> DataFrame:
    """One level, with the border under the level's own name."""
    return (
        borders.where(F.col("level") == level).drop("level").withColumnRenamed("border", level)
    )
