"""Campaign rows with the measures of their offer, the common input of the KPI summaries.

Target and taker snapshots are first summed per offer and then attached to each campaign row.
A KPI table is then one aggregation over one DataFrame. This equals joining each snapshot to
the campaigns and summing: an offer with several campaign rows counts once per row, and an
offer with several snapshot rows contributes their sum to each.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uptake.functions.dates import in_month
from uptake.functions.kpi import message_cost, wltype_bucket
from uptake.operators.snapshots import (
    at_dates,
    lagged_snapshot,
    latest_dates_by_data_day,
    latest_snapshot,
    latest_snapshot_tolerant,
)

OFFER = ["strmonth", "offer_id"]


def campaign_rows(rows: DataFrame, towers: Sequence[str]) -> DataFrame:
    """Campaigns of the towers, with the whitelist type as a bucket."""
    return rows.where(F.col("tower").isin(*towers)).withColumn(
        "wltype", wltype_bucket(F.col("wltype"))
    )


def full_month_inputs(summary, wl_offer, taker_offer, towers, month: date | None, late_days: int):
    """Newest snapshot of each table; takers also ``late_days`` after it."""
    summary, wl_offer, taker_offer = (in_month(t, month) for t in (summary, wl_offer, taker_offer))
    return (
        campaign_rows(latest_snapshot(summary), towers),
        latest_snapshot(wl_offer, summary),
        latest_snapshot_tolerant(taker_offer, summary, late_days),
    )


def month_to_date_inputs(summary, wl_offer, taker_offer, towers, month: date | None):
    """Newest campaigns with the facts that were extracted two days before."""
    summary, wl_offer, taker_offer = (in_month(t, month) for t in (summary, wl_offer, taker_offer))
    return (
        campaign_rows(latest_snapshot(summary), towers),
        lagged_snapshot(wl_offer, summary),
        lagged_snapshot(taker_offer, summary),
    )


def same_day_inputs(summary, wl_offer, taker_offer, towers, month: date | None):
    """All three tables at the newest extract of the newest data day."""
    summary, wl_offer, taker_offer = (in_month(t, month) for t in (summary, wl_offer, taker_offer))
    newest = latest_dates_by_data_day(summary)
    return (
        campaign_rows(at_dates(summary, newest), towers),
        at_dates(wl_offer, newest),
        at_dates(taker_offer, newest),
    )


def with_offer_measures(
    campaigns: DataFrame, wl_offer: DataFrame, taker_offer: DataFrame
) -> DataFrame:
    """Campaign rows with target, delivery and taker sums of their offer."""
    wl, delivered = F.col("msisdn_wl"), F.col("msisdn_delivered")
    targets = wl_offer.groupBy(*OFFER).agg(
        F.count("*").alias("target_rows"),
        F.sum(wl).alias("target"),
        F.sum(delivered).alias("delivered"),
        F.sum(F.when(delivered == 0, wl).otherwise(delivered)).alias("billable"),
    )
    takers = taker_offer.groupBy(*OFFER).agg(
        F.count("*").alias("taker_rows"),
        F.sum("total_msisdn").alias("taker"),
        F.sum("trx").alias("trx"),
        F.sum("revenue").alias("revenue"),
    )
    return campaigns.join(targets, OFFER, "left").join(takers, OFFER, "left")


def trackable_counts() -> tuple[Column, Column]:
    """Campaign-taker pairs that matched, and all pairs of a left join of the two."""
    matched = F.sum(F.coalesce("taker_rows", F.lit(0)))
    pairs = F.sum(
        F.when(
            F.col("offer_id").isNotNull(), F.greatest(F.coalesce("taker_rows", F.lit(0)), F.lit(1))
        )
    )
    return matched, pairs


def cost() -> Column:
    return F.sum(F.col("billable") * message_cost(F.col("communication_channel")))


def billed_rows() -> Column:
    """Campaign rows on a channel that costs money and with a target."""
    billed = message_cost(F.col("communication_channel")).isNotNull()
    return F.sum(F.when(billed, F.col("target_rows")))
