"""Take-up rate per offer."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.functions.dates import in_month
from uptake.functions.kpi import clamp_take_up_rate, take_up_rate, wltype_bucket
from uptake.operators.measures import OFFER
from uptake.operators.snapshots import at_dates, latest_dates, shifted

def tur_formulation(
    summary: DataFrame,
    wl_offer: DataFrame,
    taker_offer: DataFrame,
    month: date | None = None,
    late_days: int = 1,
) -> DataFrame:
    """Take-up rate of each campaign of the newest data day.

    Takers may be dated the same day or ``late_days`` later; where both snapshots exist the
    campaign has a row for each.
    """
    summary, wl_offer, taker_offer = (in_month(t, month) for t in (summary, wl_offer, taker_offer))
    newest = latest_dates(summary, "d_date")

    campaigns = (
        at_dates(summary, newest, "d_date")
        .select(
            "strmonth",
            "offer_id",
            "campaign_id",
            "tower",
            F.trim("campaign_initiatives").alias("campaign_initiatives"),
            "start_date",
            "end_date",
            "communication_channel",
            "wltype",
            "email_user",
            "d_date",
        )
        .distinct()
    )
    targets = at_dates(wl_offer, newest, "d_date").select(
        *OFFER,
        F.col("msisdn_wl").cast("double").alias("total_wl"),
        F.coalesce(F.nullif("msisdn_delivered", F.lit(0)), "msisdn_wl")
        .cast("double")
        .alias("delivered"),
    )
    takers = at_dates(taker_offer, shifted(newest, 0, late_days), "data_date").select(
        *OFFER, F.col("total_msisdn").cast("double").alias("taker"), "trx", "revenue"
    )
    rate = take_up_rate(F.col("taker"), F.col("delivered"), F.col("total_wl"))
    return (
        campaigns.join(targets, OFFER, "left")
        .join(takers, OFFER, "left")
        .select(
            "strmonth",
            "tower",
            "campaign_initiatives",
            "start_date",
            "end_date",
            "communication_channel",
            # Distinct offers of a group that is a single offer.
            F.when(F.col("offer_id").isNull(), 0).otherwise(1).cast("long").alias("totalcid"),
            "total_wl",
            F.col("total_wl").alias("eligible_wl"),
            "delivered",
            "taker",
            "trx",
            F.col("revenue").alias("rev"),
            "offer_id",
            "campaign_id",
            wltype_bucket(F.col("wltype")).alias("wltype"),
            "email_user",
            clamp_take_up_rate(rate).alias("tur"),
            "d_date",
        )
    )
