"""Reach of a campaign's whitelist (targeted subscribers).

``by`` names further columns to group by, such as the extract date of a table that holds
several snapshots.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uptake.functions.constants import LEVELS
from uptake.functions.dates import in_month, tagged
from uptake.operators.geography import at_date, level_first, spread_over_levels


def _offered(wl: DataFrame, month: date | None) -> DataFrame:
    return in_month(wl, month).where(F.col("offer_id").isNotNull())


def wl_by_offer(
    wl: DataFrame,
    month: date | None = None,
    extract_date: date | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Distinct targeted and distinct delivered subscribers per offer.

    A message normally goes to the subscriber it was meant for, so a row gives one record of a
    subscriber who was targeted and maybe delivered, and only a row delivered to someone else
    gives two. Two ``count(DISTINCT)`` would double every row before the shuffle.
    """
    keys = [*by, "strmonth", "offer_id"]
    targeted, delivered = F.col("msisdn_wl"), F.col("msisdn_delivered")

    def record(msisdn: Column, wl: Column, got: Column) -> Column:
        return F.struct(msisdn.alias("msisdn"), wl.alias("wl"), got.alias("got"))

    yes, no = F.lit(True), F.lit(False)
    records = F.when(
        delivered.isNull() | delivered.eqNullSafe(targeted),
        F.array(record(targeted, yes, delivered.isNotNull())),
    ).otherwise(F.array(record(targeted, yes, no), record(delivered, no, yes)))
    known = F.col("msisdn").isNotNull()
    reach = (
        _offered(wl, month)
        .select(*keys, F.inline(records))
        .groupBy(*keys, "msisdn")
        .agg(F.max("wl").alias("wl"), F.max("got").alias("got"))
        .groupBy(*keys)
        .agg(
            F.count_if(known & F.col("wl")).alias("msisdn_wl"),
            F.count_if(known & F.col("got")).alias("msisdn_delivered"),
        )
    )
    return tagged(reach, extract_date)


def wl_total_by_offer(
    wl: DataFrame,
    extract_date: date,
    data_date: date,
    month: date | None = None,
) -> DataFrame:
    """Distinct targeted subscribers per offer."""
    total = (
        _offered(wl, month)
        .groupBy("strmonth", "offer_id")
        .agg(F.countDistinct("msisdn_wl").alias("total_wl"))
    )
    return tagged(total, extract_date, data_date, "data_date")


def wl_border(
    wl: DataFrame,
    dim: DataFrame,
    month: date | None = None,
    extract_date: date | None = None,
    dim_date: date | None = None,
    levels: Sequence[str] = LEVELS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Targeted and delivered subscribers per offer and geography value, for each level.

    Subscribers are made distinct before the join with the dimension: that also limits a
    subscriber who holds a large part of the rows to one row per offer. Further attributes,
    such as ``los``, can be levels of the same pass.
    """
    keys = [*by, "strmonth", "offer_id"]
    targeted = (
        _offered(wl, month)
        .groupBy(*keys, F.col("msisdn_wl").alias("msisdn"))
        .agg(F.max("msisdn_delivered").alias("msisdn_delivered"))
    )
    reach = (
        spread_over_levels(targeted, at_date(dim, dim_date), levels)
        .groupBy("level", *keys, "border")
        .agg(
            F.count("*").alias("total_msisdn"),
            F.count("msisdn_delivered").alias("msisdn_delivered"),
        )
    )
    return level_first(tagged(reach, extract_date))


def wl_by_attribute(
    wl: DataFrame,
    dim: DataFrame,
    attribute: str,
    month: date | None = None,
    extract_date: date | None = None,
    dim_date: date | None = None,
) -> DataFrame:
    """``wl_border`` for one attribute of the dimension, under the attribute's own name."""
    reach = wl_border(wl, dim, month, extract_date, dim_date, [attribute])
    return reach.drop("level").withColumnRenamed("border", attribute)


def wl_kabupaten(wl: DataFrame, dim: DataFrame, **options) -> DataFrame:
    return wl_by_attribute(wl, dim, "kabupaten", **options)


def wl_region(wl: DataFrame, dim: DataFrame, **options) -> DataFrame:
    return wl_by_attribute(wl, dim, "region_sales", **options)


def wl_los(wl: DataFrame, dim: DataFrame, **options) -> DataFrame:
    """By length of stay."""
    return wl_by_attribute(wl, dim, "los", **options)


def _offers_per_subscriber(wl: DataFrame, month: date | None) -> DataFrame:
    return (
        in_month(wl, month)
        .where(F.col("msisdn_wl").isNotNull())
        .groupBy("strmonth", "start_date", "msisdn_wl")
        .agg(F.countDistinct("offer_id").alias("total_offer"))
    )


def wl_recurring(
    wl: DataFrame, month: date | None = None, extract_date: date | None = None
) -> DataFrame:
    """How many subscribers got 1, 2, 3... distinct offers that start on the same day.

    A subscriber is one row per day after the first step, so a plain count is distinct.
    """
    histogram = (
        _offers_per_subscriber(wl, month)
        .groupBy("strmonth", "start_date", "total_offer")
        .agg(F.count("msisdn_wl").alias("recurring_msisdn"))
    )
    return tagged(histogram, extract_date)


def wl_recurring_kabupaten(
    wl: DataFrame,
    dim: DataFrame,
    month: date | None = None,
    extract_date: date | None = None,
    dim_date: date | None = None,
) -> DataFrame:
    """``wl_recurring`` per kabupaten. Offers are counted before the join, on fewer rows."""
    homes = at_date(dim, dim_date).select(
        F.col("msisdn").alias("msisdn_wl"), "kabupaten"
    ).distinct()
    histogram = (
        _offers_per_subscriber(wl, month)
        .join(homes, "msisdn_wl", "left")
        .groupBy("strmonth", "start_date", "kabupaten", "total_offer")
        .agg(F.count("msisdn_wl").alias("recurring_msisdn"))
    )
    return tagged(histogram, extract_date)


def wl_first_touch_attribution(
    wl: DataFrame, month: date | None = None, by: Sequence[str] = ("strmonth",)
) -> DataFrame:
    """Credit each subscriber to the offer that started first, ties to the smallest offer id.

    The smallest (start, offer) pair is a plain minimum, combined before the shuffle: no
    window sorts all rows of a subscriber. An offer without any start date ranks first.
    """
    starts = (
        _offered(wl, month)
        .groupBy(*by, "msisdn_wl", "offer_id")
        .agg(F.min("start_date").alias("start_date"))
    )
    first = starts.groupBy(*by, "msisdn_wl").agg(
        F.min(F.struct("start_date", "offer_id"))["offer_id"].alias("offer_id")
    )
    return first.groupBy(*by, "offer_id").agg(F.count("msisdn_wl").alias("total_msisdn"))
