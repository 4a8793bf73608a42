"""KPI summaries per channel, product and kabupaten, with tower and whitelist-type subtotals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uptake.functions.constants import ALL, CORE_TOWERS
from uptake.functions.dates import in_month
from uptake.functions.grouping import TOWER_WLTYPE_SETS, rollup_sets
from uptake.functions.kpi import exact_mean, percent, ratio
from uptake.operators.measures import (
    OFFER,
    billed_rows,
    campaign_rows,
    cost,
    full_month_inputs,
    month_to_date_inputs,
    with_offer_measures,
)
from uptake.operators.snapshots import latest_snapshot


def _inputs(summary, wl_offer, taker_offer, month, mtd, late_days):
    if mtd:
        return month_to_date_inputs(summary, wl_offer, taker_offer, CORE_TOWERS, month)
    return full_month_inputs(summary, wl_offer, taker_offer, CORE_TOWERS, month, late_days)


def _where_known(key: str, value: str) -> Column:
    """A null key equals nothing, so its row gets no value from another table."""
    return F.when(F.col(key).isNotNull(), F.col(value)).alias(value)


def summary_channel(
    summary: DataFrame,
    wl_offer: DataFrame,
    taker_offer: DataFrame,
    tur: DataFrame,
    month: date | None = None,
    mtd: bool = False,
    late_days: int = 1,
) -> DataFrame:
    """Target, takers, transactions, take-up rate, revenue and their ratios per channel.

    Month-to-date rows carry the data day, use the lagged facts, and put campaigns without a
    channel under 'ALL'.
    """
    campaigns, wl_offer, taker_offer = _inputs(
        summary, wl_offer, taker_offer, month, mtd, late_days
    )
    rates = in_month(tur, month).where(F.col("tower").isin(*CORE_TOWERS))
    if mtd:
        known = F.coalesce("communication_channel", F.lit(ALL))
        campaigns = campaigns.withColumn("communication_channel", known)
        rates = rates.withColumn("communication_channel", known)

    day = ["d_date"] if mtd else []
    totals = rollup_sets(
        with_offer_measures(campaigns, wl_offer, taker_offer),
        [*day, "strmonth", "communication_channel"],
        TOWER_WLTYPE_SETS,
        {
            "target_rows": F.sum("target_rows"),
            "total_target": F.sum("target"),
            "taker": F.sum("taker"),
            "trx": F.sum("trx"),
            "revenue": F.sum("revenue"),
        },
    ).where("target_rows > 0")
    channel = "communication_channel"
    mean_rate = rollup_sets(
        rates, ["strmonth", channel], TOWER_WLTYPE_SETS, {"tur": exact_mean(F.col("tur"))}
    )
    return (
        totals.join(mean_rate, ["strmonth", "tower", "wltype", channel], "left")
        .select(
            *day,
            "strmonth",
            "tower",
            "wltype",
            channel,
            "total_target",
            *[_where_known(channel, c) for c in ("taker", "trx", "tur", "revenue")],
        )
        .withColumns(
            {
                "revenue_per_taker": ratio(F.col("revenue"), F.col("taker")),
                "revenue_per_trx": ratio(F.col("revenue"), F.col("trx")),
                "trx_per_taker": ratio(F.col("trx"), F.col("taker")),
            }
        )
    )


def summary_product(
    summary: DataFrame,
    wl_offer: DataFrame,
    taker_offer: DataFrame,
    tur: DataFrame,
    month: date | None = None,
    mtd: bool = False,
    late_days: int = 1,
    how: str = "inner",
) -> DataFrame:
    """Target, take-up rate, revenue, message cost and delivery rate per product.

    ``how='inner'`` keeps a product only where it has targets, takers, a take-up rate row and
    a channel that costs money; ``how='left'`` keeps every product with targets.
    """
    campaigns, wl_offer, taker_offer = _inputs(
        summary, wl_offer, taker_offer, month, mtd, late_days
    )
    rates = (
        in_month(tur, month)
        .groupBy(*OFFER)
        .agg(
            F.count("*").alias("tur_rows"),
            F.count("tur").alias("tur_known"),
            F.sum(F.col("tur").cast("decimal(18,12)")).alias("tur_sum"),
        )
    )
    day = ["d_date"] if mtd else []
    totals = rollup_sets(
        with_offer_measures(campaigns, wl_offer, taker_offer).join(rates, OFFER, "left"),
        [*day, "strmonth", "product"],
        TOWER_WLTYPE_SETS,
        {
            "target_rows": F.sum("target_rows"),
            "taker_rows": F.sum("taker_rows"),
            "tur_rows": F.sum("tur_rows"),
            "billed_rows": billed_rows(),
            "total_target": F.sum("target"),
            "tur": ratio(F.sum("tur_sum"), F.sum("tur_known")),
            "revenue": F.sum("revenue"),
            "cost": cost(),
            "delivery_rate": 100 * ratio(F.sum("delivered"), F.sum("target")),
        },
    ).where("target_rows > 0")
    if how == "inner":
        totals = totals.where(
            "product IS NOT NULL AND taker_rows > 0 AND tur_rows > 0 AND billed_rows > 0"
        )
    return totals.select(
        *day,
        "strmonth",
        "product",
        "tower",
        "wltype",
        "total_target",
        "tur",
        "revenue",
        "cost",
        "delivery_rate",
    )


def summary_kabupaten(
    summary: DataFrame,
    wl_border: DataFrame,
    taker_border: DataFrame,
    tur: DataFrame,
    month: date | None = None,
    mtd: bool = False,
) -> DataFrame:
    """Takers, revenue, delivery rate and take-up rate per kabupaten.

    Every campaign counts with the kabupaten its offer has targets in; delivery is a percentage
    of targets, and the take-up rate is the mean over the offers targeted in the kabupaten.
    Campaign rows that agree in offer, tower and type are one row with a weight before the join.
    """
    summary, wl_border, taker_border = (
        in_month(t, month) for t in (summary, wl_border, taker_border)
    )
    day = ["d_date"] if mtd else []
    campaigns = (
        campaign_rows(latest_snapshot(summary), CORE_TOWERS)
        .groupBy(*OFFER, *day, "tower", "wltype")
        .agg(F.count("*").alias("campaigns"))
    )
    cell = [*OFFER, "border"]

    def weighted(column: str) -> Column:
        return F.sum(F.col(column) * F.col("campaigns"))

    def here(snapshots: DataFrame) -> DataFrame:
        return latest_snapshot(snapshots, summary).where(F.col("level") == "kabupaten")

    targets = here(wl_border).select(
        *cell, F.col("total_msisdn").alias("target"), F.col("msisdn_delivered").alias("delivered")
    )
    takers = here(taker_border).select(*cell, F.col("total_msisdn").alias("taker"), "revenue")
    rates = (
        in_month(tur, month)
        .groupBy(*OFFER)
        .agg(
            F.count("tur").alias("tur_known"),
            F.sum(F.col("tur").cast("decimal(18,12)")).cast("decimal(24,12)").alias("tur_sum"),
        )
    )
    # Narrow enough for the product to keep all twelve digits.
    weight = F.col("campaigns").cast("decimal(12,0)")
    return rollup_sets(
        campaigns.join(targets, OFFER)
        .join(takers, cell, "left")
        .join(rates, OFFER, "left")
        .withColumnRenamed("border", "kabupaten"),
        [*day, "strmonth", "kabupaten"],
        TOWER_WLTYPE_SETS,
        {
            "total_taker": weighted("taker"),
            "revenue": weighted("revenue"),
            "delivery_rate": percent(weighted("delivered"), weighted("target")),
            "tur": ratio(F.sum(F.col("tur_sum") * weight), weighted("tur_known")),
        },
    ).select(
        *day,
        "strmonth",
        "tower",
        "wltype",
        "kabupaten",
        "total_taker",
        "revenue",
        "delivery_rate",
        "tur",
    )
