"""Headline KPIs per tower and whitelist type, and per campaign initiative below them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.functions.constants import CORE_TOWERS, TOWERS
from uptake.functions.dates import in_month
from uptake.functions.grouping import TOWER_WLTYPE_SETS, rollup_sets
from uptake.functions.kpi import exact_mean, percent, ratio
from uptake.operators.measures import (
    full_month_inputs,
    month_to_date_inputs,
    same_day_inputs,
    trackable_counts,
    with_offer_measures,
)

INITIATIVE_SET = ["tower", "wltype", "initiatives"]


def _core_rates(tur: DataFrame, month: date | None) -> DataFrame:
    return in_month(tur, month).where(F.col("tower").isin(*CORE_TOWERS))


def top_main_level(
    summary: DataFrame,
    wl_offer: DataFrame,
    taker_offer: DataFrame,
    tur: DataFrame,
    month: date | None = None,
    mtd: bool = False,
    late_days: int = 2,
) -> DataFrame:
    """Targets, campaigns, delivery rate, takers, revenue, take-up rate and trackable share.

    The full month covers all towers, though take-up rates exist for the core towers only.
    Month-to-date covers the core towers, carries the data day and uses the lagged facts.
    """
    if mtd:
        inputs = month_to_date_inputs(summary, wl_offer, taker_offer, CORE_TOWERS, month)
    else:
        inputs = full_month_inputs(summary, wl_offer, taker_offer, TOWERS, month, late_days)
    tracked, pairs = trackable_counts()
    day = ["d_date"] if mtd else []
    totals = rollup_sets(
        with_offer_measures(*inputs),
        [*day, "strmonth"],
        TOWER_WLTYPE_SETS,
        {
            "target_rows": F.sum("target_rows"),
            "total_target": F.sum("target"),
            "total_campaign": F.countDistinct("offer_id"),
            "delivery_rate": percent(F.sum("delivered"), F.sum("target")),
            "total_taker": F.sum("taker"),
            "total_revenue": F.sum("revenue"),
            "trackable": 100 * ratio(tracked, pairs),
        },
    ).where("target_rows > 0")
    rates = rollup_sets(
        _core_rates(tur, month), ["strmonth"], TOWER_WLTYPE_SETS, {"tur": exact_mean(F.col("tur"))}
    )
    return totals.join(rates, ["strmonth", "tower", "wltype"], "left").select(
        *day,
        "strmonth",
        "tower",
        "wltype",
        "total_target",
        "total_campaign",
        "delivery_rate",
        "total_taker",
        "total_revenue",
        "tur",
        "trackable",
    )


def top_main_level_l1(
    summary: DataFrame,
    wl_offer: DataFrame,
    taker_offer: DataFrame,
    tur: DataFrame,
    month: date | None = None,
    mtd: bool = False,
    late_days: int = 2,
) -> DataFrame:
    """Headline KPIs down to the initiative.

    The full month has the subtotals too, and its initiative rows sum to them: campaigns
    without an initiative are a row of their own. Month-to-date has only the initiative rows,
    takes all tables at the same extract date and carries the data day; there an unknown
    initiative equals no other, so such rows have a target and nothing else.
    """
    if mtd:
        inputs = same_day_inputs(summary, wl_offer, taker_offer, CORE_TOWERS, month)
        fixed, sets = ["d_date", "strmonth"], [INITIATIVE_SET]
    else:
        inputs = full_month_inputs(summary, wl_offer, taker_offer, CORE_TOWERS, month, late_days)
        fixed, sets = ["strmonth"], [*TOWER_WLTYPE_SETS, INITIATIVE_SET]

    def initiatives(df: DataFrame) -> DataFrame:
        return df.withColumnRenamed("campaign_initiatives", "initiatives")

    taker, trx, revenue = F.sum("taker"), F.sum("trx"), F.sum("revenue")
    measures = {
        "total_revenue": revenue,
        "total_transaction": trx,
        "total_uni_taker": taker,
        "rev_taker": ratio(revenue, taker),
        "rev_trx": ratio(revenue, trx),
        "trx_taker": ratio(trx, taker),
        "delivery_rate": percent(F.sum("delivered"), F.sum("target")),
        "delivered": F.sum("delivered"),
    }
    totals = rollup_sets(
        initiatives(with_offer_measures(*inputs)),
        fixed,
        sets,
        {"target_rows": F.sum("target_rows"), "total_target": F.sum("target"), **measures},
    ).where("target_rows > 0")
    rates = rollup_sets(
        initiatives(_core_rates(tur, month)), fixed, sets, {"tur": exact_mean(F.col("tur"))}
    )
    keys = [*fixed, *INITIATIVE_SET]
    same = [totals[c].eqNullSafe(rates[c]) for c in keys]
    known = totals["initiatives"].isNotNull() if mtd else F.lit(True)
    return totals.join(rates, same, "left").select(
        *[totals[c] for c in keys],
        "total_target",
        *[
            F.when(known, F.col(c)).alias(c)
            for c in (
                "total_revenue",
                "total_transaction",
                "total_uni_taker",
                "tur",
                "rev_taker",
                "rev_trx",
                "trx_taker",
                "delivery_rate",
                "delivered",
            )
        ],
    )
