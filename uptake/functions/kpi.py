"""KPI formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from uptake.functions.constants import (
    MESSAGE_COST,
    REGULER,
    RULEBASED,
    TUR_CEILING,
    TUR_CLAMPED,
)


def wltype_bucket(wltype: Column) -> Column:
    return F.when(wltype.ilike("%rulebased%"), F.lit(RULEBASED)).otherwise(F.lit(REGULER))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; null instead of an error where the denominator is 0."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return ratio(100 * part.cast("double"), whole)


def take_up_rate(taker: Column, delivered: Column, targeted: Column) -> Column:
    """Takers per delivered message, or per target once takers outnumber deliveries.

    Null when takers and deliveries are equal, or either is 0 or unknown.
    """
    both = (taker > 0) & (delivered > 0)
    return F.when(both & (delivered > taker), ratio(taker, delivered)).when(
        both & (delivered < taker), ratio(taker, targeted)
    )


def clamp_take_up_rate(tur: Column) -> Column:
    return F.when(tur >= TUR_CEILING, F.lit(TUR_CLAMPED)).otherwise(tur)


def exact_mean(value: Column) -> Column:
    """Mean of doubles summed as decimals: the order in which tasks finish cannot change it."""
    return F.sum(value.cast("decimal(18,12)")).cast("double") / F.nullif(
        F.count(value), F.lit(0)
    ).cast("double")


def message_cost(channel: Column) -> Column:
    """Cost of one message on the channel; null where messages are free of charge."""
    cost = None
    for name, price in MESSAGE_COST.items():
        cost = F.when(channel == name, price) if cost is None else cost.when(channel == name, price)
    return cost
