"""Subscribers who took an offer."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.functions.constants import CORE_TOWERS, LEVELS
from uptake.functions.dates import in_month, tagged
from uptake.functions.grouping import rollup_sets
from uptake.operators.geography import at_date, level_first, place_on_levels


def _taken(taker: DataFrame, month: date | None) -> DataFrame:
    return in_month(taker, month).where(F.col("offer_id").isNotNull())


def taker_by_tower(
    taker: DataFrame,
    month: date | None = None,
    extract_date: date | None = None,
    towers: Sequence[str] = CORE_TOWERS,
) -> DataFrame:
    """Distinct takers, transactions and revenue per tower, and for all towers together.

    The total counts subscribers anew: someone who took offers of two towers is one taker.
    Facts are summed per subscriber first, so the two grouping sets double these rows only.
    """
    core = (
        _taken(taker, month)
        .where(F.col("tower_name").isin(*towers))
        .groupBy("strmonth", "tower_name", "msisdn")
        .agg(F.sum("trx").alias("trx"), F.sum("revenue").alias("revenue"))
    )
    totals = rollup_sets(
        core,
        ["strmonth"],
        [["tower_name"], []],
        {
            "total_msisdn": F.countDistinct("msisdn"),
            "trx": F.sum("trx"),
            "revenue": F.sum("revenue"),
        },
    )
    return tagged(totals, extract_date, data_name="data_date")


def taker_by_offer(
    taker: DataFrame,
    month: date | None = None,
    extract_date: date | None = None,
    towers: Sequence[str] = CORE_TOWERS,
    by: Sequence[str] = (),
    data_name: str = "data_date",
) -> DataFrame:
    """Distinct takers, transactions and revenue per offer.

    The forecast extract is the same table with the data day named ``d_date``.
    """
    totals = (
        _taken(taker, month)
        .where(F.col("tower_name").isin(*towers))
        .groupBy(*by, "strmonth", "offer_id")
        .agg(
            F.countDistinct("msisdn").alias("total_msisdn"),
            F.sum("trx").alias("trx"),
            F.sum("revenue").alias("revenue"),
        )
    )
    return tagged(totals, extract_date, data_name=data_name)


def taker_border(
    taker: DataFrame,
    dim: DataFrame,
    month: date | None = None,
    extract_date: date | None = None,
    dim_date: date | None = None,
    levels: Sequence[str] = LEVELS,
    by: Sequence[str] = (),
    data_name: str = "data_date",
) -> DataFrame:
    """Distinct takers, transactions and revenue per offer and geography value, all towers.

    Facts are summed to one row per offer and subscriber first. After that a subscriber is
    one row per border, so counting rows counts distinct subscribers, and one scan and one
    join serve all levels.
    """
    keys = [*by, "strmonth", "offer_id"]
    per_subscriber = (
        _taken(taker, month)
        .groupBy(*keys, "msisdn")
        .agg(F.sum("trx").alias("trx"), F.sum("revenue").alias("revenue"))
    )
    placed = place_on_levels(per_subscriber, at_date(dim, dim_date), levels)
    totals = placed.groupBy("level", *keys, "border").agg(
        F.count("msisdn").alias("total_msisdn"),
        F.sum(F.col("trx") * F.col("copies")).alias("trx"),
        F.sum(F.col("revenue") * F.col("copies")).alias("revenue"),
    )
    return level_first(tagged(totals, extract_date, data_name=data_name))


def taker_by_attribute(
    taker: DataFrame,
    dim: DataFrame,
    attribute: str,
    month: date | None = None,
    extract_date: date | None = None,
    dim_date: date | None = None,
    data_name: str = "data_date",
) -> DataFrame:
    """``taker_border`` for one attribute of the dimension, under the attribute's own name."""
    totals = taker_border(
        taker, dim, month, extract_date, dim_date, [attribute], data_name=data_name
    )
    return totals.drop("level").withColumnRenamed("border", attribute)


def taker_kabupaten(taker: DataFrame, dim: DataFrame, **options) -> DataFrame:
    return taker_by_attribute(taker, dim, "kabupaten", **options)


def taker_region(taker: DataFrame, dim: DataFrame, **options) -> DataFrame:
    return taker_by_attribute(taker, dim, "region_sales", **options)


def taker_los(taker: DataFrame, dim: DataFrame, **options) -> DataFrame:
    """By length of stay."""
    return taker_by_attribute(taker, dim, "los", data_name="d_date", **options)
