"""Attaching subscribers to the geography levels of the subscriber dimension."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.functions.dates import in_month


def at_date(dim: DataFrame, dim_date: date | None) -> DataFrame:
    """One snapshot of the dimension, or the table as it is if no date is given."""
    return in_month(dim, dim_date, "event_date")


def level_first(df: DataFrame) -> DataFrame:
    """The column order of the extracts per level."""
    return df.select("level", *[c for c in df.columns if c != "level"])


def spread_over_levels(facts: DataFrame, dim: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Left-join facts (with an ``msisdn``) to the dimension, one row per level and dimension row.

    Subscribers unknown to the dimension get a null border on every level.
    """
    homes = dim.select("msisdn", *[F.col(c).cast("string").alias(c) for c in levels])
    return facts.join(homes, "msisdn", "left").unpivot(
        facts.columns, list(levels), "level", "border"
    )


def place_on_levels(facts: DataFrame, dim: DataFrame, levels: Sequence[str]) -> DataFrame:
    """``spread_over_levels`` with one row per level and border, and the number of copies.

    A dimension snapshot should hold a subscriber once. If it does not, a left join repeats
    the facts, and ``copies`` says how often. If the facts hold a subscriber once per group,
    counting rows per border then counts distinct subscribers, without another shuffle of the
    facts by subscriber.
    """
    places = F.array(
        *[
            F.struct(F.lit(c).alias("level"), F.col(c).cast("string").alias("border"))
            for c in levels
        ]
    )
    homes = (
        dim.where(F.col("msisdn").isNotNull())
        .select("msisdn", F.inline(places))
        .groupBy("msisdn", "level", "border")
        .agg(F.count("*").alias("copies"))
    )
    # Only subscribers unknown to the dimension have no level yet: they get all of them.
    known = F.col("level").isNotNull()
    every = F.when(known, F.array("level")).otherwise(F.array(*[F.lit(c) for c in levels]))
    return facts.join(homes, "msisdn", "left").select(
        *facts.columns,
        F.explode(every).alias("level"),
        "border",
        F.coalesce("copies", F.lit(1)).alias("copies"),
    )
