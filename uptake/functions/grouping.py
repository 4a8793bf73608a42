"""Aggregation over several grouping sets with labelled subtotals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uptake.functions.constants import ALL

# Total, per whitelist type, per tower, and per both.
TOWER_WLTYPE_SETS = ([], ["tower"], ["wltype"], ["tower", "wltype"])


def rollup_sets(
    df: DataFrame,
    fixed: Sequence[str],
    sets: Sequence[Sequence[str]],
    aggs: Mapping[str, Column],
) -> DataFrame:
    """Aggregate once per set; a key missing from a set reads 'ALL' in its rows.

    The label comes from ``grouping()``, so a null that is in the data stays null and is
    not taken for a subtotal. ``fixed`` keys belong to every set.
    """
    subtotal = list(dict.fromkeys(key for keys in sets for key in keys))
    grouped = df.groupingSets(
        [[F.col(c) for c in (*fixed, *keys)] for keys in sets],
        *[F.col(c) for c in (*fixed, *subtotal)],
    ).agg(
        *[F.grouping(c).alias(f"_all_{c}") for c in subtotal],
        *[agg.alias(name) for name, agg in aggs.items()],
    )
    return grouped.select(
        *fixed,
        *[
            F.when(F.col(f"_all_{c}") == 1, F.lit(ALL)).otherwise(F.col(c)).alias(c)
            for c in subtotal
        ],
        *aggs,
    )
