"""What changed between two snapshots, with repeated rows counted."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ADDED, REMOVED = "added", "removed"


def snapshot_changes(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Each different row of two snapshots with the same columns that is not equally often in
    both: its columns, ``change`` (``added`` or ``removed``), ``copies`` (how many more or fewer)
    and ``updated`` (whether its ``key`` has rows of both kinds).

    Rows are counted with a sign, so nothing is compared pairwise and repeated rows are copies.
    Nulls are equal to nulls. Old plus added minus removed is new, see ``apply_changes``.
    """
    signed = old.withColumn("_n", F.lit(-1)).unionByName(new.withColumn("_n", F.lit(1)))
    counted = signed.groupBy(*old.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    kinds = counted.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)]).agg(
        (F.max("_n") * F.min("_n") < 0).alias("updated")
    )
    same = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(key)]
    )
    return counted.join(kinds, same).select(
        *old.columns,
        F.when(F.col("_n") > 0, ADDED).otherwise(REMOVED).alias("change"),
        F.abs("_n").alias("copies"),
        "updated",
    )


def apply_changes(old: DataFrame, changes: DataFrame) -> DataFrame:
    """The new snapshot from the old one and its changes, rows in any order."""
    columns = old.columns
    sign = F.when(F.col("change") == ADDED, F.col("copies")).otherwise(-F.col("copies"))
    signed = old.withColumn("_n", F.lit(1).cast("long")).unionByName(
        changes.select(*columns, sign.alias("_n"))
    )
    counted = signed.groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))
    return counted.withColumn("_copy", copies).select(*columns)
