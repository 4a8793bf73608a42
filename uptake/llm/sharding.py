"""Sharding by weighted rendezvous hashing.

Every shard scores a record by a hash of the record's key and the shard's name, and the record
goes to the shard with the best score. Nothing but the key and the list of shards decides, so
tasks need no shared state, and a further shard only takes the records it scores best.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uptake.llm.common import stored

HASH_BITS = 52  # exact in a double
ROWS_PER_PART = 1 << 16


def hash_unit(key: Column, shard: int) -> Column:
    """A number above 0 and below 1 from the key, as text, and the shard."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f":{shard}")))
    number = F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("double")
    return (number + 0.5) / float(1 << HASH_BITS)


def rendezvous_shard(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of a key: the one with the least -ln(u) / weight, ties to the smaller shard.

    A shard gets a share of the keys in proportion to its weight. A changed weight moves keys
    to or from that shard only. A null key is a key like any other.
    """
    if not weights or any(w <= 0 for w in weights.values()):
        raise ValueError("shards need weights above 0")
    scores = [
        F.struct((-F.log(hash_unit(key, shard)) / float(w)).alias("score"), F.lit(shard).alias("s"))
        for shard, w in weights.items()
    ]
    return F.array_min(F.array(*scores))["s"]


def numbered(df: DataFrame, group: str, order: Column, rows_per_part: int) -> DataFrame:
    """Adds ``slot``, a gapless number from 0 within each group, in parallel.

    A group is cut into parts by a hash of its rows and their places, so that equal rows spread
    too; a part is numbered by itself and starts where the parts before it end. Only the sizes
    of the parts go through one window. The rows are written once, as the numbering needs them
    twice with the same places.
    """
    rows = stored(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    total = rows.groupBy(group).count().agg(F.max("count")).first()[0] or 0
    parts = max(1, -(-total // rows_per_part))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("_row"), F.lit(parts)))
    sizes = rows.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        group, "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy(group, "_part").orderBy(order)
    return (
        rows.withColumn("_place", F.row_number().over(within) - 1)
        .join(starts, [group, "_part"])
        .withColumn("slot", (F.col("_start") + F.col("_place")).cast("long"))
        .drop("_part", "_place", "_start", "_row")
    )


def shard_documents(
    docs: DataFrame,
    weights: Mapping[int, float],
    grown: Mapping[int, float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """``id``, ``size`` (UTF-8 bytes plus 1), ``text_crc32``, ``shard``, ``slot`` and
    ``grown_shard`` (the shard under the weights ``grown``, null without) of every row.

    Equal keys share a shard. A null text has no bytes. Rows equal in key and text are
    numbered in any order, which changes no result. Other columns are not looked at.
    """
    key, text = F.col(id_col), F.col(text_col)
    rows = docs.select(
        key.alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        rendezvous_shard(key, weights).alias("shard"),
        (rendezvous_shard(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    return numbered(rows, "shard", F.struct("id", "size", "text_crc32"), rows_per_part)
