"""Free attributes of applications, kept as JSON objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attribute_map(text: Column) -> Column:
    """The attributes of a JSON object as a map of strings; null for null and for text that is
    none. Nested values keep their JSON text."""
    return F.from_json(text, "map<string,string>")


def having_attribute(apps: DataFrame, column: str, key: str, value: str) -> DataFrame:
    """The rows whose JSON object in ``column`` has this value under the key."""
    entry = F.struct(F.lit(key).alias("key"), F.lit(value).alias("value"))
    return apps.where(F.array_contains(F.map_entries(attribute_map(F.col(column))), entry))


def attribute_counts(apps: DataFrame, column: str) -> DataFrame:
    """``key``, ``value`` and ``apps``, the number of rows with it. A row counts once per key and
    value. A row that has no JSON object is counted under the key null, one with an empty object
    nowhere; a null value under its key is counted."""
    entry = "array<struct<key:string,value:string>>"
    entries = F.array_distinct(F.map_entries(attribute_map(F.col(column)))).cast(entry)
    nothing = F.lit(None).cast("string")
    unread = F.array(F.struct(nothing.alias("key"), nothing.alias("value")))
    pairs = apps.select(F.inline(F.coalesce(entries, unread)).alias("key", "value"))
    return pairs.groupBy("key", "value").agg(F.count(F.lit(1)).alias("apps"))
