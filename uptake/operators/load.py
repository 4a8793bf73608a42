"""Loading tables stored as Parquet, partitioned by the key that a load replaces.

Replacing uses dynamic partition overwrite: new files are staged next to the table and take
the place of the old ones when the job commits. A lost executor costs a task retry, a failed
job leaves the old rows, and running a load again gives the same table. Row counts are
observed during the write, so no load computes its input twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uptake.sources.files import path_exists, read_csv, scratch_path
from uptake.sources.schemas import SYNC_KEYS

KeyValue = Mapping[str, date | str | int | None]


def _write(df: DataFrame, path: str, keys: Sequence[str], mode: str) -> int:
    """Write partitioned by the keys and return the number of rows written."""
    seen = Observation()
    (
        df.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )
    return seen.get["rows"]


def _only(df: DataFrame, slice_of: KeyValue) -> DataFrame:
    """The rows, failing on one outside the slice."""
    inside = F.lit(True)
    for key, value in slice_of.items():
        inside = inside & F.col(key).eqNullSafe(F.lit(value))
    outside = F.raise_error(F.lit(f"row outside the slice {dict(slice_of)}")).cast("boolean")
    return df.where(F.when(inside, F.lit(True)).otherwise(outside))


def replace_slice(df: DataFrame, path: str, slice_of: KeyValue, allow_empty: bool = True) -> int:
    """Replace the rows of one key value. Replacing them by no rows empties the slice."""
    rows = _write(_only(df, slice_of), path, list(slice_of), "overwrite")
    if rows == 0:
        if not allow_empty:
            raise ValueError(f"no rows for {dict(slice_of)}")
        _empty_slice(df, path, slice_of)
    return rows


def _empty_slice(df: DataFrame, path: str, slice_of: KeyValue) -> None:
    """Overwrite the folder of a slice by no rows. Spark names it, as it escapes the values."""
    spark = df.sparkSession
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    folders = [
        names.getPartitionPathString(key, None if value is None else str(value))
        for key, value in slice_of.items()
    ]
    directory = "/".join([path.rstrip("/"), *folders])
    if path_exists(spark, directory):
        none = spark.createDataFrame([], df.drop(*slice_of).schema)
        none.write.mode("overwrite").parquet(directory)


def replace_month_to_date(
    df: DataFrame, path: str, month: date, data_day: date | None = None
) -> int:
    """Replace a month's rows of the newest data day (``d_date``) and leave its other days.

    The newest day is that of the rows unless it is given, as it must be to empty a day.
    """
    rows = df.where(F.col("strmonth") == F.lit(month))
    if data_day is None:
        data_day = rows.agg(F.max("d_date")).first()[0]
        if data_day is None:
            raise ValueError(f"no data day in {month}")
    rows = rows.where(F.col("d_date") == F.lit(data_day))
    return replace_slice(rows, path, {"strmonth": month, "d_date": data_day})


def replace_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> int:
    """Replace every partition that has rows in ``df`` and leave the others alone.

    One write serves many key values, such as all levels of the border tables. Rows are
    clustered by the keys first, so that a task does not open a file for every partition;
    adaptive execution splits a partition that is much larger than the others.
    """
    return _write(df.hint("rebalance", *keys), path, keys, "overwrite")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail on an empty extract.

    The rows are counted while they are written to the shared folder, and what is returned
    reads them from there: they are computed once.
    """
    spark, path, seen = df.sparkSession, scratch_path(df.sparkSession, "checked"), Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    if seen.get["rows"] == 0:
        raise ValueError(f"no rows in {what}")
    return spark.read.schema(df.schema).parquet(path)


def stage_and_replace(
    spark: SparkSession, csv_path: str, path: str, schema: T.StructType, extract_date: date
) -> int:
    """Load one day's CSV extract and replace that extract date in the table.

    A missing or empty extract, or a row of another day, fails before any change.
    """
    staged = read_csv(spark, csv_path, schema)
    return replace_slice(staged, path, {"extract_date": extract_date}, allow_empty=False)


def slice_by_key(source: DataFrame, key: str, value) -> DataFrame:
    """Rows of one key value, a partition predicate on the stored table."""
    return source.where(F.col(key) == F.lit(value))


def sync_by_key(source: DataFrame, path: str, key: str, value) -> int:
    """Copy one key value to the target, replacing it there unless there is nothing to copy."""
    return _write(slice_by_key(source, key, value), path, [key], "overwrite")


def sync_append(source: DataFrame, path: str, key: str, value) -> int:
    """Add the rows of one key value to the target, whatever is there already."""
    return _write(slice_by_key(source, key, value), path, [key], "append")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows, and the old rows whose key has no new row. Nulls are equal.

    New rows that share a key fail the job, as each old row can become one new row only.
    """
    alike = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    repeated = F.raise_error(F.lit(f"several new rows have one key {list(keys)}")).cast("boolean")
    single = new.withColumn("_alike", alike).where(
        F.when(F.col("_alike") == 1, F.lit(True)).otherwise(repeated)
    )
    single = single.drop("_alike")
    same = [old[k].eqNullSafe(single[k]) for k in keys]
    return old.join(single, same, "left_anti").unionByName(single)


def sync_upsert(source: DataFrame, path: str, key: str, value, row_keys: Sequence[str]) -> int:
    """Update or insert the rows of one key value, matched by ``row_keys`` inside it.

    Only the partition of that value is read and rewritten, and its old files stay in place
    until the merged ones are complete. Without a table yet, the rows are the table.
    """
    rows = slice_by_key(source, key, value)
    if path_exists(source.sparkSession, path):
        stored = slice_by_key(source.sparkSession.read.parquet(path), key, value)
    else:
        stored = rows.where(F.lit(False))
    old = stored.select(*[F.col(c).alias(c) for c in rows.columns])
    return _write(upsert(old, rows, row_keys), path, [key], "overwrite")


def sync_table(
    source: DataFrame,
    table: str,
    path: str,
    value,
    strategy: str = "replace",
    row_keys: Sequence[str] = (),
) -> int:
    """Sync a served table by the key it is known to be selected by."""
    key = SYNC_KEYS[table]
    if strategy == "replace":
        return sync_by_key(source, path, key, value)
    if strategy == "append":
        return sync_append(source, path, key, value)
    if strategy == "upsert":
        return sync_upsert(source, path, key, value, row_keys)
    raise ValueError(f"unknown strategy {strategy!r}")


def available_dates(df: DataFrame, key: str) -> DataFrame:
    """Key values that have rows, newest first."""
    return df.select(key).distinct().orderBy(F.desc(key))
