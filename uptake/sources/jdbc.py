"""Optional database source and sink. Connection options always come from the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 1000


def read_slice(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    columns: Sequence[str],
    key: str,
    value: date,
) -> DataFrame:
    """Rows of one key value. Spark sends the columns and the predicate to the database.

    To read a large slice in parallel, put ``partitionColumn``, ``lowerBound``, ``upperBound``
    and ``numPartitions`` into the options.
    """
    rows = spark.read.format("jdbc").options(**options).option("dbtable", table).load()
    return rows.where(F.col(key) == F.lit(value)).select(*columns)


def append(df: DataFrame, options: Mapping[str, str], table: str) -> None:
    """Insert in batches; each task writes its own partition."""
    (
        df.write.format("jdbc")
        .mode("append")
        .options(**options)
        .option("dbtable", table)
        .option("batchsize", BATCH_ROWS)
        .save()
    )


def recreate(df: DataFrame, options: Mapping[str, str], table: str) -> None:
    """Drop, create and load the table."""
    (
        df.write.format("jdbc")
        .mode("overwrite")
        .options(**options)
        .option("dbtable", table)
        .option("batchsize", BATCH_ROWS)
        .save()
    )
