"""Catalog tables, Parquet and CSV."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or a Parquet directory by path."""
    if "/" in name_or_path:
        repair(spark, name_or_path)
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new directory in the folder that all executors share.

    That is ``spark.checkpoint.dir`` or, in a session that does not set it, Spark's warehouse,
    which holds tables and so is shared as well. Directories are grouped by application, and
    ``drop_scratch`` removes those of the application that calls it.
    """
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/uptake/{spark.sparkContext.applicationId}"


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it names it."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    files, location = _file_system(spark, path)
    return files.exists(location)


def drop_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application. Results that read them end with it."""
    files, location = _file_system(spark, _scratch_root(spark))
    files.delete(location, True)


def repair(spark: SparkSession, path: str) -> bool:
    """Bring back the table at ``path`` if a load was stopped between its two renames.

    Then nothing is at ``path`` and the old directory stands aside, complete. Readers by path and
    the next load call this; it does nothing where the table exists. True if it did something.
    """
    files, target = _file_system(spark, path)
    if files.exists(target):
        return False
    aside = files.globStatus(
        spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}-replaced-{'[0-9a-f]' * 32}")
    )
    old = sorted((s.getModificationTime(), s.getPath().toString()) for s in aside or ())
    return bool(old) and files.rename(spark._jvm.org.apache.hadoop.fs.Path(old[-1][1]), target)


def put_in_place(spark: SparkSession, staged: str, path: str) -> None:
    """Make a complete staged directory the table at ``path``.

    The old directory is moved aside and removed last, so that at every moment one complete
    copy exists; ``repair`` finds it if this is stopped half-way.
    """
    repair(spark, path)
    files, new = _file_system(spark, staged)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}-replaced-{uuid.uuid4().hex}")
    old = files.exists(target)
    files.mkdirs(target.getParent())
    if old and not files.rename(target, aside):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(new, target):
        if old:
            files.rename(aside, target)
        raise OSError(f"cannot put {staged} in place of {path}")
    if old:
        files.delete(aside, True)


# Cells as they are: spaces at either end kept, quotes doubled inside quotes.
_CSV = {
    "header": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "quote": '"',
    "escape": '"',
}


def write_csv(df: DataFrame, path: str) -> None:
    """A directory of CSV files with a header each, written in parallel."""
    df.write.mode("overwrite").options(**_CSV).csv(path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False
) -> DataFrame:
    """CSV with a header and a known schema. An empty field is null.

    ``multiline`` allows line breaks inside quotes, at the cost of one task per file.
    """
    return (
        spark.read.schema(schema)
        .options(**_CSV, enforceSchema=False, mode="FAILFAST", multiLine=multiline)
        .csv(path)
    )


def read_sheet(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """A sheet with unknown columns, all read as text, with the position of every row.

    Adds ``source_file``, ``source_block`` (the start of the input split) and ``source_row``;
    together they give the order of the rows without sorting the file. The rows are written to
    the shared folder with their positions, which so are given once whatever reads them.
    ``multiline`` allows line breaks inside quotes, at the cost of one task per file. A column
    without a header gets a blank name.
    """
    extension = os.path.splitext(path.rstrip("/"))[1].lower()
    if extension != ".csv":
        raise ValueError(f"unsupported file format {extension!r}: save the sheet as .csv")
    stored = scratch_path(spark, "sheet")
    sheet = spark.read.options(**_CSV, inferSchema=False, multiLine=multiline).csv(path)
    blanks = {c: " " * (i + 1) for i, c in enumerate(sheet.columns) if re.fullmatch(r"_c\d+", c)}
    placed = sheet.select(
        *[F.col(f"`{c}`").alias(blanks.get(c, c)) for c in sheet.columns],
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_block"),
        F.monotonically_increasing_id().alias("source_row"),
    )
    names = placed.columns
    plain = placed.toDF(*[f"c{i}" for i in range(len(names))])  # any header makes a column name
    plain.write.parquet(stored)
    return spark.read.schema(plain.schema).parquet(stored).toDF(*names)
