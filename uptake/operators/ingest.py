"""From a hand-kept sheet to a clean table.

The position of a row comes in three columns, as ``read_sheet`` gives them: the file, a chunk
of it, and the row inside the chunk.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uptake.functions.constants import TEXT_COLUMNS, VARCHAR_LENGTH
from uptake.functions.ordered import carry_forward, consecutive_ids
from uptake.functions.text import clean_cell, is_blank, snake_case
from uptake.sources.files import put_in_place


# Rows of a sheet that one record may have.
MOST_RECORD_ROWS = 1_000_000


class Position(NamedTuple):
    file: str = "source_file"
    chunk: str = "source_block"
    row: str = "source_row"


POSITION = Position()


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def snake_case_columns(
    df: DataFrame, drop: Sequence[str] = (), keep: Sequence[str] = POSITION
) -> DataFrame:
    """Rename columns to snake case; drop those without a header and those named in ``drop``."""
    names = {
        c: c if c in keep else snake_case(c)
        for c in df.columns
        if c.strip() and c not in drop
    }
    clashes = {n for n in names.values() if list(names.values()).count(n) > 1}
    if clashes:
        raise ValueError(f"several columns are named {sorted(clashes)}")
    return df.select(*[_quoted(old).alias(new) for old, new in names.items()])


def clean_nulls(df: DataFrame, keep: Sequence[str] = POSITION) -> DataFrame:
    """Blank cells and '-' become null, white space is normalised, ``id`` becomes an integer."""
    cleaned = []
    for c in df.columns:
        if c in keep:
            cleaned.append(F.col(c))
        elif c == "id":
            cleaned.append(F.col(c).cast("int").alias(c))
        else:
            cleaned.append(clean_cell(F.col(c).cast("string")).alias(c))
    return df.select(*cleaned)


def fold_rows(
    df: DataFrame,
    key: str,
    skip: Sequence[str] = ("id",),
    position: Position = POSITION,
    most_rows: int = MOST_RECORD_ROWS,
) -> DataFrame:
    """Merge rows with a blank key into the row with a key above them.

    The values of a column are joined by line breaks in row order; the key and the ``skip``
    columns keep the value of the keyed row. Rows above the first key stay as they are. A merged
    cell is one value of the result, so a record has to fit in a row: one of more than
    ``most_rows`` rows fails the job, as a sheet with a single key at its top would.
    """
    place = F.struct(position.chunk, position.row)
    rows = carry_forward(
        df.withColumn("_place", place),
        F.when(~is_blank(F.col(key)), F.col("_place")),
        "_record",
        [position.file],
        [position.chunk],
        position.row,
    )
    # Rows above the first key are records of their own.
    rows = rows.withColumn("_record", F.coalesce("_record", "_place"))
    # Sizes first: a record that is too long fails before its cells are gathered.
    key_of = [position.file, "_record"]
    too_long = F.raise_error(F.lit(f"a record has more than {most_rows} rows")).cast("boolean")
    sizes = rows.groupBy(*key_of).agg(F.count(F.lit(1)).alias("_rows"))
    sizes = sizes.where(F.when(F.col("_rows") <= most_rows, F.lit(True)).otherwise(too_long))
    rows = rows.join(sizes, key_of)

    def first(c: str) -> Column:
        return F.min_by(c, "_place").alias(c)

    def joined(c: str) -> Column:
        cell = F.struct("_place", F.col(c).cast("string").alias("v"))
        cells = F.collect_list(F.when(F.col(c).isNotNull(), cell))
        text = F.array_join(F.transform(F.array_sort(cells), lambda cell: cell["v"]), "\n")
        return F.when(F.count(c) > 0, text).alias(c)

    single = {key, *skip, position.chunk, position.row}
    columns = [c for c in df.columns if c != position.file]
    return (
        rows.groupBy(*key_of)
        .agg(*[first(c) if c in single else joined(c) for c in columns])
        .select(*df.columns)
    )


def fold_rows_status_division(df: DataFrame, position: Position = POSITION) -> DataFrame:
    return fold_rows(df, "status_division", position=position)


def fold_rows_no(df: DataFrame, position: Position = POSITION) -> DataFrame:
    """Unlike the other sheets, one without a ``no`` column is left alone; ``id`` is joined."""
    return fold_rows(df, "no", (), position) if "no" in df.columns else df


def surrogate_id(df: DataFrame, position: Position = POSITION) -> DataFrame:
    """Number the rows from 1 in input order, as the first column."""
    numbered = consecutive_ids(df, [position.file, position.chunk], position.row)
    return numbered.select("id", *[c for c in df.columns if c != "id"])


def next_ids(table: DataFrame, new_rows: DataFrame, position: Position = POSITION) -> DataFrame:
    """Number new rows onwards from the largest id of the table."""
    largest = table.agg(F.max("id").cast("long").alias("largest"))
    numbered = consecutive_ids(
        new_rows, [position.file, position.chunk], position.row, after=largest.scalar()
    )
    return numbered.select("id", *[c for c in new_rows.columns if c != "id"])


def column_lengths(df: DataFrame) -> DataFrame:
    """Length of the longest value of each text column, and whether it exceeds 255."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    longest = df.agg(*[F.max(F.length(_quoted(c))).alias(c) for c in texts])
    return (
        longest.unpivot([], [_quoted(c) for c in texts], "column_name", "max_length")
        .withColumn("max_length", F.coalesce("max_length", F.lit(0)))
        .withColumn("too_long", F.col("max_length") > VARCHAR_LENGTH)
    )


def column_types(columns: Sequence[str]) -> T.StructType:
    """Table schema of a sheet: integer id, unbounded text for long columns, else varchar."""
    return T.StructType([T.StructField(c, _column_type(c), c != "id") for c in columns])


def _column_type(column: str) -> T.DataType:
    if column == "id":
        return T.IntegerType()
    return T.StringType() if column in TEXT_COLUMNS else T.VarcharType(VARCHAR_LENGTH)


def catalog_ingest(
    sheet: DataFrame, fold_key: str | None = None, drop: Sequence[str] = (), position=POSITION
) -> DataFrame:
    """Fold continuation rows, clean names, number the rows and clean the values.

    ``fold_key`` is the snake-case name of the key column of a sheet with continuation rows.
    Cells longer than the column allows fail the write of the result, not a separate pass.
    """
    if fold_key is not None:
        header = next(
            c for c in sheet.columns if snake_case(c).replace("_", "") == fold_key.replace("_", "")
        )
        sheet = fold_rows(sheet.withColumnRenamed(header, fold_key), fold_key, position=position)
    table = clean_nulls(surrogate_id(snake_case_columns(sheet, drop, position), position), position)
    table = table.drop(*position)
    return table.select(*[_bounded(c) for c in table.columns])


def _bounded(column: str) -> Column:
    if column == "id" or column in TEXT_COLUMNS:
        return F.col(column)
    message = F.concat(
        F.lit(f"value too long for {column}: "), F.length(column).cast("string"), F.lit(" characters")
    )
    return (
        F.when(F.length(column) > VARCHAR_LENGTH, F.raise_error(message).cast("string"))
        .otherwise(F.col(column))
        .alias(column)
    )


def recreate_table(df: DataFrame, path: str) -> None:
    """Drop and load a whole table.

    The rows are written next to the table and take its place when they are complete: a load
    that fails leaves the old rows, and ``df`` may read the table it replaces.
    """
    staged = f"{path.rstrip('/')}-staged-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    put_in_place(df.sparkSession, staged, path)


def update_table(
    spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame]
) -> None:
    """Store the changed rows of a table in its place, such as a soft delete or new columns."""
    recreate_table(change(spark.read.parquet(path)), path)
