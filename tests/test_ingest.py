from __future__ import annotations

import os
from random import Random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uptake.functions.ordered import carry_forward, chunk_of, consecutive_ids
from uptake.functions.text import clean_cell, snake_case
from uptake.operators import ingest as I
from uptake.plans import lens
from uptake.sources.files import read_sheet, scratch_path


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("Status Division", "status_division"), ("AssetName", "asset_name"),
        ("  PIC (Owner)  ", "pic_owner"), ("PIIData", "pii_data"), ("IPAddress2Go", "ip_address2_go"),
        ("2G/4G", "2_g_4_g"), ("ABC", "abc"), ("a__b--c", "a_b_c"), ("xYzW", "x_yz_w"),
        ("os", "os"), ("Tag - DB System", "tag_db_system"), ("AbC", "ab_c"),
    ],
)
def test_snake_case(name, expected):
    assert snake_case(name) == expected


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aZbY09 _-/.", max_size=12))
def test_snake_case_is_a_name(name):
    out = snake_case(name)
    assert out == out.lower().strip("_") and "__" not in out
    assert snake_case(out) == out
    letters = [c.lower() for c in name if c.isalnum()]
    assert [c for c in out if c != "_"] == letters


def test_clean_cell(spark):
    cases = [
        ("", None), ("  ", None), ("-", None), (None, None), (" a  b ", "a b"), ("a\n\tb", "a b"),
        (" - ", "-"), (" x y", "x y"), ("--", "--"), (" ", None), ("a-b", "a-b"),
    ]
    df = spark.createDataFrame(cases, "v string, expected string")
    assert df.where(~clean_cell(F.col("v")).eqNullSafe(F.col("expected"))).isEmpty()


def sheet(spark, rows, columns):
    """Rows in order, five to a block."""
    placed = [("f", i // 5, i, *r) for i, r in enumerate(rows)]
    schema = "source_file string, source_block long, source_row long, " + columns
    return spark.createDataFrame(placed, schema)


def folded(rows):
    out = []
    for key, text in rows:
        if (key is not None and key.strip()) or not any(k and k.strip() for k, _ in out):
            out.append([key, text])
        elif text is not None:
            out[-1][1] = text if out[-1][1] is None else out[-1][1] + "\n" + text
    return [tuple(r) for r in out]


@pytest.mark.parametrize("seed", range(3))
def test_fold_over_block_borders(spark, seed):
    rnd = Random(seed)
    rows = [(None, "early"), ("  ", None)]
    rows += [
        (rnd.choice([None, None, None, "", f"k{i}"]), rnd.choice([None, f"v{i}", " "]))
        for i in range(60)
    ]
    df = I.fold_rows(sheet(spark, rows, "status_division string, text string"), "status_division")
    got = [(r.status_division, r.text) for r in df.orderBy("source_row").collect()]
    assert got == folded(rows)


def test_fold_keeps_id_and_key_of_the_first_row(spark):
    rows = [(1, "k", "a"), (2, " ", "b"), (3, None, None), (4, "m", None)]
    df = sheet(spark, rows, "id int, status_division string, x string")
    got = {tuple(r) for r in I.fold_rows_status_division(df).select("id", "status_division", "x").collect()}
    assert got == {(1, "k", "a\nb"), (4, "m", None)}


def test_fold_no(spark):
    df = sheet(spark, [("1", "a"), (None, "b")], "no string, x string")
    assert [r.x for r in I.fold_rows_no(df).collect()] == ["a\nb"]
    other = sheet(spark, [("a",)], "x string")
    assert I.fold_rows_no(other).count() == 1


def test_files_do_not_continue_each_other(spark):
    df = sheet(spark, [("k", "a")], "no string, x string").unionByName(
        sheet(spark, [(None, "b")], "no string, x string").withColumn("source_file", F.lit("g"))
    )
    got = {(r.source_file, r.no, r.x) for r in I.fold_rows_no(df).collect()}
    assert got == {("f", "k", "a"), ("g", None, "b")}


def test_consecutive_ids_and_carry_forward(spark):
    df = spark.range(0, 3000, 7).select(F.col("id").alias("o")).withColumn("c", chunk_of("o", 100))
    rows = consecutive_ids(df, ["c"], "o").orderBy("o").collect()
    assert [r.id for r in rows] == list(range(1, len(rows) + 1))
    value = F.when(F.col("o") % 1000 < 7, F.col("o"))
    carried = carry_forward(df, value, "last", [], ["c"], "o").orderBy("o").collect()
    last = None
    for r in carried:
        last = r.o if r.o % 1000 < 7 else last
        assert r["last"] == last


def test_next_ids(spark):
    table = spark.createDataFrame([(41,), (7,)], "id int")
    new = sheet(spark, [("a",), ("b",)], "x string")
    got = {(r.id, r.x) for r in I.next_ids(table, new).collect()}
    assert got == {(42, "a"), (43, "b")}
    first = I.next_ids(table.limit(0), new).collect()
    assert {r.id for r in first} == {1, 2}


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "`Asset Name` int, ` ` int, no int, `a.b` int")
    assert I.snake_case_columns(df, drop=["no"]).columns == ["asset_name", "a_b"]
    with pytest.raises(ValueError):
        I.snake_case_columns(df.withColumnRenamed("no", "asset-name"))


def test_lengths_and_types(spark):
    df = spark.createDataFrame([("x" * 256, "é", 1), (None, "ab", 2)], "a string, b string, id int")
    got = {r.column_name: (r.max_length, r.too_long) for r in I.column_lengths(df).collect()}
    assert got == {"a": (256, True), "b": (2, False)}
    types = I.column_types(["id", "description", "status"])
    assert [f.dataType for f in types] == [T.IntegerType(), T.StringType(), T.VarcharType(255)]


CSV = '''Status Division,no,AssetName,,Description
 Net ,1,Alpha,x,"first line
second line"
,,Beta,y,-
,,,,more
 Core  Team ,2,-,z,""
'''


def test_ingest_a_csv_file(spark):
    path = scratch_path(spark, "sheet") + ".csv"
    local = path.removeprefix("file:")
    os.makedirs(os.path.dirname(local), exist_ok=True)
    with open(local, "w") as f:
        f.write(CSV)
    table = I.catalog_ingest(read_sheet(spark, path, multiline=True), "status_division", drop=["no"])
    assert table.columns == ["id", "status_division", "asset_name", "description"]
    rows = [tuple(r) for r in table.orderBy("id").collect()]
    assert rows == [
        (1, "Net", "Alpha Beta", "first line second line - more"),
        (2, "Core Team", None, None),
    ]
    target = scratch_path(spark, "table")
    for _ in range(2):
        I.recreate_table(table, target)
    assert spark.read.parquet(target).count() == 2


def test_row_order_of_a_split_file(spark):
    """Blocks of a file that is read by several tasks."""
    path = scratch_path(spark, "sheet") + ".csv"
    local = path.removeprefix("file:")
    os.makedirs(os.path.dirname(local), exist_ok=True)
    with open(local, "w") as f:
        f.write("no,x\n" + "".join(f"{i if i % 10 == 0 else ''},{i}\n" for i in range(4000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        df = read_sheet(spark, path)
        assert df.select("source_block").distinct().count() > 3
        numbered = I.surrogate_id(df).select("id", "x")
        assert numbered.where("id <> CAST(x AS INT) + 1").isEmpty()
        text = {r.no: r.x for r in I.fold_rows_no(df).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert text == {
        str(k): "\n".join(str(i) for i in range(k, k + 10)) for k in range(0, 4000, 10)
    }


def test_ingest_rejects_long_values(spark):
    long = sheet(spark, [("x" * 256, "y" * 500)], "name string, description string")
    assert I.catalog_ingest(long.withColumn("name", F.lit("ok"))).count() == 1
    with pytest.raises(PySparkException):
        I.catalog_ingest(long).collect()


def test_a_record_of_too_many_rows_fails(spark, sf_dir):
    rows = lens.keyed_sheet(spark, sf_dir)
    assert I.fold_rows(rows, "no").count() > 0
    with pytest.raises(PySparkException, match="more than 1 rows"):
        I.fold_rows(rows, "no", most_rows=1).collect()


def test_a_failed_load_leaves_the_old_rows(spark):
    path = scratch_path(spark, "table")
    I.recreate_table(spark.range(3), path)
    long = sheet(spark, [("x" * 256, "y")], "name string, description string")
    with pytest.raises(PySparkException):
        I.recreate_table(I.catalog_ingest(long), path)
    assert spark.read.parquet(path).count() == 3


def test_a_table_can_be_updated_from_itself(spark):
    path = scratch_path(spark, "table")
    I.recreate_table(spark.range(3), path)
    for _ in range(2):
        I.update_table(spark, path, lambda t: t.withColumn("id", F.col("id") + 10))
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [20, 21, 22]


def test_chunks_of_the_sheet_follow_its_rows(spark, sf_dir):
    rows = lens.sheet(spark, sf_dir).count()
    assert lens.sheet(spark, sf_dir).select("source_block").distinct().count() == 1
    chunks = lens.sheet(spark, sf_dir, 10).select("source_block").distinct().count()
    assert rows / 20 < chunks <= rows / 10 + 1
    numbered = I.surrogate_id(lens.keyed_sheet(spark, sf_dir))
    assert sorted(r.id for r in numbered.collect()) == list(range(1, rows + 1))


def test_other_formats_are_rejected(spark):
    with pytest.raises(ValueError):
        read_sheet(spark, "/nowhere/book.xlsx")


def test_a_long_record_fails_before_its_cells_are_gathered(spark):
    plan = I.fold_rows(spark.createDataFrame([("f", 1, 1, "k", "v")], "source_file string, "
        "source_block int, source_row int, status_division string, v string"), "status_division",
        most_rows=1)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("collect_list") < plan.index("raise_error")  # plans list the last step first
