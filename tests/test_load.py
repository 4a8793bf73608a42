from __future__ import annotations

from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from uptake.functions.dates import run_dates
from uptake.operators import load, taker, whitelist
from uptake.operators.extract import campaign_summary_extract
from uptake.plans import lens
from uptake.plans.queries import RUN_DATE
from uptake.sources import jdbc
from uptake.sources.files import (
    put_in_place, read_csv, read_table, repair, scratch_path, write_csv,
)
from uptake.sources.schemas import EXTRACTS, SYNC_KEYS

APRIL, MAY = date(2026, 4, 1), date(2026, 5, 1)


@pytest.fixture
def path(spark):
    return scratch_path(spark, "test")


def kpi(spark, *rows):
    return spark.createDataFrame(list(rows), "strmonth date, tower string, n int")


def stored(spark, path):
    return sorted((r.strmonth, r.tower, r.n) for r in spark.read.parquet(path).collect())


def test_run_dates():
    dates = run_dates(date(2026, 3, 1))
    assert dates.data_date == date(2026, 2, 27)
    assert dates.strmonth == dates.wl_dim_date == date(2026, 2, 1)
    assert dates.taker_dim_date == date(2026, 2, 28)


def test_replace_slice_is_idempotent_and_local(spark, path):
    load.replace_partitions(kpi(spark, (APRIL, "A", 1), (MAY, "A", 2)), path, ["strmonth"])
    for _ in range(2):
        assert load.replace_slice(kpi(spark, (MAY, "B", 3)), path, {"strmonth": MAY}) == 1
    assert stored(spark, path) == [(APRIL, "A", 1), (MAY, "B", 3)]


def test_replace_slice_by_nothing(spark, path):
    load.replace_partitions(kpi(spark, (APRIL, "A", 1), (MAY, "A", 2)), path, ["strmonth"])
    with pytest.raises(ValueError):
        load.replace_slice(kpi(spark, (MAY, "A", 2)).limit(0), path, {"strmonth": MAY}, False)
    assert len(stored(spark, path)) == 2
    load.replace_slice(kpi(spark, (MAY, "A", 2)).limit(0), path, {"strmonth": MAY})
    assert stored(spark, path) == [(APRIL, "A", 1)]


def test_failed_replace_keeps_the_old_rows(spark, path):
    load.replace_partitions(kpi(spark, (MAY, "A", 2)), path, ["strmonth"])
    with pytest.raises(PySparkException):
        load.replace_slice(kpi(spark, (MAY, "B", 3), (APRIL, "B", 3)), path, {"strmonth": MAY})
    assert stored(spark, path) == [(MAY, "A", 2)]


def test_two_keys(spark, path):
    rows = kpi(spark, (MAY, "A", 1), (MAY, "B", 2))
    load.replace_partitions(rows, path, ["strmonth", "tower"])
    load.replace_slice(kpi(spark, (MAY, "B", 9)), path, {"strmonth": MAY, "tower": "B"})
    assert stored(spark, path) == [(MAY, "A", 1), (MAY, "B", 9)]


def test_sync_strategies(spark, path):
    load.replace_partitions(kpi(spark, (APRIL, "A", 1), (MAY, "A", 2)), path, ["strmonth"])
    source = kpi(spark, (MAY, "A", 5), (MAY, "B", 6), (APRIL, "A", 7))
    assert load.sync_upsert(source, path, "strmonth", MAY, ["tower"]) == 2
    assert stored(spark, path) == [(APRIL, "A", 1), (MAY, "A", 5), (MAY, "B", 6)]
    assert load.sync_by_key(source, path, "strmonth", date(2026, 6, 1)) == 0
    assert load.sync_by_key(source, path, "strmonth", APRIL) == 1
    assert load.sync_append(source, path, "strmonth", APRIL) == 1
    april = [r for r in stored(spark, path) if r[0] == APRIL]
    assert april == [(APRIL, "A", 7), (APRIL, "A", 7)]
    dates = [r.strmonth for r in load.available_dates(spark.read.parquet(path), "strmonth").collect()]
    assert dates == [MAY, APRIL]


def test_sync_table_takes_the_key_from_the_table(spark, path):
    source = kpi(spark, (MAY, "A", 1), (APRIL, "A", 2))
    for _ in range(2):
        load.sync_table(source, "summary_channel", path, MAY)
    assert stored(spark, path) == [(MAY, "A", 1)]
    load.sync_table(source, "summary_channel", path, MAY, "append")
    assert len(stored(spark, path)) == 2
    load.sync_table(source, "summary_channel", path, MAY, "upsert", ["tower"])
    assert stored(spark, path) == [(MAY, "A", 1)]
    with pytest.raises(ValueError):
        load.sync_table(source, "summary_channel", path, MAY, "merge")


def test_upsert_law(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string")
    new = spark.createDataFrame([(2, "x"), (3, "y")], "k int, v string")
    merged = sorted(map(tuple, load.upsert(old, new, ["k"]).collect()))
    assert merged == [(1, "a"), (2, "x"), (3, "y")]
    again = sorted(map(tuple, load.upsert(load.upsert(old, new, ["k"]), new, ["k"]).collect()))
    assert again == merged


def test_upsert_treats_nulls_as_equal_and_fails_on_repeated_keys(spark, path):
    rows = spark.createDataFrame(
        [(MAY, "A", 1), (MAY, None, 2)], "strmonth date, tower string, n int"
    )
    for _ in range(2):  # the first one finds no table
        assert load.sync_upsert(rows, path, "strmonth", MAY, ["tower"]) == 2
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(PySparkException, match="several new rows"):
        load.sync_upsert(rows.unionByName(rows), path, "strmonth", MAY, ["tower"])
    assert spark.read.parquet(path).count() == 2


@pytest.mark.parametrize("value", ["a/b:c", None, "x y%=", "plain"])
def test_emptying_a_slice_of_any_value(spark, path, value):
    rows = spark.createDataFrame([(value, 1), ("other", 2)], "k string, n int")
    load.replace_partitions(rows, path, ["k"])
    assert load.replace_slice(rows.where("n = 3"), path, {"k": value}) == 0
    assert [tuple(r) for r in spark.read.parquet(path).select("k", "n").collect()] == [("other", 2)]
    assert load.replace_slice(rows.where("n = 3"), path, {"k": "absent"}) == 0
    assert spark.read.parquet(path).select("k").distinct().count() == 1


def test_replace_month_to_date_takes_the_newest_day(spark, path):
    schema = "strmonth date, d_date date, n int"
    days = [date(2026, 5, 2), date(2026, 5, 3)]
    old = spark.createDataFrame([(MAY, d, i) for i, d in enumerate(days)], schema)
    load.replace_partitions(old, path, ["strmonth", "d_date"])
    new = spark.createDataFrame([(MAY, days[1], 9), (APRIL, date(2026, 5, 1), 8)], schema)
    assert load.replace_month_to_date(new, path, MAY) == 1
    got = sorted((r.d_date, r.n) for r in spark.read.parquet(path).collect())
    assert got == [(days[0], 0), (days[1], 9)]
    assert load.replace_month_to_date(new.limit(0), path, MAY, days[0]) == 0
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError):
        load.replace_month_to_date(new.limit(0), path, MAY)


def test_every_extract_can_be_handed_over(spark, sf_dir):
    wl, taken = lens.whitelist(spark, sf_dir), lens.taker(spark, sf_dir)
    dim, day = lens.subscribers(spark, sf_dir), {"extract_date": RUN_DATE}
    made = {
        "campaign_summary": campaign_summary_extract(
            lens.campaigns(spark, sf_dir), RUN_DATE, all_months=True
        ),
        "wl_offer": whitelist.wl_by_offer(wl, **day),
        "wl_border": whitelist.wl_border(wl, dim, **day),
        "wl_recurring": whitelist.wl_recurring(wl, **day),
        "wl_recurring_kabupaten": whitelist.wl_recurring_kabupaten(wl, dim, **day),
        "wl_los": whitelist.wl_los(wl, dim, **day),
        "taker_offer": taker.taker_by_offer(taken, **day),
        "taker_border": taker.taker_border(taken, dim, **day),
    }
    assert set(made) == set(EXTRACTS)
    for name, rows in made.items():
        csv, path = scratch_path(spark, "csv"), scratch_path(spark, name)
        rows = rows.where("strmonth = '1997-03-01'")
        if name == "campaign_summary":
            rows = rows.withColumn("email_user", F.lit("user"))  # line breaks are cleaned elsewhere
        write_csv(rows, csv)
        assert load.stage_and_replace(spark, csv, path, EXTRACTS[name], RUN_DATE) == rows.count() > 0


def test_sync_reads_one_partition(spark, path):
    load.replace_partitions(kpi(spark, (APRIL, "A", 1), (MAY, "A", 2)), path, ["strmonth"])
    slice_ = load.slice_by_key(spark.read.parquet(path), "strmonth", MAY)
    plan = slice_._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(strmonth" in plan
    assert len(slice_.inputFiles()) == 2 and slice_.count() == 1


def test_stage_and_replace(spark, path):
    schema = EXTRACTS["wl_offer"]
    rows = spark.createDataFrame(
        [(MAY, date(2026, 4, 29), APRIL, 1, 10, None), (MAY, date(2026, 4, 29), APRIL, 2, 5, 5)], schema
    )
    csv = scratch_path(spark, "csv")
    write_csv(rows, csv)
    for _ in range(2):
        assert load.stage_and_replace(spark, csv, path, schema, MAY) == 2
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.select(*schema.fieldNames()).collect())) == sorted(
        map(tuple, rows.collect())
    )
    with pytest.raises(PySparkException):
        load.stage_and_replace(spark, csv, path, schema, APRIL)
    with pytest.raises(PySparkException):
        load.stage_and_replace(spark, f"{csv}-missing", path, schema, MAY)
    empty = scratch_path(spark, "csv")
    write_csv(rows.limit(0), empty)
    with pytest.raises(ValueError):
        load.stage_and_replace(spark, empty, path, schema, MAY)
    assert spark.read.parquet(path).count() == 2


def test_csv_keeps_cells_as_they_are(spark):
    df = spark.createDataFrame(
        [(" a ", 'say "x", \\ y', None, "two\nlines"), ("", "b", "c", "d")],
        "a string, b string, c string, d string",
    )
    csv = scratch_path(spark, "csv")
    write_csv(df, csv)
    back = sorted(map(tuple, read_csv(spark, csv, df.schema, multiline=True).collect()), key=str)
    # An empty cell is null, as it is in the hand-over files.
    assert back == [(" a ", 'say "x", \\ y', None, "two\nlines"), (None, "b", "c", "d")]


def test_csv_of_another_layout_fails(spark):
    csv = scratch_path(spark, "csv")
    write_csv(spark.range(3), csv)
    with pytest.raises(Exception, match="Number of column in CSV header"):
        read_csv(spark, csv, EXTRACTS["wl_offer"]).collect()


def test_read_table_by_name_or_path(spark, path):
    spark.range(3).write.parquet(path)
    read_table(spark, path).createOrReplaceTempView("three")
    assert read_table(spark, "three").count() == 3


def test_non_empty_check(spark):
    assert load.require_rows(spark.range(1), "range").count() == 1
    with pytest.raises(ValueError):
        load.require_rows(spark.range(0), "range")


def test_every_sync_key_is_a_date_column():
    assert set(SYNC_KEYS.values()) == {"strmonth", "d_date", "extract_date"}
    for table in set(SYNC_KEYS) & set(EXTRACTS):
        assert SYNC_KEYS[table] in EXTRACTS[table].fieldNames()


def test_jdbc_slice_has_columns_and_predicate(spark):
    class Reader(dict):
        def format(self, name):
            return self

        def options(self, **options):
            self.update(options)
            return self

        def option(self, key, value):
            self[key] = value
            return self

        def load(self):
            return kpi(spark, (MAY, "A", 1), (APRIL, "A", 2))

    class Session:
        read = Reader()

    got = jdbc.read_slice(Session(), {"url": "u"}, "kpi", ["tower", "n"], "strmonth", MAY)
    assert [tuple(r) for r in got.collect()] == [("A", 1)]
    assert Session.read == {"url": "u", "dbtable": "kpi"}


class FakeWriter:
    def __init__(self):
        self.options_set, self.done = {}, []

    def format(self, name):
        self.done.append(name)
        return self

    def mode(self, name):
        self.done.append(name)
        return self

    def options(self, **options):
        self.options_set |= options
        return self

    def option(self, key, value):
        self.options_set[key] = value
        return self

    def save(self):
        self.done.append("save")


@pytest.mark.parametrize(("write", "mode"), [(jdbc.append, "append"), (jdbc.recreate, "overwrite")])
def test_jdbc_options_come_from_the_caller(write, mode):
    class Frame:
        write = FakeWriter()

    frame = Frame()
    frame.write = FakeWriter()
    write(frame, {"url": "jdbc:somewhere", "user": "u"}, "kpi")
    assert frame.write.done == ["jdbc", mode, "save"]
    assert frame.write.options_set == {
        "url": "jdbc:somewhere", "user": "u", "dbtable": "kpi", "batchsize": 1000,
    }


def test_scratch_is_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two
    if root:
        assert one.startswith(root)


@pytest.mark.parametrize("reload", [False, True])
def test_a_load_stopped_between_its_renames_is_repaired(spark, tmp_path, reload):
    path = tmp_path / "table"
    spark.range(3).write.parquet(str(path))
    path.rename(f"{path}-replaced-{'0' * 31}f")  # the second rename never came
    if reload:
        spark.range(5).write.parquet(str(tmp_path / "staged"))
        put_in_place(spark, str(tmp_path / "staged"), str(path))
    assert read_table(spark, str(path)).count() == (5 if reload else 3)
    assert [p.name for p in tmp_path.iterdir()] == ["table"]
    assert not repair(spark, str(path)) and not repair(spark, str(tmp_path / "none"))
