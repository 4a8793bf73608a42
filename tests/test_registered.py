"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from tests.compare import connect, difference
from uptake.plans.extracts import Extracts, extracts
from uptake.plans.oracles import ORACLES
from uptake.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert difference(df, con, ORACLES[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan
    assert "Python" not in plan


def test_entry_point_has_every_query():
    assert QUERIES.items() <= entry_point.queries().items()
    assert ORACLES.items() <= entry_point.oracle_sql().items()
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert not entry_point.entry(spark).isEmpty()


@pytest.mark.parametrize(
    "name", ["top_main_level", "top_main_level_l1_mtd", "summary_channel_mtd", "border_wl"]
)
def test_kpis_read_the_snapshots_they_need(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_extracts_follow_from_facts_joined_once(spark, sf_dir):
    run = extracts(spark, sf_dir)
    run.store_all()
    for table in (run.summary, run.wl_offer, run.taker_offer, run.wl_border, run.taker_border):
        assert all("strmonth=" in f for f in table.inputFiles())
    for days in (run._target_days, run._taker_days):
        assert not any("lineitem" in f or "orders" in f for f in days.inputFiles())


def test_a_large_month_of_an_extract_is_several_tasks(spark, sf_dir):
    """Several files of one month, and several small months in one task."""
    months = spark.range(0, 2_000_000, 1, 8).selectExpr(
        "date_add('2024-01-01', CAST(IF(id < 1900000, 0, 31 * (id % 3)) AS int)) AS strmonth", "id * 7 AS v"
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "1m")
    try:
        table = Extracts(spark, sf_dir)._table("months", lambda: months)
        files = [f.split("strmonth=")[1].split("/") for f in table.inputFiles()]
    finally:
        spark.conf.unset(key)
    january = [name for month, name in files if month == "2024-01-01"]
    assert len(january) > 2 and len({month for month, _ in files}) == 3
    assert table.count() == 2_000_000


def test_initiatives_sum_to_the_total(spark):
    """Campaigns without an initiative included."""
    rows = QUERIES["top_main_level_l1"](spark, "/root/testdata/sf0.01").persist()
    sums = ["total_revenue", "delivered", "total_uni_taker", "total_target"]
    whole = rows.where("tower = 'ALL' AND wltype = 'ALL' AND initiatives = 'ALL'")
    leaves = rows.where("tower <> 'ALL' AND wltype <> 'ALL'").where(
        "initiatives IS NULL OR initiatives <> 'ALL'"
    )
    assert leaves.where("initiatives IS NULL AND total_revenue > 0").count()
    for c in sums:
        assert leaves.agg(F.sum(c)).first()[0] == pytest.approx(whole.agg(F.sum(c)).first()[0])
