from __future__ import annotations

import re
from datetime import date
from decimal import Decimal

import pytest

from uptake.operators.taker import taker_border
from uptake.operators.whitelist import wl_border
from uptake.plans import lens

MAY, JUNE = date(2026, 5, 1), date(2026, 6, 1)


@pytest.fixture(scope="module")
def dim(spark):
    """Subscriber 3 is held twice, 4 is unknown."""
    rows = [(1, "K1", "R1", "WEST", "a"), (2, "K2", "R1", "WEST", "b"),
            (3, "K1", "R2", "EAST", "a"), (3, "K3", "R2", "EAST", "c")]
    return spark.createDataFrame(rows, "msisdn long, kabupaten string, region_sales string, "
                                 "area_sales string, los string")  # fmt: skip


@pytest.fixture(scope="module")
def target_days(spark):
    rows = [(MAY, 10, 1, date(2026, 5, 2), date(2026, 5, 3)),
            (MAY, 10, 2, date(2026, 5, 30), None),
            (MAY, 10, 3, date(2026, 5, 29), date(2026, 5, 31)),
            (MAY, 10, None, date(2026, 5, 1), None),
            (MAY, 11, 4, date(2026, 5, 5), date(2026, 5, 5)),
            (MAY, None, 1, date(2026, 5, 5), date(2026, 5, 5)),
            (JUNE, 10, 1, None, None)]
    return spark.createDataFrame(rows, "strmonth date, offer_id long, msisdn_wl long, "
                                 "start_date date, delivered_date date")  # fmt: skip


@pytest.fixture(scope="module")
def taker_days(spark):
    d = Decimal
    rows = [(MAY, 10, 1, "HALO", date(2026, 5, 2), 2, d("1.5000")),
            (MAY, 10, 1, "HALO", date(2026, 5, 31), 1, d("2.0000")),
            (MAY, 10, 3, "AREA", date(2026, 5, 30), None, d("4.0000")),
            (MAY, 10, None, "AREA", date(2026, 5, 3), 5, None),
            (MAY, 11, 4, "BYU", date(2026, 6, 4), 7, d("1.0000")),
            (MAY, None, 2, "BYU", date(2026, 5, 4), 7, d("1.0000"))]
    return spark.createDataFrame(rows, "strmonth date, offer_id long, msisdn long, "
                                 "tower_name string, take_date date, trx long, "
                                 "revenue decimal(18,4)")  # fmt: skip


def _same(a, b):
    assert a.schema == b.schema
    assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str)


def _subscriber_shuffles(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange hashpartitioning\([^)]*msisdn", plan))


def test_wl_border_snapshots_match_the_operator_on_copies(spark, target_days, dim):
    copies = lens.whitelist_snapshots(target_days)
    _same(lens.wl_border_snapshots(target_days, dim), wl_border(copies, dim, by=lens.SNAPSHOT))


def test_taker_border_snapshots_match_the_operator_on_copies(spark, taker_days, dim):
    copies = lens.daily_snapshots(taker_days, "take_date", -2, 0, data_name="data_date")
    expected = taker_border(copies, dim, by=["extract_date", "data_date"])
    _same(lens.taker_border_snapshots(taker_days, dim), expected)


def test_wl_border_snapshots_shuffle_subscribers_once(spark, target_days, dim):
    """Facts meet the dimension in one shuffle by subscriber, not after one per snapshot copy."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # One exchange of the facts and one of the dimension.
        assert _subscriber_shuffles(lens.wl_border_snapshots(target_days, dim)) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_taker_border_snapshots_shuffle_no_copies(spark, taker_days, dim):
    """Rows are dealt by offer and month once after the join; copies per level and snapshot
    are counted where they are made, not shuffled."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = lens.taker_border_snapshots(taker_days, dim)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.findall(r"Exchange hashpartitioning\(level", plan)
        assert len(re.findall(r"Exchange hashpartitioning\(strmonth#\d+L?, offer_id#\d+L?, \d+\)", plan)) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_wl_border_snapshots_shuffle_no_copies(spark, target_days, dim):
    """Snapshot copies of the whitelist are counted per border where they are made."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = lens.wl_border_snapshots(target_days, dim)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.findall(r"Exchange hashpartitioning\(level", plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
