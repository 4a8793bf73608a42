"""KPI rules on hand-made rows, and laws that hold for any rows."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from uptake.functions.dates import in_month
from uptake.functions.grouping import rollup_sets
from uptake.functions.kpi import clamp_take_up_rate, exact_mean, ratio, take_up_rate, wltype_bucket
from uptake.operators import border, snapshots, summary, top_level
from uptake.operators.load import replace_partitions
from uptake.operators.tur import tur_formulation
from uptake.plans.queries import QUERIES
from uptake.sources.files import scratch_path
from uptake.sources.schemas import EXTRACTS

MAY, D = date(2026, 5, 1), date(2026, 5, 20)
DAY = date(2026, 5, 18)


def day(n: int) -> date:
    return date(2026, 5, n)


def campaigns(spark, rows):
    """(offer, tower, product, initiative, channel, wltype, extract day of May)."""
    schema = EXTRACTS["campaign_summary"]
    full = []
    for offer, tower, product, initiative, channel, wltype, extracted in rows:
        r = dict.fromkeys(schema.fieldNames())
        r |= {
            "extract_date": day(extracted), "d_date": day(extracted - 2), "strmonth": MAY,
            "offer_id": offer, "tower": tower, "product": product, "wltype": wltype,
            "campaign_initiatives": initiative, "communication_channel": channel,
        }
        full.append(tuple(r[c] for c in schema.fieldNames()))
    return spark.createDataFrame(full, schema)


def targets(spark, rows):
    """(offer, targeted, delivered, extract day of May)."""
    return spark.createDataFrame(
        [(day(e), day(e - 2), MAY, o, w, d) for o, w, d, e in rows], EXTRACTS["wl_offer"]
    )


def takers(spark, rows):
    """(offer, takers, transactions, revenue, extract day of May)."""
    return spark.createDataFrame(
        [(day(e), day(e - 2), MAY, o, n, t, Decimal(r)) for o, n, t, r, e in rows],
        EXTRACTS["taker_offer"],
    )


def test_take_up_rate_rules(spark):
    cases = [
        (100.0, 50.0, 10.0, 0.2), (100.0, 50.0, 60.0, 0.6), (100.0, 50.0, 50.0, None),
        (100.0, 0.0, 10.0, None), (100.0, 50.0, 0.0, None), (None, 50.0, 60.0, None),
        (100.0, None, 10.0, None), (100.0, 50.0, None, None),
    ]
    df = spark.createDataFrame(cases, "wl double, delivered double, taker double, expected double")
    rate = take_up_rate(F.col("taker"), F.col("delivered"), F.col("wl"))
    assert df.where(~rate.eqNullSafe(F.col("expected"))).isEmpty()


def test_clamp_and_bucket(spark):
    df = spark.createDataFrame([(0.3, "x RuleBased y"), (0.29, None)], "tur double, wltype string")
    got = df.select(
        clamp_take_up_rate(F.col("tur")).alias("t"), wltype_bucket(F.col("wltype")).alias("w")
    )
    assert [tuple(r) for r in got.collect()] == [(0.01, "RULEBASED"), (0.29, "REGULER")]


def test_ratio_by_zero_is_null(spark):
    assert spark.range(1).select(ratio(F.lit(1), F.lit(0)).alias("r")).first().r is None


def test_exact_mean_ignores_nulls_and_order(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,), (0.3,)], "v double")
    for parts in (1, 3):
        assert df.repartition(parts).agg(exact_mean(F.col("v")).alias("m")).first().m == 0.6 / 3


def test_subtotal_label_is_not_a_null_value(spark):
    df = spark.createDataFrame([("m", None, 1), ("m", "t", 2)], "k string, tower string, n int")
    got = rollup_sets(df, ["k"], [[], ["tower"]], {"n": F.sum("n")})
    assert {r.tower: r.n for r in got.collect()} == {"ALL": 3, None: 1, "t": 2}


@pytest.fixture(scope="module")
def tables(spark):
    base = [
        (1, "SIMPATI", "data", "One", "SMS", "RuleBased", 20),
        (1, "SIMPATI", "data", "One", "WABA", "RuleBased", 20),
        (2, "HALO", "data", None, None, "x", 20),
        (3, "BYU", "voice", "Three", "SMS", None, 20),
        (4, "AREA", "voice", "Four", "APP", None, 20),
        (1, "SIMPATI", "data", "One", "SMS", "RuleBased", 19),
    ]
    wl = [(1, 100, 0, 20), (2, 50, 40, 20), (3, 10, 10, 20), (4, 8, None, 20), (1, 80, 60, 18)]
    taken = [
        (1, 10, 20, 200, 20), (1, 12, 24, 240, 21), (1, 14, 28, 280, 22), (2, 5, 0, 50, 20),
        (3, 10, 10, 10, 20), (1, 8, 16, 160, 18),
    ]
    return campaigns(spark, base), targets(spark, wl), takers(spark, taken)


def test_tur_formulation_keeps_both_taker_days(tables):
    tur = tur_formulation(*tables)
    got = sorted((r.offer_id, r.communication_channel or "", r.taker or 0, r.tur) for r in tur.collect())
    # Nothing delivered counts as all delivered; offer 3 has as many takers as deliveries.
    assert got == [
        (1, "SMS", 10, 0.1), (1, "SMS", 12, 0.12), (1, "WABA", 10, 0.1), (1, "WABA", 12, 0.12),
        (2, "", 5, 5 / 40), (3, "SMS", 10, None), (4, "APP", 0, None),
    ]


def test_late_days_differ_by_operator(tables):
    tur = tur_formulation(*tables)
    top = {(r.tower, r.wltype): r for r in top_level.top_main_level(*tables, tur).collect()}
    # Offer 1 has two campaign rows; its takers of day 20 and of two days later are summed.
    assert top["SIMPATI", "ALL"].total_taker == 2 * (10 + 14)
    assert top["SIMPATI", "ALL"].total_target == 200
    assert top["SIMPATI", "ALL"].total_campaign == 1
    assert top["ALL", "ALL"].total_campaign == 4
    assert top["BYU", "ALL"].tur is None
    # Offer 1 matches four times (two campaign rows, two days), 2 and 3 once, 4 never.
    assert top["ALL", "ALL"].trackable == pytest.approx(100 * 6 / 7)
    channel = {
        (r.tower, r.wltype, r.communication_channel): r
        for r in summary.summary_channel(*tables, tur).collect()
    }
    assert channel["SIMPATI", "ALL", "SMS"].taker == 10 + 12
    assert channel["SIMPATI", "ALL", "SMS"].revenue_per_taker == 20
    # A campaign without a channel has targets only, month-to-date it is under ALL.
    assert channel["HALO", "ALL", None].total_target == 50
    assert channel["HALO", "ALL", None].taker is None


def test_month_to_date_uses_facts_of_two_days_before(tables):
    tur = tur_formulation(*tables)
    mtd = {(r.tower, r.wltype): r for r in top_level.top_main_level(*tables, tur, mtd=True).collect()}
    assert set(mtd) == {("ALL", "ALL"), ("SIMPATI", "ALL"), ("ALL", "RULEBASED"), ("SIMPATI", "RULEBASED")}
    total = mtd["ALL", "ALL"]
    assert (total.d_date, total.total_target, total.total_taker) == (DAY, 160, 16)
    assert total.delivery_rate == 75


def test_product_cost_and_inner_assembly(tables):
    tur = tur_formulation(*tables)
    products = {
        (r["product"], r.tower): r
        for r in summary.summary_product(*tables, tur).where("wltype = 'ALL'").collect()
    }
    # Voice has an AREA campaign only, on a channel without cost.
    assert set(products) == {("data", "ALL"), ("data", "SIMPATI")}
    assert products["data", "ALL"].cost == 100 * 262 + 100 * 100
    assert products["data", "ALL"].delivery_rate == 100 * (40 / 250)
    everything = summary.summary_product(*tables, tur, how="left").where("wltype = 'ALL'")
    assert {(r["product"], r.tower): r.cost for r in everything.collect()}["voice", "ALL"] is None


def test_l1_rows_of_unknown_initiatives(tables):
    """They keep their measures in the full month, and have targets only month-to-date."""
    tur = tur_formulation(*tables)
    l1 = top_level.top_main_level_l1(*tables, tur).where("tower = 'HALO'")
    got = {(r.wltype, r.initiatives): (r.total_target, r.total_uni_taker) for r in l1.collect()}
    assert got == {("ALL", "ALL"): (50, 5), ("REGULER", "ALL"): (50, 5), ("REGULER", None): (50, 5)}
    mtd = top_level.top_main_level_l1(*tables, tur, mtd=True)
    unknown = mtd.where("initiatives IS NULL").collect()
    assert unknown and all(r.total_target and r.total_uni_taker is None for r in unknown)
    assert mtd.where("tower = 'ALL' OR initiatives = 'ALL'").isEmpty()
    assert {r.d_date for r in mtd.collect()} == {DAY}


def test_empty_month(tables):
    tur = tur_formulation(*tables)
    june = date(2026, 6, 1)
    for operator in (top_level.top_main_level, top_level.top_main_level_l1, summary.summary_channel):
        for mtd in (False, True):
            assert operator(*tables, tur, month=june, mtd=mtd).isEmpty()
            assert not operator(*tables, tur, month=MAY, mtd=mtd).isEmpty()


def test_border_snapshots(spark, tables):
    cells = [
        ("kabupaten", D, DAY, MAY, 1, "K1", 10, 5),
        ("kabupaten", D, DAY, MAY, 1, None, 1, 0),
        ("los", D, DAY, MAY, 1, "x", 9, 9),
        ("kabupaten", day(19), day(17), MAY, 1, "K1", 7, 7),
    ]
    wl = spark.createDataFrame(cells, EXTRACTS["wl_border"])
    one = border.border_wl(tables[0], wl).collect()
    assert {(r.border, r.total_target, r.total_delivered) for r in one} == {("K1", 20, 10), (None, 2, 0)}
    # Offer 1 is in two snapshots with three campaign rows.
    every = border.border_wl(tables[0], wl, all_snapshots=True).collect()
    assert {(r.border, r.total_target) for r in every} == {("K1", 30), (None, 3)}
    level = border.border_of_level(border.border_wl(tables[0], wl, mtd=True), "kabupaten")
    assert "kabupaten" in level.columns and "level" not in level.columns


def test_snapshot_choice(tables):
    base, wl, taken = tables
    assert {r.extract_date for r in snapshots.latest_snapshot(base).collect()} == {D}
    late = snapshots.latest_snapshot_tolerant(taken, base, 1).select("extract_date").distinct()
    assert {r.extract_date for r in late.collect()} == {D, day(21)}
    lagged = snapshots.lagged_snapshot(wl, base).collect()
    assert [(r.extract_date, r.msisdn_wl) for r in lagged] == [(DAY, 80)]


@pytest.mark.parametrize("name", ["top_main_level", "top_main_level_mtd"])
def test_subtotals_are_sums_of_leaves(spark, sf_dir, name):
    kpi = QUERIES[name](spark, sf_dir).cache()
    leaves = kpi.where("tower <> 'ALL' AND wltype <> 'ALL'").groupBy("strmonth").agg(
        F.sum("total_target").alias("target"),
        F.sum("total_taker").alias("taker"),
        F.sum("total_campaign").alias("campaign"),
    )
    both = kpi.where("tower = 'ALL' AND wltype = 'ALL'").join(leaves, "strmonth")
    assert both.count() > 0
    assert both.where("total_target <> target OR NOT (total_taker <=> taker)").isEmpty()
    assert both.where("total_campaign < campaign").isEmpty()


def test_snapshot_dates_prune_partitions(spark, tables):
    """With a month, only the chosen extract dates of a stored snapshot table are read."""
    summary, wl = (scratch_path(spark, n) for n in ("summary", "wl"))
    replace_partitions(tables[0], summary, ["strmonth", "extract_date"])
    replace_partitions(tables[1], wl, ["strmonth", "extract_date"])
    month = in_month(spark.read.parquet(summary), MAY)
    lagged = snapshots.lagged_snapshot(in_month(spark.read.parquet(wl), MAY), month)
    plan = lagged._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpru" in plan and "BroadcastHashJoin" in plan
    assert [r.msisdn_wl for r in lagged.collect()] == [80]
