from __future__ import annotations

from collections import defaultdict
from datetime import date
from decimal import Decimal
from random import Random

import pytest
from pyspark.sql import functions as F

from uptake.operators import taker as T
from uptake.operators import whitelist as W
from uptake.operators.load import replace_partitions
from uptake.sources.files import scratch_path
from uptake.sources.schemas import SUBSCRIBER, TAKER, WHITELIST

MAY = date(2026, 5, 1)
HOT = 7


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def facts():
    """Subscriber 7 and offer 1 each hold a third of the rows; some values are unknown."""
    rnd = Random(3)
    out = []
    for i in range(600):
        msisdn = HOT if i % 3 == 0 else rnd.choice([*range(20, 40), None])
        offer = 1 if i % 3 == 1 else rnd.choice([2, 3, 4, None])
        delivered = rnd.choice([None, msisdn, msisdn, rnd.randint(20, 45)])
        start = rnd.choice([None, date(2026, 5, 3), date(2026, 5, 9), date(2026, 5, 20)])
        out.append((MAY, offer, msisdn, delivered, start))
    return out


@pytest.fixture(scope="module")
def wl(spark, facts):
    return spark.createDataFrame(facts, WHITELIST)


@pytest.fixture(scope="module")
def dim(spark):
    """Subscribers 20-29 and 7 known, 22 twice with the same kabupaten, 23 with another."""
    people = [(MAY, n, f"K{n % 3}", f"R{n % 2}", "A", "0-1") for n in [7, *range(20, 30)]]
    people += [(MAY, 22, "K1", "R0", "A", "0-1"), (MAY, 23, "K0", "R9", "A", "1-2")]
    people += [(date(2026, 4, 1), 20, "old", "old", "old", "old")]
    return spark.createDataFrame(people, SUBSCRIBER)


def test_distinct_reach_with_other_receivers(wl, facts):
    expected = {}
    for offer in {f[1] for f in facts} - {None}:
        mine = [f for f in facts if f[1] == offer]
        expected[offer] = (len({f[2] for f in mine} - {None}), len({f[3] for f in mine} - {None}))
    got = {r.offer_id: (r.msisdn_wl, r.msisdn_delivered) for r in W.wl_by_offer(wl).collect()}
    assert got == expected


def test_month_and_tags(wl):
    assert W.wl_by_offer(wl, month=date(2026, 6, 1)).isEmpty()
    first = W.wl_by_offer(wl, MAY, date(2026, 5, 20)).first()
    assert (first.extract_date, first.d_date) == (date(2026, 5, 20), date(2026, 5, 18))


def test_border_repeats_subscribers_the_dimension_repeats(wl, dim, facts):
    people = defaultdict(list)
    for r in dim.where(F.col("event_date") == MAY).collect():
        people[r.msisdn].append(r)
    pairs = defaultdict(list)
    for _, offer, msisdn, delivered, _ in facts:
        if offer is not None:
            pairs[offer, msisdn].append(delivered)
    expected = defaultdict(lambda: [0, 0])
    for (offer, msisdn), delivered in pairs.items():
        for level in ("area_sales", "kabupaten", "region_sales"):
            for person in people.get(msisdn, [None]):
                cell = expected[level, offer, person and person[level]]
                cell[0] += 1
                cell[1] += any(d is not None for d in delivered)
    got = {
        (r.level, r.offer_id, r.border): [r.total_msisdn, r.msisdn_delivered]
        for r in W.wl_border(wl, dim, dim_date=MAY).collect()
    }
    assert got == dict(expected)


def test_recurring_counts_a_subscriber_once_per_day(wl, facts):
    offers = defaultdict(set)
    for _, offer, msisdn, _, start in facts:
        if msisdn is not None:
            offers[start, msisdn] |= {offer} - {None}
    expected = defaultdict(int)
    for (start, _), distinct in offers.items():
        expected[start, len(distinct)] += 1
    got = {(r.start_date, r.total_offer): r.recurring_msisdn for r in W.wl_recurring(wl).collect()}
    assert got == dict(expected)


def test_recurring_kabupaten_totals(wl, dim):
    """A subscriber with two kabupaten counts in both, any other in one."""
    one = W.wl_recurring(wl).agg(F.sum("recurring_msisdn")).first()[0]
    both = W.wl_recurring_kabupaten(wl, dim, dim_date=MAY).agg(F.sum("recurring_msisdn")).first()[0]
    twice = wl.where("msisdn_wl IN (22, 23)").select("start_date", "msisdn_wl").distinct()
    homes = dim.where(F.col("event_date") == MAY).groupBy("msisdn").agg(
        F.countDistinct("kabupaten").alias("n")
    )
    extra = twice.join(homes, twice.msisdn_wl == homes.msisdn).agg(F.sum(F.col("n") - 1)).first()[0]
    assert both == one + extra


def test_first_touch_ties_and_unknown_starts(spark):
    wl = spark.createDataFrame(
        [
            (MAY, 5, 1, None, date(2026, 5, 2)),
            (MAY, 4, 1, None, date(2026, 5, 2)),
            (MAY, 9, 1, None, date(2026, 5, 3)),
            (MAY, 8, 2, None, None),
            (MAY, 8, 2, None, date(2026, 5, 9)),
            (MAY, 6, 2, None, date(2026, 5, 4)),
            (MAY, 3, 3, None, None),
            (MAY, 6, 3, None, date(2026, 5, 1)),
        ],
        WHITELIST,
    )
    got = rows(W.wl_first_touch_attribution(wl), "offer_id", "total_msisdn")
    assert got == [(3, 1), (4, 1), (6, 1)]


@pytest.fixture(scope="module")
def taker(spark, facts):
    towers = ["SIMPATI", "HALO", "AREA", "BYU"]
    taken = [
        (m, towers[i % 4], o, s, i % 5, Decimal(i)) for i, (m, o, s, _, _) in enumerate(facts)
    ]
    return spark.createDataFrame(taken, TAKER)


def test_all_towers_count_a_subscriber_once(taker):
    totals = {r.tower_name: r for r in T.taker_by_tower(taker).collect()}
    core = taker.where("tower_name IN ('SIMPATI','HALO','AREA') AND offer_id IS NOT NULL")
    assert totals["ALL"].total_msisdn == core.agg(F.countDistinct("msisdn")).first()[0]
    leaves = [r for name, r in totals.items() if name != "ALL"]
    assert totals["ALL"].total_msisdn < sum(r.total_msisdn for r in leaves)
    assert totals["ALL"].trx == sum(r.trx for r in leaves)
    assert totals["ALL"].revenue == sum(r.revenue for r in leaves)


def test_taker_border_equals_join_and_distinct(taker, dim):
    may = dim.where(F.col("event_date") == MAY)
    joined = taker.where("offer_id IS NOT NULL").join(may, "msisdn", "left")
    for level in ("kabupaten", "region_sales"):
        plain = joined.groupBy("offer_id", level).agg(
            F.countDistinct("msisdn").alias("n"), F.sum("trx").alias("t"), F.sum("revenue").alias("r")
        )
        ours = T.taker_by_attribute(taker, dim, level, dim_date=MAY)
        assert rows(ours, "offer_id", level, "total_msisdn", "trx", "revenue") == rows(
            plain, "offer_id", level, "n", "t", "r"
        )


def test_length_of_stay_as_a_level_of_the_same_pass(wl, dim):
    one = W.wl_border(wl, dim, dim_date=MAY, levels=("area_sales", "los"))
    alone = W.wl_los(wl, dim, dim_date=MAY)
    assert rows(
        one.where("level = 'los'"), "offer_id", "border", "total_msisdn", "msisdn_delivered"
    ) == rows(alone, "offer_id", "los", "total_msisdn", "msisdn_delivered")


def test_month_reaches_the_scan(spark, wl):
    """A stored fact is read for the month and the needed columns only."""
    path = scratch_path(spark, "wl")
    replace_partitions(wl, path, ["strmonth"])
    plan = W.wl_by_offer(spark.read.parquet(path), MAY)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "(strmonth" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "start_date" not in text.split("ReadSchema: ")[1].split("\n")[0]
