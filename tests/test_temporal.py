"""Joins by time, sketches and changes on hand-made rows and by their laws."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta

import pytest

from uptake.operators.changes import apply_changes, snapshot_changes
from uptake.operators.reach import merge_sketches, reach_estimate, reach_sketch
from uptake.operators.temporal import (
    as_of_join,
    day_sessions,
    days_since_last,
    interval_join,
    rolling_reach,
)

DAY = date(2024, 1, 1)


def day(n):
    return None if n is None else DAY + timedelta(n)


def random_days(rng, n, keys):
    return [(rng.choice(keys), day(rng.choice([None, *range(0, 400)])), i) for i in range(n)]


@pytest.mark.parametrize("chunk_days", [1, 7, 1000])
def test_as_of_join_equals_the_definition(spark, chunk_days):
    rng = random.Random(chunk_days)
    keys = ["a", "a", "a", "b", None]
    left, right = random_days(rng, 200, keys), random_days(rng, 150, keys)
    right += [("a", day(40), -1), ("a", day(40), -2), ("c", day(0), 0)]
    left += [("a", day(40), 900), ("a", day(40), 900), ("z", day(9), 901)]
    ours = spark.createDataFrame(left, "k string, day date, id int")
    theirs = spark.createDataFrame(right, "k string, on date, v int")
    got = as_of_join(ours, theirs, ["k"], "day", "on", ["v"], chunk_days=chunk_days)
    want = []
    for k, d, i in left:
        before = [(on, v) for key, on, v in right if key == k is not None and d and on and on <= d]
        want.append((k, d, i, max(before)[1] if before else None))
    assert got.columns == ["k", "day", "id", "v"]
    assert Counter(tuple(r) for r in got.collect()) == Counter(want)


def test_as_of_join_without_rows(spark):
    ours = spark.createDataFrame([("a", DAY, 1)], "k string, day date, id int")
    theirs = spark.createDataFrame([("a", DAY, 1)], "k string, on date, v int")
    join = lambda a, b: as_of_join(a, b, ["k"], "day", "on", ["v"]).collect()
    assert [tuple(r) for r in join(ours, theirs.limit(0))] == [("a", DAY, 1, None)]
    assert join(ours.limit(0), theirs) == []


def test_a_hot_key_is_several_tasks(spark):
    ours = spark.range(1000).selectExpr("1 AS k", "date_add('2024-01-01', CAST(id AS int)) AS day")
    theirs = ours.selectExpr("k", "day AS on", "day AS v")
    plan = as_of_join(ours, theirs, ["k"], "day", "on", ["v"])._jdf.queryExecution().toString()
    windows = [line for line in plan.split("\n") if "+- Window" in line or ": Window" in line]
    assert any("_chunk" in line for line in windows)


def test_interval_join_equals_the_definition(spark):
    rng = random.Random(3)
    points = random_days(rng, 200, ["a", "a", "b", None])
    ranges = []
    for i in range(120):
        start = rng.choice([None, *range(0, 400)])
        size = rng.choice([0, 0, 1, 2, 3, 30, 31, 32, 33, 300, 36_500, -1])
        ranges.append((rng.choice(["a", "b", None]), day(start), None if start is None else day(start + size), i))
    got = interval_join(
        spark.createDataFrame(points, "k string, day date, id int"),
        spark.createDataFrame(ranges, "k string, first date, last date, range int"),
        ["k"], "day", "first", "last",
    )
    want = Counter(
        (k, d, i, a, b, r)
        for k, d, i in points
        for key, a, b, r in ranges
        if k == key is not None and d and a and b and a <= d <= b
    )
    assert Counter(tuple(r) for r in got.collect()) == want and want


def test_long_ranges_do_not_multiply_rows(spark):
    ranges = spark.createDataFrame([("a", DAY, day(2_900_000))], "k string, first date, last date")
    points = spark.createDataFrame([("a", day(5))], "k string, day date")
    joined = interval_join(points, ranges, ["k"], "day", "first", "last")
    assert joined.count() == 1
    assert interval_join(points, ranges.limit(0), ["k"], "day", "first", "last").count() == 0


@pytest.mark.parametrize("n", [0, 1, 50, 3_000, 9_000, 200_000])
def test_reach_is_near_the_exact_count(spark, n):
    df = spark.range(n).selectExpr("id % 7 AS g", "id * 31 AS m").unionByName(
        spark.range(min(n, 100)).selectExpr("id % 7 AS g", "id * 31 AS m")
    )
    df = df.unionByName(spark.range(3).selectExpr("id AS g", "CAST(NULL AS long) AS m"))
    parts = reach_sketch(df, ["g"], "m")
    merged = merge_sketches(parts, [])
    one = reach_sketch(df, [], "m")
    assert Counter(map(tuple, merged.collect())) == Counter(map(tuple, one.collect()))
    reach = reach_estimate(merged, []).first()["reach"]
    assert abs(reach - n) <= max(1, 0.05 * n)


def test_changes_count_copies_and_give_the_new_snapshot(spark):
    schema = "k int, v string"
    old = [(1, "a"), (1, "a"), (2, "b"), (3, None), (4, "same"), (None, "x"), (5, "gone")]
    new = [(1, "a"), (2, "c"), (3, "d"), (3, None), (4, "same"), (None, "y"), (6, "n"), (6, "n")]
    a, b = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    changes = snapshot_changes(a, b, ["k"])
    assert {tuple(r) for r in changes.collect()} == {
        (1, "a", "removed", 1, False), (2, "b", "removed", 1, True), (2, "c", "added", 1, True),
        (3, "d", "added", 1, False), (None, "x", "removed", 1, True), (None, "y", "added", 1, True),
        (5, "gone", "removed", 1, False), (6, "n", "added", 2, False),
    }
    assert Counter(map(tuple, apply_changes(a, changes).collect())) == Counter(new)
    assert snapshot_changes(a, a, ["k"]).count() == snapshot_changes(a.limit(0), a.limit(0), ["k"]).count() == 0


def test_sessions_end_at_the_gap(spark):
    days = [0, 0, 6, 13, 21, 28, 36, None]
    rows = [("a", day(n)) for n in days] + [(None, day(1)), (None, day(2)), ("b", day(5))]
    got = day_sessions(spark.createDataFrame(rows, "k string, d date"), ["k"], "d", 7)
    assert {tuple(r) for r in got.collect()} == {
        ("a", day(0), day(13), 3, 4), ("a", day(21), day(28), 2, 2), ("a", day(36), day(36), 1, 1),
        (None, day(1), day(2), 2, 2), ("b", day(5), day(5), 1, 1),
    }
    assert day_sessions(got.selectExpr("k", "first_day AS d").limit(0), ["k"], "d", 7).count() == 0


@pytest.mark.parametrize("days", [1, 7, 500])
def test_rolling_reach_equals_the_definition(spark, days):
    rng = random.Random(days)
    rows = [(rng.choice(["a", "b", None]), day(rng.choice([None, *range(60)])), rng.choice(["m", "m", "n", "o", None]))
            for _ in range(300)]
    got = rolling_reach(spark.createDataFrame(rows, "k string, d date, m string"), ["k"], "d", "m", days)
    want = set()
    for k, d in {(k, d) for k, d, _ in rows if d}:
        frame = [m for key, at, m in rows if key == k and at and d - timedelta(days) < at <= d]
        want.add((k, d, len({m for m in frame if m is not None}), len(frame)))
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert rolling_reach(got.selectExpr("k", "d", "reach AS m").limit(0), ["k"], "d", "m", days).count() == 0


def test_frames_of_a_hot_key_hold_no_members(spark):
    df = spark.range(10_000).selectExpr("1 AS k", "date_add('2024-01-01', CAST(id % 30 AS int)) AS d", "id AS m")
    reach = rolling_reach(df, ["k"], "d", "m", 7)
    windows = [line for line in reach._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window [" in line]
    assert any("_member" in line for line in windows) and len(windows) == 2
    assert {r["d"].day: r["reach"] for r in reach.collect()}[30] == sum(10_000 // 30 + (i < 10_000 % 30) for i in range(23, 30))


def test_days_since_last(spark):
    rows = [("a", day(n)) for n in (5, 0, 5, 12, None)] + [(None, day(1)), (None, day(4)), ("b", day(2))]
    got = days_since_last(spark.createDataFrame(rows, "k string, d date"), ["k"], "d")
    assert {tuple(r) for r in got.collect()} == {
        ("a", day(0), 1, None), ("a", day(5), 2, 5), ("a", day(12), 1, 7),
        (None, day(1), 1, None), (None, day(4), 1, 3), ("b", day(2), 1, None),
    }
    assert days_since_last(got.select("k", "d").limit(0), ["k"], "d").count() == 0
