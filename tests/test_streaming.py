"""Streams against the batch result: restarts in the middle, late rows, nulls, hot keys."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest

from uptake.streaming.periods import advance, first_touch, late_rows, so_far, utc_day, windowed

SCHEMA = "offer string, member string, day date, n long"
START = date(2024, 1, 1)


def day(n):
    return None if n is None else START + timedelta(n)


def parts(rng, spans, size=60):
    """Rows whose days lie in the spans, one list of rows each; one member has a third of them."""
    return [
        [(rng.choice(["a", "b", None]), rng.choice(["m", "n", "o", None, *"mm"]),
          day(rng.choice([None, *range(*span)])), rng.randrange(9)) for _ in range(size)]
        for span in spans
    ]


def run(spark, folder, arrivals, result_of):
    """Each list of rows arrives as files, then the stream is advanced."""
    files, path, checkpoint = (str(folder / n) for n in ("files", "closed", "state"))
    for rows in arrivals:
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(files)
        result = result_of(spark.readStream.schema(SCHEMA).parquet(files))
        advance(result, path, checkpoint)
    return so_far(spark, result, path, checkpoint)


def expected_windows(rows, size, slide):
    want = {}
    for offer, _, at, n in rows:
        if at is None:
            continue
        number = (at - date(1970, 1, 1)).days
        first = number - number % slide
        while first > number - size:
            count, total = want.get((first, offer), (0, 0))
            want[first, offer] = count + 1, total + n
            first -= slide
    return {(date(1970, 1, 1) + timedelta(f), o, *v) for (f, o), v in want.items()}


def window_rows(groups):
    first = utc_day(groups["period.start"]).alias("first")
    return {tuple(r) for r in groups.select(first, "offer", "rows", "n").collect()}


@pytest.mark.parametrize("size, slide", [(7, None), (14, 7), (10, 3)])
def test_windows_over_several_runs_equal_the_batch(spark, tmp_path, size, slide):
    arrivals = parts(random.Random(size), [(0, 40), (35, 80), (75, 120)])
    groups = run(spark, tmp_path, arrivals, lambda s: windowed(s, "day", ["offer"], size, slide, 6, ["n"]))
    rows = [r for part in arrivals for r in part]
    assert window_rows(groups) == expected_windows(rows, size, slide or size)
    assert {r["closed"] for r in groups.collect()} == {True, False}
    if slide != 3:
        dated = sum(r[2] is not None for r in rows)
        assert late_rows(dated, groups, size // (slide or size)) == 0


def test_late_rows_are_counted(spark, tmp_path):
    on_time, late = [("a", "m", day(n), 1) for n in range(0, 60)], [("a", "m", day(3), 1)] * 5
    groups = run(spark, tmp_path, [on_time, late], lambda s: windowed(s, "day", ["offer"], 7, None, 10, ["n"]))
    assert window_rows(groups) == expected_windows(on_time, 7, 7)
    assert late_rows(65, groups) == 5


def test_first_touch_is_kept_over_a_restart(spark, tmp_path):
    arrivals = parts(random.Random(5), [(0, 20), (10, 50), (40, 75), (62, 130)])
    touches = lambda s: first_touch(s, "day", ["member"], "offer")
    got = run(spark, tmp_path / "four", arrivals, touches)
    once = run(spark, tmp_path / "one", [[r for part in arrivals for r in part]], touches)
    rows = lambda df: Counter(map(str, df.drop("closed").collect()))
    assert rows(got) == rows(once)
    want = {}
    for offer, member, at, _ in (r for part in arrivals for r in part):
        if at:
            key = (at.year, at.month, member)
            want[key] = min(want.get(key, (date.max, True, "")), (at, offer is not None, offer or ""))
    found = got.select(utc_day(got["month_end"]).alias("end"), "member", "first").collect()
    assert {((r["end"]).year, r["end"].month, r["member"]): r["first"]["day"] for r in found} == {
        k: v[0] for k, v in want.items()
    }
    assert {r["first"]["offer"] or "" for r in found} <= {"a", "b", ""}
    assert {((r["end"]).year, r["end"].month, r["member"]): r["first"]["offer"] or "" for r in found} == {
        k: v[2] for k, v in want.items()
    }
    assert got.where("closed").count()


def test_streams_without_rows(spark, tmp_path):
    groups = run(spark, tmp_path, [[]], lambda s: windowed(s, "day", ["offer"], 7, None, 1, ["n"]))
    assert groups.collect() == [] and late_rows(0, groups) == 0


def test_days_do_not_depend_on_the_time_zone(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        groups = run(spark, tmp_path, [[("a", "m", day(0), 1)]], lambda s: windowed(s, "day", [], 1, None, 0, ["n"]))
        first = groups.select(utc_day(groups["period.start"]).alias("d")).collect()
        assert [r["d"] for r in first] == [START] and not isinstance(first[0]["d"], datetime)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
