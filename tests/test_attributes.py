"""Attributes on rows that are no objects, with repeated keys and with odd values."""

from __future__ import annotations

from uptake.operators.attributes import attribute_counts, having_attribute

ROWS = [
    (1, '{"os": "linux", "tier": "1"}'), (2, '{"os": "linux"}'), (3, '{"os": null}'), (4, "{}"),
    (5, None), (6, ""), (7, "linux"), (8, '{"os": "li'), (9, '{"os": "linux", "os": "linux"}'),
    (10, '{"tier": 1, "of": {"a": [1, 2]}}'),
]


def test_counts(spark):
    apps = spark.createDataFrame(ROWS, "id int, key string")
    got = {(r["key"], r["value"]): r["apps"] for r in attribute_counts(apps, "key").collect()}
    assert got == {
        ("os", "linux"): 3, ("os", None): 1, ("tier", "1"): 2, ("of", '{"a":[1,2]}'): 1, (None, None): 4,
    }


def test_rows_with_an_attribute(spark):
    apps = spark.createDataFrame(ROWS, "id int, text string")
    assert sorted(r["id"] for r in having_attribute(apps, "text", "os", "linux").collect()) == [1, 2, 9]
    assert having_attribute(apps.limit(0), "text", "os", "linux").count() == 0
