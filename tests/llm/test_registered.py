"""The registered queries that have SQL, against it."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_point
from tests.compare import connect, difference
from uptake.llm.oracles import ORACLES
from uptake.llm.queries import QUERIES


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None


def test_one_query_per_operator_and_the_pipeline():
    names = entry_point.queries()
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert "pipeline" in names and QUERIES.items() <= names.items()
