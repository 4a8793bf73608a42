"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations""".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of_query(df):
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(r[c]) for c in names) for r in df.collect())


def rows_of_sql(con, sql):
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    names = sorted(columns)
    order = [columns.index(c) for c in names]
    return names, Counter(tuple(_plain(r[i]) for i in order) for r in result.fetchall())


def difference(df, con, sql) -> str | None:
    """What differs, or None. Values must be equal, doubles to the last bit."""
    names, ours = rows_of_query(df)
    sql_names, theirs = rows_of_sql(con, sql)
    if names != sql_names:
        return f"columns {names} / {sql_names}"
    if ours != theirs:
        only_ours, only_theirs = list((ours - theirs))[:3], list((theirs - ours))[:3]
        return (
            f"{sum(ours.values())} / {sum(theirs.values())} rows, "
            f"{sum((ours - theirs).values())} differ\n  {names}\n  {only_ours}\n  {only_theirs}"
        )
    return None
