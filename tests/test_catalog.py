from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from uptake.operators import catalog as C
from uptake.sources.schemas import (
    APPLICATION_PORTFOLIO,
    CATALOGUE_ADDED_COLUMNS,
    FILTER_REFERENCE,
    TAGS_REFERENCE,
)

NOW = datetime(2026, 5, 20, 12)
APP = """id int, vendor_name string, asset_name string, description string, tag_category string,
tag_function_application string, tag_db_system string, status string, is_deleted boolean,
deleted_at timestamp, decline_time timestamp, apps_owner_pic string, owner_phone_number string,
tsa string, version string, principle string"""


def ids(df):
    return [r.id for r in df.collect()]


@pytest.fixture(scope="module")
def apps(spark):
    def app(i, vendor, asset, tags, status="Live", deleted=False, declined=None):
        return (i, vendor, asset, "d", *tags, status, deleted, None, declined, *[None] * 5)

    return spark.createDataFrame(
        [
            app(1, "Blue", "Ledger", ("Data", "Chat", "Pg")),
            app(2, "Blue", "Atlas", ("Data", None, None)),
            app(3, "acme", "Portal", (None, "Chat", "My")),
            app(4, "Zed", "bluebird", ("Report", "Plan", None)),
            app(5, "Zed", "Gone", ("Data", "Chat", "Pg"), deleted=True),
            app(6, "Zed", "New", ("Data", "Chat", "Pg"), None),
            app(7, "Zed", "Open", (None, None, None), "On Review"),
            app(8, "Zed", "Fresh", (None, None, None), "Declined", False, NOW - timedelta(hours=24)),
            app(9, "Zed", "Stale", ("Chat", "Chat", None), "Declined", False, NOW - timedelta(hours=25)),
        ],
        APP,
    )


@pytest.fixture(scope="module")
def tags(spark):
    return spark.createDataFrame(
        [
            (1, "category", "Data"), (2, "category", "Report"), (3, "function", "Chat"),
            (4, "function", "Plan"), (5, "db_system", "Pg"), (6, "db_system", "My"),
            (7, "category", "Data"), (997, "category", "Other Category"),
            (998, "function", "Other Function"), (999, "db_system", "Other DB System"),
        ],
        TAGS_REFERENCE,
    )


@pytest.mark.parametrize(
    ("keyword", "tag_ids", "found"),
    [
        (None, None, {1, 2, 3, 4}),
        ("BLUE", None, {1, 2, 4}),
        ("b%d", None, {4}),
        (None, [], {1, 2, 3, 4}),
        (None, [1], {1, 2}),
        (None, [1, 2], {1, 2, 4}),
        (None, [1, 3], {1}),
        (None, [1, 3, 998], {1, 2}),
        (None, [997], {3}),
        (None, [997, 2, 999], {4}),
        (None, [12345], {1, 2, 3, 4}),
        ("blue", [2, 5], set()),
    ],
)
def test_search(apps, tags, keyword, tag_ids, found):
    assert set(ids(C.catalog_search(apps, tags, keyword, tag_ids))) == found


def test_search_order_and_tag_ids(apps, tags):
    rows = C.catalog_search(apps, tags, tag_ids=[1]).collect()
    # The category name has two ids, each gives a row.
    assert [(r.id, r.tag_category_id, r.tag_function_application_id) for r in rows] in (
        [(2, 1, None), (2, 7, None), (1, 1, 3), (1, 7, 3)],
        [(2, 7, None), (2, 1, None), (1, 7, 3), (1, 1, 3)],
        [(2, 1, None), (2, 7, None), (1, 7, 3), (1, 1, 3)],
        [(2, 7, None), (2, 1, None), (1, 1, 3), (1, 7, 3)],
    )


def test_search_of_all_states(apps, tags):
    assert set(ids(C.catalog_search(apps, tags, live_only=False))) == {1, 2, 3, 4, 6, 7, 8, 9}


def test_review(apps):
    rows = C.catalog_review(apps, now=NOW).collect()
    assert {(r.id, r.status) for r in rows} == {(6, "On Review"), (7, "On Review"), (8, "Declined")}
    assert ids(C.catalog_review(apps, "new", NOW)) == [6]


def test_tag_counts(apps, tags):
    counts = {(r.id, r["count"]) for r in C.tag_counts(apps, tags).collect()}
    # App 9 has 'Chat' twice and counts once.
    assert counts == {(1, 4), (7, 4), (2, 1), (3, 5), (4, 1), (5, 3), (6, 1)}
    more = {(r.id, r["count"]) for r in C.tag_counts_with_other(apps, tags).collect()}
    assert more == counts | {(997, 3), (998, 3), (999, 5)}
    assert C.tag_group_total(apps, tags).first().total == len(more)


def test_other_bucket_is_absent_without_nulls(apps, tags):
    counts = C.tag_counts_with_other(apps.where("id = 1"), tags)
    assert not {997, 998, 999} & set(ids(counts))


def test_details(apps):
    row = C.app_details(apps, 6).first()
    assert (row.status, row.tags) == ("On Review", ["Pg", "Chat", "Data"])
    assert C.app_details(apps, 2).first().tags == ["Data"]
    assert C.app_details(apps, 7).first().tags == []


def test_normalize(apps, spark):
    renames = {"tag_category": {"Report": "Reporting"}}
    rows = {r.id: r for r in C.normalize_tags(apps, renames).collect()}
    assert rows[4].tag_category == "Reporting"
    assert (rows[7].tag_category, rows[7].tag_db_system) == ("Other Category", "Other DB System")
    default = spark.createDataFrame(
        [("Reporting, Analytic, ML & Visualization", "x", "Database - Maria DB")],
        "tag_category string, tag_function_application string, tag_db_system string",
    )
    assert tuple(C.normalize_tags(default).first()) == (
        "Reporting, Analytic, ML and Visualization", "x", "Database - MariaDB",
    )


def test_soft_delete(apps):
    rows = {r.id: r for r in C.soft_delete(apps, 2, NOW).collect()}
    assert rows[2].is_deleted and rows[2].deleted_at == NOW
    assert [i for i, r in rows.items() if r.is_deleted] == [2, 5]


@pytest.fixture(scope="module")
def portfolio(spark):
    def app(i, name, category, users, version, maker):
        return (i, name, category, "Cloud", "App", None, None, users, version, maker)

    return spark.createDataFrame(
        [
            app(1, "a", "Finance", 10, "Current", "X"), app(2, "b", "Finance", 5, None, "X"),
            app(3, "c", "HR", 7, "Old", None), app(4, "d", "HR", 7, "Old", "Y"),
            app(5, "e", "IT", 1, "Current", None),
        ],
        APPLICATION_PORTFOLIO,
    )


def test_matrix_is_dense(portfolio):
    cells = [tuple(r) for r in C.category_matrix(portfolio, "manufacturer").collect()]
    assert cells == [
        ("Finance", "X", 2), ("Finance", "Y", 0), ("HR", "X", 0), ("HR", "Y", 1),
        ("IT", "X", 0), ("IT", "Y", 0),
    ]


def test_summary_views(spark, portfolio):
    C.create_summary_views(portfolio)
    assert spark.table("install_type_summary").first().total_apps == 5
    rows = spark.sql("SELECT total_apps FROM category_manufacturer_summary WHERE category = 'Finance'")
    assert [r.total_apps for r in rows.collect()] == [2]
    assert spark.table("category_version_status_summary").count() == 4


def test_top_and_counts(portfolio):
    top = [tuple(r) for r in C.top10_active_users(portfolio, "category").collect()]
    assert top == [("Finance", 15), ("HR", 14), ("IT", 1)]
    assert [r.value for r in C.top10_active_users(portfolio, "application_name", 2).collect()] == ["a", "c"]
    counts = [tuple(r) for r in C.apps_count_by(portfolio, "manufacturer").collect()]
    assert counts == [(None, 2), ("X", 2), ("Y", 1)]
    with pytest.raises(ValueError):
        C.apps_count_by(portfolio, "name; DROP TABLE x")


def test_filters(spark):
    filters = spark.createDataFrame(
        [
            (1, "b", "Second", "FILTER_TOP_10_BY_TOTAL_USER"),
            (2, "a", "First", "FILTER_TOP_10_BY_TOTAL_USER"),
            (3, "c", "x", "y"),
        ],
        FILTER_REFERENCE,
    )
    assert [r.name for r in C.top10_filters(filters).collect()] == ["a", "b"]
    assert [r.name for r in C.filters_by_context(filters, "y").collect()] == ["c"]


def test_schema_evolve_keeps_existing_columns(apps):
    evolved = C.schema_evolve(C.schema_evolve(apps))
    assert set(CATALOGUE_ADDED_COLUMNS) <= set(evolved.columns)
    assert evolved.where("is_public_facing").isEmpty()
    assert evolved.where("decline_time IS NOT NULL").count() == 2


def test_fk_check(spark, portfolio):
    usage = spark.createDataFrame([(1, 1), (2, 99), (3, None)], "id int, application_portfolio_id int")
    assert C.fk_check(usage, "application_portfolio_id", portfolio, "id").first().violations == 1
