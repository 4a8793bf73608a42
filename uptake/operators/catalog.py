"""Queries on the application catalogue and the application portfolio."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uptake.functions.constants import (
    DECLINED,
    LIVE,
    ON_REVIEW,
    TAG_KINDS,
    TAG_RENAMES,
    TOP_10_CONTEXT,
)
from uptake.sources.schemas import APPLICATION_PORTFOLIO, CATALOGUE_ADDED_COLUMNS

APP_COLUMNS = [
    "id",
    "vendor_name",
    "asset_name",
    "description",
    "tag_category",
    "tag_function_application",
    "tag_db_system",
]
# Cells of a matrix that one slot makes.
SLOT_CELLS = 1_000_000

# By vendor and asset; the id breaks ties, so that equal names do not end up in one task.
APP_ORDER = ["vendor_name", "asset_name", "id"]


def _time(now: datetime | None, dtype: T.DataType) -> Column:
    """A wall-clock time, or the current one, as the type of the column it meets."""
    clock = F.current_timestamp() if now is None else F.lit(now.isoformat(sep=" "))
    return clock.cast(dtype)


def _matches(keyword: str | None) -> Column:
    """Vendor or asset name contains the keyword, in any case. ``%`` and ``_`` are wildcards."""
    if keyword is None:
        return F.lit(True)
    pattern = f"%{keyword}%"
    return F.col("vendor_name").ilike(pattern) | F.col("asset_name").ilike(pattern)


def _with_tag_ids(
    apps: DataFrame, tags: DataFrame, kind: str, tag_ids: Sequence[int] | None
) -> DataFrame:
    """Apps with the id of their tag of this kind; if tags of it are selected, apps with one.

    One join gives the ids and whether one of them is selected.
    """
    column, other_id, _ = TAG_KINDS[kind]
    own = tags.where(F.col("tag") == kind)
    selection = tag_ids is not None
    chosen = F.max("chosen") if selection else F.lit(True)
    names = own.groupBy(F.col("name").alias(column)).agg(
        F.collect_set("id").alias("_ids"), chosen.alias("_chosen")
    )
    apps = apps.join(names, column, "left")
    if selection:
        untagged = F.lit(other_id in tag_ids) & F.col(column).isNull()
        any_chosen = own.where("chosen").exists()
        apps = apps.where(~any_chosen | untagged | F.coalesce("_chosen", F.lit(False)))
    return apps.withColumn(f"{column}_id", F.explode_outer("_ids")).drop("_ids", "_chosen")


def catalog_search(
    catalog: DataFrame,
    tags: DataFrame,
    keyword: str | None = None,
    tag_ids: Sequence[int] | None = None,
    live_only: bool = True,
) -> DataFrame:
    """Applications that match a keyword and a selection of tags, with the ids of their tags.

    Tags of one kind are alternatives, the kinds must all match, and a kind without selected
    tags is ignored. The ids of the "Other" tags also match applications without a tag.
    """
    wanted = (F.col("is_deleted") == F.lit(False)) & _matches(keyword)
    if live_only:
        wanted = wanted & (F.col("status") == LIVE)
    apps = catalog.where(wanted)
    if tag_ids is not None:
        tags = tags.withColumn("chosen", F.col("id").isin(*tag_ids))
    for kind in TAG_KINDS:
        apps = _with_tag_ids(apps, tags, kind, tag_ids)
    shown = [*APP_COLUMNS, *[f"{column}_id" for column, _, _ in TAG_KINDS.values()]]
    shown += ["is_deleted", "deleted_at"]
    if live_only:
        shown += ["status", "decline_time"]
    return apps.select(*shown).distinct().orderBy(*APP_ORDER)


def catalog_review(
    catalog: DataFrame, keyword: str | None = None, now: datetime | None = None
) -> DataFrame:
    """Applications on review, and those declined within the last 24 hours."""
    now_column = _time(now, catalog.schema["decline_time"].dataType)
    pending = F.col("status").isNull() | (F.col("status") == ON_REVIEW)
    fresh = (F.col("status") == DECLINED) & (
        F.col("decline_time") >= now_column - F.expr("INTERVAL 24 HOURS")
    )
    return (
        catalog.where((F.col("is_deleted") == F.lit(False)) & (pending | fresh) & _matches(keyword))
        .select(
            *APP_COLUMNS,
            "is_deleted",
            "deleted_at",
            F.coalesce("status", F.lit(ON_REVIEW)).alias("status"),
            "decline_time",
        )
        .distinct()
        .orderBy(*APP_ORDER)
    )


def _tag_columns() -> list[Column]:
    return [F.col(column) for column, _, _ in TAG_KINDS.values()]


def _apps_per_name(catalog: DataFrame) -> DataFrame:
    """Applications per tag name of any kind. An app that repeats a name counts once."""
    names = F.array_compact(F.array_distinct(F.array(*_tag_columns())))
    return (
        catalog.select(F.explode(names).alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    )


def _apps_per_tag(counts: DataFrame, tags: DataFrame) -> DataFrame:
    return (
        counts.join(tags.where(F.col("tag").isNotNull()), "name")
        .groupBy("id", "tag", "name")
        .agg(F.sum("n").alias("count"))
    )


def tag_counts(catalog: DataFrame, tags: DataFrame) -> DataFrame:
    """Applications per tag, most used first.

    A tag matches an application if any of its tag columns has the tag's name. Names are
    unfolded and counted before an equality join with the tags, instead of one join with
    three alternatives that compares all pairs.
    """
    return _apps_per_tag(_apps_per_name(catalog), tags).orderBy(F.desc("count"), "id")


def tag_counts_with_other(catalog: DataFrame, tags: DataFrame) -> DataFrame:
    """``tag_counts`` and the number of applications without a tag, per kind.

    The extra row of a kind is absent if all applications have such a tag.
    """
    missing = catalog.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(other_id).alias("id"),
                        F.lit(kind).alias("tag"),
                        F.lit(other_name).alias("name"),
                        F.col(column).isNull().alias("is_missing"),
                    )
                    for kind, (column, other_id, other_name) in TAG_KINDS.items()
                ]
            )
        )
    ).where("is_missing")
    others = missing.groupBy("id", "tag", "name").agg(F.count("*").alias("count"))
    tagged = _apps_per_tag(_apps_per_name(catalog), tags)
    return tagged.unionByName(others).orderBy(F.desc("count"), "id")


def tag_group_total(catalog: DataFrame, tags: DataFrame) -> DataFrame:
    """Number of rows of ``tag_counts_with_other``."""
    return tag_counts_with_other(catalog, tags).agg(F.count("count").alias("total"))


def app_details(catalog: DataFrame, app_id: int) -> DataFrame:
    """One application, its tags as an array without nulls."""
    return catalog.where(F.col("id") == app_id).select(
        "id",
        "asset_name",
        "vendor_name",
        "apps_owner_pic",
        "owner_phone_number",
        "tsa",
        F.coalesce("status", F.lit(ON_REVIEW)).alias("status"),
        "version",
        "description",
        "principle",
        "is_deleted",
        "deleted_at",
        "decline_time",
        F.array_compact(F.array("tag_db_system", "tag_function_application", "tag_category")).alias(
            "tags"
        ),
    )


def tag_list(tags: DataFrame, kind: str) -> DataFrame:
    """Tags of one kind."""
    return tags.where(F.col("tag") == kind).select("id", "tag", "name")


def normalize_tags(
    catalog: DataFrame, renames: Mapping[str, Mapping[str, str]] = TAG_RENAMES
) -> DataFrame:
    """Unify tag spellings and give applications without a tag the "Other" one."""
    for column, _, other_name in TAG_KINDS.values():
        if column in renames:
            catalog = catalog.replace(dict(renames[column]), subset=[column])
        catalog = catalog.withColumn(column, F.coalesce(column, F.lit(other_name)))
    return catalog


def soft_delete(table: DataFrame, row_id: int, now: datetime | None = None) -> DataFrame:
    """Mark one row as deleted."""
    hit = F.col("id") == row_id
    deleted_at = _time(now, table.schema["deleted_at"].dataType)
    return table.withColumns(
        {
            "is_deleted": F.when(hit, F.lit(True)).otherwise(F.col("is_deleted")),
            "deleted_at": F.when(hit, deleted_at).otherwise(F.col("deleted_at")),
        }
    )


def install_type_summary(portfolio: DataFrame) -> DataFrame:
    return portfolio.groupBy("install_type").agg(F.count("*").alias("total_apps"))


def category_summary(portfolio: DataFrame, column: str) -> DataFrame:
    """Applications per category and value of another column."""
    return portfolio.groupBy("category", column).agg(F.count("*").alias("total_apps"))


def create_summary_views(portfolio: DataFrame) -> None:
    """The three summaries as temporary views for SQL users."""
    install_type_summary(portfolio).createOrReplaceTempView("install_type_summary")
    for name, column in (
        ("category_manufacturer_summary", "manufacturer"),
        ("category_version_status_summary", "version_age_status"),
    ):
        category_summary(portfolio, column).createOrReplaceTempView(name)


def category_matrix(portfolio: DataFrame, column: str) -> DataFrame:
    """Applications for each category and each known value of a column, 0 where there are none.

    The result is dense by definition, a cross product of the categories and the values. Its
    cells are made in parallel: the values are dealt into slots, as many as the number of cells
    asks for, and every category is joined to the values slot by slot. Applications are counted
    first; categories, values and non-empty cells all come from the counts.
    """
    counts = portfolio.groupBy("category", column).agg(F.count("*").alias("count"))
    values = counts.where(F.col(column).isNotNull()).select(column).distinct()
    categories = counts.select("category").distinct()
    sizes = (df.agg(F.count(F.lit(1))).scalar() for df in (categories, values))
    slots = F.ceil(next(sizes) * next(sizes) / F.lit(float(SLOT_CELLS)))
    slots = F.greatest(slots, F.lit(1)).cast("long")
    values = values.withColumn("slot", F.pmod(F.xxhash64(column), slots))
    categories = categories.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), slots - 1)))
    return (
        categories.join(values, "slot")
        .join(counts, ["category", column], "left")
        .select("category", column, F.coalesce("count", F.lit(0)).alias("count"))
        .orderBy("category", column)
    )


def distinct_manufacturers(portfolio: DataFrame) -> DataFrame:
    """Manufacturers of the category matrix."""
    return portfolio.where(F.col("manufacturer").isNotNull()).select("manufacturer").distinct()


def _known_column(df: DataFrame, column: str) -> Column:
    if column not in df.columns:
        raise ValueError(f"no column {column!r}; choose one of {df.columns}")
    return F.col(column)


def top10_active_users(portfolio: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The values of any column with the most active users."""
    return (
        portfolio.groupBy(_known_column(portfolio, column).cast("string").alias("value"))
        .agg(F.sum("total_active_users").alias("total_active_users"))
        .orderBy(F.desc("total_active_users"), "value")
        .limit(n)
    )


def apps_count_by(portfolio: DataFrame, column: str) -> DataFrame:
    """Applications per value of any column, most first."""
    return (
        portfolio.groupBy(_known_column(portfolio, column).cast("string").alias("value"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "value")
    )


def filters_by_context(filters: DataFrame, context: str) -> DataFrame:
    """Filters offered in one place of the user interface."""
    return (
        filters.where(F.col("context") == context)
        .select("name", "display_name")
        .orderBy("display_name", "name")
    )


def top10_filters(filters: DataFrame) -> DataFrame:
    """Columns the top-10 report can be grouped by."""
    return filters_by_context(filters, TOP_10_CONTEXT)


def portfolio_listing(portfolio: DataFrame) -> DataFrame:
    """The applications with their attributes."""
    return portfolio.select(*APPLICATION_PORTFOLIO.fieldNames())


def usage_listing(portfolio: DataFrame, usage: DataFrame) -> DataFrame:
    """Monthly active users with the name of the application."""
    names = portfolio.select(
        F.col("id").alias("application_portfolio_id"), "application_name"
    )
    return usage.join(names, "application_portfolio_id").select(
        "id", "application_portfolio_id", "application_name", "active_user_count", "date"
    )


def request_store_relation(
    requests: DataFrame, relation: DataFrame, stores: DataFrame
) -> DataFrame:
    """Data stores each application request uses, one row per pair."""
    return (
        relation.select("application_request_id", "data_management_store_id")
        .join(
            requests.select(F.col("id").alias("application_request_id"), "asset_name"),
            "application_request_id",
        )
        .join(
            stores.select(
                F.col("id").alias("data_management_store_id"), F.col("name").alias("store_name")
            ),
            "data_management_store_id",
        )
        .select("application_request_id", "asset_name", "data_management_store_id", "store_name")
    )


def schema_evolve(
    table: DataFrame, columns: Mapping[str, tuple[str, object]] = CATALOGUE_ADDED_COLUMNS
) -> DataFrame:
    """Add columns that are not there yet, with their default."""
    return table.withColumns(
        {
            name: F.lit(default).cast(dtype)
            for name, (dtype, default) in columns.items()
            if name not in table.columns
        }
    )


def fk_violations(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows that refer to a parent that does not exist. A null refers to nothing."""
    keys = parent.select(F.col(key).alias(foreign_key))
    return child.where(F.col(foreign_key).isNotNull()).join(keys, foreign_key, "left_anti")


def fk_check(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Number of rows that violate the foreign key."""
    return fk_violations(child, foreign_key, parent, key).agg(F.count("*").alias("violations"))
