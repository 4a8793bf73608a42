"""One registered query per operator, over all rows of the derived tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uptake.functions.constants import TOWERS
from uptake.functions.dates import with_run_dates
from uptake.operators import (
    attributes,
    border,
    catalog,
    changes,
    extract,
    ingest,
    load,
    reach,
    snapshots,
    summary,
    taker,
    temporal,
    top_level,
    tur,
    whitelist,
)
from uptake.plans import lens
from uptake.plans.extracts import extracts
from uptake.sources.files import read_csv, read_sheet, scratch_path, write_csv
from uptake.sources.schemas import EXTRACTS
from uptake.streaming import periods

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATE = date(2001, 9, 3)
DATA_DATE = date(2001, 9, 1)
NOW = datetime(2001, 8, 20, 12, 0, 0)
STREAM_SPLIT = date(1995, 1, 1)
TAG_IDS = [101, 103, 201, 202, 998, 301, 302, 999]

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register under the function's name; decimals become doubles in the result."""

    def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = run(spark, sf_dir)
        return df.select(
            *[
                F.col(f.name).cast("double").alias(f.name)
                if isinstance(f.dataType, T.DecimalType)
                else F.col(f.name)
                for f in df.schema.fields
            ]
        )

    QUERIES[run.__name__] = plain
    return run


# Extracts of the campaign table


@query
def campaign_summary_extract(spark, d):
    return extract.campaign_summary_extract(lens.campaigns(spark, d), RUN_DATE, all_months=True)


@query
def campaign_summary_clean(spark, d):
    return extract.campaign_summary_clean(lens.campaigns(spark, d))


@query
def campaign_month_listing(spark, d):
    return extract.campaign_month_listing(lens.campaigns(spark, d))


# Whitelist


@query
def wl_by_offer(spark, d):
    return whitelist.wl_by_offer(lens.whitelist(spark, d), extract_date=RUN_DATE)


@query
def wl_total_by_offer(spark, d):
    return whitelist.wl_total_by_offer(lens.whitelist(spark, d), RUN_DATE, DATA_DATE)


@query
def wl_border(spark, d):
    return whitelist.wl_border(
        lens.whitelist(spark, d), lens.subscribers(spark, d), extract_date=RUN_DATE
    )


@query
def wl_kabupaten(spark, d):
    return whitelist.wl_kabupaten(lens.whitelist(spark, d), lens.subscribers(spark, d))


@query
def wl_region(spark, d):
    return whitelist.wl_region(lens.whitelist(spark, d), lens.subscribers(spark, d))


@query
def wl_los(spark, d):
    return whitelist.wl_los(
        lens.whitelist(spark, d), lens.subscribers(spark, d), extract_date=RUN_DATE
    )


@query
def wl_recurring(spark, d):
    return whitelist.wl_recurring(lens.whitelist(spark, d), extract_date=RUN_DATE)


@query
def wl_recurring_kabupaten(spark, d):
    return whitelist.wl_recurring_kabupaten(
        lens.whitelist(spark, d), lens.subscribers(spark, d), extract_date=RUN_DATE
    )


@query
def wl_first_touch_attribution(spark, d):
    return whitelist.wl_first_touch_attribution(lens.whitelist(spark, d))


# Takers


@query
def taker_by_tower(spark, d):
    return taker.taker_by_tower(lens.taker(spark, d), extract_date=RUN_DATE)


@query
def taker_by_offer(spark, d):
    return taker.taker_by_offer(lens.taker(spark, d), extract_date=RUN_DATE)


@query
def taker_border(spark, d):
    return taker.taker_border(
        lens.taker(spark, d), lens.subscribers(spark, d), extract_date=RUN_DATE
    )


@query
def taker_kabupaten(spark, d):
    return taker.taker_kabupaten(lens.taker(spark, d), lens.subscribers(spark, d))


@query
def taker_region(spark, d):
    return taker.taker_region(lens.taker(spark, d), lens.subscribers(spark, d))


@query
def taker_los(spark, d):
    return taker.taker_los(
        lens.taker(spark, d), lens.subscribers(spark, d), extract_date=RUN_DATE
    )


# KPIs


def _kpi(operator, spark, d, **options):
    run = extracts(spark, d)
    return operator(run.summary, run.wl_offer, run.taker_offer, run.tur, **options)


@query
def tur_formulation(spark, d):
    run = extracts(spark, d)
    return tur.tur_formulation(run.summary, run.wl_offer, run.taker_offer)


@query
def summary_channel(spark, d):
    return _kpi(summary.summary_channel, spark, d)


@query
def summary_channel_mtd(spark, d):
    return _kpi(summary.summary_channel, spark, d, mtd=True)


@query
def summary_product(spark, d):
    return _kpi(summary.summary_product, spark, d)


@query
def summary_product_all(spark, d):
    return _kpi(summary.summary_product, spark, d, how="left")


@query
def summary_product_mtd(spark, d):
    return _kpi(summary.summary_product, spark, d, mtd=True)


def _kabupaten(spark, d, mtd):
    run = extracts(spark, d)
    return summary.summary_kabupaten(
        run.summary, run.wl_border, run.taker_border, run.tur, mtd=mtd
    )


@query
def summary_kabupaten(spark, d):
    return _kabupaten(spark, d, mtd=False)


@query
def summary_kabupaten_mtd(spark, d):
    return _kabupaten(spark, d, mtd=True)


@query
def top_main_level(spark, d):
    return _kpi(top_level.top_main_level, spark, d)


@query
def top_main_level_mtd(spark, d):
    return _kpi(top_level.top_main_level, spark, d, mtd=True)


@query
def top_main_level_l1(spark, d):
    return _kpi(top_level.top_main_level_l1, spark, d)


@query
def top_main_level_l1_mtd(spark, d):
    return _kpi(top_level.top_main_level_l1, spark, d, mtd=True)


@query
def border_taker(spark, d):
    run = extracts(spark, d)
    return border.border_taker(run.summary, run.taker_border)


@query
def border_taker_mtd(spark, d):
    run = extracts(spark, d)
    return border.border_taker(run.summary, run.taker_border, mtd=True)


@query
def border_wl(spark, d):
    run = extracts(spark, d)
    return border.border_wl(run.summary, run.wl_border)


@query
def border_wl_mtd(spark, d):
    run = extracts(spark, d)
    return border.border_wl(run.summary, run.wl_border, mtd=True)


@query
def border_wl_all_snapshots(spark, d):
    run = extracts(spark, d)
    return border.border_wl(run.summary, run.wl_border, all_snapshots=True)


# Snapshots and loads


@query
def run_dates(spark, d):
    orders = lens.table(spark, d, "orders")
    return with_run_dates(
        orders.select(F.col("o_orderdate").cast("date").alias("run_date")).distinct(), "run_date"
    )


@query
def latest_snapshot(spark, d):
    return snapshots.latest_snapshot(extracts(spark, d).summary).select(
        *lens.SNAPSHOT, "strmonth", "offer_id", "communication_channel"
    )


@query
def latest_snapshot_tolerant(spark, d):
    run = extracts(spark, d)
    return snapshots.latest_snapshot_tolerant(run.taker_offer, run.summary, late_days=2)


@query
def lagged_snapshot(spark, d):
    run = extracts(spark, d)
    return snapshots.lagged_snapshot(run.wl_offer, run.summary)


def _yearly_usage(spark, d):
    return lens.usage(spark, d).withColumn("year", F.year("date")).drop("id")


def _one_more(df):
    return df.withColumn("active_user_count", F.col("active_user_count") + 1)


MARCH, MAY = date(1997, 3, 1), date(1998, 5, 1)


@query
def replace_mtd(spark, d):
    """Replace a month's newest data day twice, and another month's by nothing."""
    path, run = scratch_path(spark, "kpi_mtd"), extracts(spark, d)
    rows = _kpi(top_level.top_main_level, spark, d, mtd=True)
    load.replace_partitions(rows, path, ["strmonth", "d_date"])
    for _ in range(2):
        load.replace_month_to_date(rows, path, MARCH)
    days = run.summary.where(F.col("strmonth") == F.lit(MAY)).agg(F.max("d_date"))
    load.replace_month_to_date(rows.where(F.lit(False)), path, MAY, days.first()[0])
    return spark.read.parquet(path)


@query
def sync_summary_channel(spark, d):
    """Upsert a month of a KPI table with null channels, first into no table, then over itself."""
    path = scratch_path(spark, "summary_channel")
    rows = _kpi(summary.summary_channel, spark, d)
    keys = ["tower", "wltype", "communication_channel"]
    for _ in range(2):
        load.sync_table(rows, "summary_channel", path, MARCH, "upsert", keys)
    return spark.read.parquet(path)


@query
def sync_top_main_level_mtd(spark, d):
    """Copy two data days of a KPI table, one of them twice."""
    path = scratch_path(spark, "top_main_level_mtd")
    rows = _kpi(top_level.top_main_level, spark, d, mtd=True)
    for day in (date(1997, 3, 31), date(1997, 4, 30), date(1997, 3, 31)):
        load.sync_table(rows, "top_main_level_mtd", path, day)
    return spark.read.parquet(path)


def _handed_over(spark, table, rows):
    """Write an extract as CSV and load it twice."""
    path, csv = scratch_path(spark, table), scratch_path(spark, f"{table}_csv")
    write_csv(rows, csv)
    for _ in range(2):
        load.stage_and_replace(spark, csv, path, EXTRACTS[table], RUN_DATE)
    return spark.read.parquet(path)


@query
def load_wl_border(spark, d):
    rows = whitelist.wl_border(
        lens.whitelist(spark, d), lens.subscribers(spark, d), extract_date=RUN_DATE
    )
    return _handed_over(spark, "wl_border", rows)


@query
def load_taker_border(spark, d):
    rows = taker.taker_border(
        lens.taker(spark, d), lens.subscribers(spark, d), extract_date=RUN_DATE
    )
    return _handed_over(spark, "taker_border", rows)


@query
def replace_partition(spark, d):
    """Load all years, replace two of them, and replace another one by nothing."""
    path = scratch_path(spark, "usage")
    rows = _yearly_usage(spark, d)
    load.replace_partitions(rows, path, ["year"])
    for _ in range(2):
        load.replace_partitions(_one_more(rows.where("year IN (1996, 1997)")), path, ["year"])
    load.replace_slice(rows.where("year = 1998 AND date IS NULL"), path, {"year": 1998})
    return spark.read.parquet(path)


@query
def border_tables(spark, d):
    """All levels written at once, partitioned by level; one level read back by its own name."""
    path = scratch_path(spark, "border_taker")
    run = extracts(spark, d)
    load.replace_partitions(border.border_taker(run.summary, run.taker_border), path, ["level"])
    return border.border_of_level(spark.read.parquet(path), "kabupaten")


@query
def stage_and_replace(spark, d):
    """Hand over an extract as CSV and load it twice next to an older one."""
    path, csv = scratch_path(spark, "taker_offer"), scratch_path(spark, "taker_offer_csv")
    takers = lens.taker(spark, d)
    old = taker.taker_by_offer(takers, extract_date=date(2001, 9, 2))
    load.replace_partitions(old, path, ["extract_date"])
    write_csv(taker.taker_by_offer(takers, extract_date=RUN_DATE, towers=TOWERS), csv)
    for _ in range(2):
        load.stage_and_replace(spark, csv, path, EXTRACTS["taker_offer"], RUN_DATE)
    return spark.read.parquet(path)


@query
def csv_round_trip(spark, d):
    """Write the cleaned campaign extract as CSV and read it with its schema."""
    csv = scratch_path(spark, "campaign_csv")
    campaigns = extract.campaign_summary_clean(lens.campaigns(spark, d))
    tagged = campaigns.select(
        F.lit(RUN_DATE).alias("extract_date"), F.lit(DATA_DATE).alias("d_date"), "*"
    )
    write_csv(tagged, csv)
    return read_csv(spark, csv, EXTRACTS["campaign_summary"])


@query
def sync_by_key(spark, d):
    """Copy one year over an older copy of it; a year without rows changes nothing."""
    path = scratch_path(spark, "sync")
    rows = _yearly_usage(spark, d)
    load.replace_partitions(rows, path, ["year"])
    load.sync_by_key(_one_more(rows), path, "year", 1999)
    load.sync_by_key(rows, path, "year", 1900)
    return spark.read.parquet(path)


@query
def sync_append(spark, d):
    path = scratch_path(spark, "append")
    rows = _yearly_usage(spark, d)
    load.replace_partitions(rows, path, ["year"])
    load.sync_append(rows, path, "year", 1999)
    return spark.read.parquet(path)


@query
def sync_upsert(spark, d):
    """Update the parts that shipped often in a month of 1999, keep the others."""
    path = scratch_path(spark, "upsert")
    rows = _yearly_usage(spark, d)
    load.replace_partitions(rows, path, ["year"])
    changed = _one_more(rows.where("active_user_count > 1"))
    load.sync_upsert(changed, path, "year", 1999, ["application_portfolio_id", "date"])
    return spark.read.parquet(path)


@query
def available_dates(spark, d):
    return load.available_dates(extracts(spark, d).summary, "extract_date")


@query
def non_empty_check(spark, d):
    takers = taker.taker_by_offer(lens.taker(spark, d))
    return load.require_rows(takers, "takers by offer")


# Application catalogue


@query
def catalog_search(spark, d):
    return catalog.catalog_search(
        lens.catalogue(spark, d), lens.tags(spark, d), keyword="B", tag_ids=TAG_IDS
    )


@query
def catalog_search_all(spark, d):
    return catalog.catalog_search(lens.catalogue(spark, d), lens.tags(spark, d), live_only=False)


@query
def catalog_review(spark, d):
    return catalog.catalog_review(lens.catalogue(spark, d), keyword="ed", now=NOW)


@query
def tag_counts(spark, d):
    return catalog.tag_counts(lens.catalogue(spark, d), lens.tags(spark, d))


@query
def tag_counts_with_other(spark, d):
    return catalog.tag_counts_with_other(lens.catalogue(spark, d), lens.tags(spark, d))


@query
def tag_group_total(spark, d):
    return catalog.tag_group_total(lens.catalogue(spark, d), lens.tags(spark, d))


@query
def app_details(spark, d):
    details = catalog.app_details(lens.catalogue(spark, d), 53)
    return details.withColumn("tags", F.array_join("tags", "|"))


@query
def tag_list(spark, d):
    return catalog.tag_list(lens.tags(spark, d), "function")


@query
def normalize_tags(spark, d):
    renames = {"tag_category": {"ECONOMY": "Economy", "SMALL": "Small"}}
    return catalog.normalize_tags(lens.catalogue(spark, d), renames).select(*catalog.APP_COLUMNS)


@query
def soft_delete(spark, d):
    deleted = catalog.soft_delete(lens.catalogue(spark, d), 99, NOW)
    return deleted.select("id", "is_deleted", "deleted_at")


@query
def soft_delete_stored(spark, d):
    """Delete a row, unify tags and add columns in a stored catalogue."""
    path = scratch_path(spark, "catalogue")
    renames = {"tag_category": {"ECONOMY": "Economy", "SMALL": "Small"}}
    ingest.recreate_table(lens.catalogue(spark, d), path)
    ingest.update_table(spark, path, lambda t: catalog.soft_delete(t, 99, NOW))
    ingest.update_table(spark, path, lambda t: catalog.normalize_tags(t, renames))
    ingest.update_table(spark, path, catalog.schema_evolve)
    return spark.read.parquet(path).select(
        "id", "is_deleted", "deleted_at", "tag_category", "tag_db_system", "is_public_facing"
    )


@query
def install_type_summary(spark, d):
    return catalog.install_type_summary(lens.portfolio(spark, d))


@query
def category_manufacturer_summary(spark, d):
    return catalog.category_summary(lens.portfolio(spark, d), "manufacturer")


@query
def category_version_status_summary(spark, d):
    return catalog.category_summary(lens.portfolio(spark, d), "version_age_status")


@query
def category_manufacturer_matrix(spark, d):
    return catalog.category_matrix(lens.portfolio(spark, d), "manufacturer")


@query
def category_version_status_matrix(spark, d):
    return catalog.category_matrix(lens.portfolio(spark, d), "version_age_status")


@query
def top10_active_users(spark, d):
    return catalog.top10_active_users(lens.portfolio(spark, d), "application_name")


@query
def apps_count_by(spark, d):
    return catalog.apps_count_by(lens.portfolio(spark, d), "manufacturer")


@query
def filters_by_context(spark, d):
    return catalog.filters_by_context(lens.filters(spark, d), "MACHINERY")


@query
def top10_filters(spark, d):
    return catalog.top10_filters(lens.filters(spark, d))


@query
def distinct_manufacturers(spark, d):
    return catalog.distinct_manufacturers(lens.portfolio(spark, d))


@query
def portfolio_listing(spark, d):
    return catalog.portfolio_listing(lens.portfolio(spark, d))


@query
def usage_listing(spark, d):
    return catalog.usage_listing(lens.portfolio(spark, d), lens.usage(spark, d))


@query
def request_store_relation(spark, d):
    return catalog.request_store_relation(
        lens.requests(spark, d), lens.store_relation(spark, d), lens.stores(spark, d)
    )


@query
def schema_evolve(spark, d):
    return catalog.schema_evolve(lens.catalogue(spark, d))


@query
def fk_check(spark, d):
    """Parts that were never shipped, as usage that is missing for them."""
    return catalog.fk_check(
        lens.portfolio(spark, d), "id", lens.usage(spark, d), "application_portfolio_id"
    )


# Sheets


def _placed(df):
    place = F.concat_ws(":", "source_row.conv_id", "source_row.turn")
    return df.withColumn("place", place).drop("source_file", "source_block", "source_row")


@query
def next_ids(spark, d):
    return _placed(ingest.next_ids(lens.portfolio(spark, d), lens.keyed_sheet(spark, d)))


@query
def snake_case_columns(spark, d):
    return _placed(ingest.snake_case_columns(lens.sheet(spark, d)))


@query
def clean_nulls(spark, d):
    documents = lens.table(spark, d, "documents")
    return ingest.clean_nulls(
        documents.select(F.col("doc_id").cast("string").alias("id"), "text", "lang", "source")
    )


@query
def fold_rows_status_division(spark, d):
    named = ingest.snake_case_columns(lens.sheet(spark, d))
    return _placed(ingest.fold_rows_status_division(named))


@query
def fold_rows_no(spark, d):
    return _placed(ingest.fold_rows_no(lens.keyed_sheet(spark, d)))


@query
def surrogate_id(spark, d):
    return _placed(ingest.surrogate_id(lens.keyed_sheet(spark, d)))


@query
def column_lengths(spark, d):
    return ingest.column_lengths(lens.table(spark, d, "documents"))


@query
def column_types(spark, d):
    """Declared type of each column of the ingested sheet, next to the longest value."""
    table = ingest.catalog_ingest(lens.sheet(spark, d), "status_division", drop=["no"])
    types = [
        F.lit(x)
        for f in ingest.column_types(table.columns)
        for x in (f.name, f.dataType.simpleString())
    ]
    return ingest.column_lengths(table).withColumn(
        "data_type", F.create_map(*types)[F.col("column_name")]
    )


def _sheet_file(spark, d):
    """The sheet as CSV files in order, a conversation in one file."""
    path = scratch_path(spark, "sheet") + ".csv"
    rows = lens.sheet(spark, d)
    ordered = rows.repartitionByRange("source_row.conv_id").sortWithinPartitions("source_row")
    write_csv(ordered.drop(*ingest.POSITION), path)
    return path


@query
def catalog_ingest(spark, d):
    path = scratch_path(spark, "table")
    sheet = read_sheet(spark, _sheet_file(spark, d), multiline=True)
    ingest.recreate_table(ingest.catalog_ingest(sheet, "status_division", drop=["no"]), path)
    return spark.read.parquet(path)


@query
def catalog_reload(spark, d):
    """Load the first rows of a table, replace them by all, and reload it from itself."""
    path = scratch_path(spark, "reload")
    table = ingest.catalog_ingest(lens.sheet(spark, d), "status_division", drop=["no"])
    ingest.recreate_table(table.where("id < 3"), path)
    ingest.recreate_table(table, path)
    ingest.recreate_table(spark.read.parquet(path), path)
    return spark.read.parquet(path)


# Time, sketches and changes


@query
def taker_last_contact(spark, d):
    """Every taker with the last contact of the subscriber on or before the day of taking."""
    takers = lens.taker(spark, d).select("msisdn", "offer_id", "take_date")
    contacts = lens.whitelist(spark, d).select(
        F.col("msisdn_wl").alias("msisdn"), "start_date", F.col("start_date").alias("contact_date"),
        F.col("offer_id").alias("contact_offer"),
    )
    found = temporal.as_of_join(
        takers, contacts, ["msisdn"], "take_date", "start_date", ["contact_date", "contact_offer"]
    )
    return found.withColumn("days_since", F.datediff("take_date", "contact_date"))


@query
def takers_in_campaign(spark, d):
    """Takers whose day lies in a campaign of the offer, per campaign."""
    campaigns = lens.campaigns(spark, d).select(
        "offer_id", "campaign_id", "start_date", "end_date", "communication_channel"
    )
    takers = lens.taker(spark, d).select("offer_id", "msisdn", "take_date", "trx")
    inside = temporal.interval_join(
        takers, campaigns, ["offer_id"], "take_date", "start_date", "end_date"
    )
    return inside.groupBy(campaigns.columns).agg(
        F.count(F.lit(1)).alias("takers"), F.countDistinct("msisdn").alias("uni_taker"),
        F.sum("trx").alias("trx"),
    )


@query
def reach_by_period(spark, d):
    """Reach of each day, month and all time, merged from stored sketches of the days."""
    contacts = lens.whitelist(spark, d).withColumnRenamed("start_date", "day")
    days = reach.reach_sketch(contacts, ["day"], "msisdn_wl")
    path = scratch_path(spark, "reach")
    days.write.parquet(path)
    days = spark.read.parquet(path)
    periods = {"day": F.col("day"), "month": F.trunc("day", "month"), "all": F.lit(None).cast("date")}
    levels = F.array(
        *[F.struct(F.lit(n).alias("level"), p.alias("period")) for n, p in periods.items()]
    )
    periods = days.select(F.inline(levels), "register", "rank")
    merged = reach.merge_sketches(periods, ["level", "period"])
    return reach.reach_estimate(merged, ["level", "period"])


@query
def whitelist_changes(spark, d):
    """Rows per offer that differ between the two extracts of each month."""
    rows = extracts(spark, d).wl_offer
    columns = ["strmonth", "offer_id", "msisdn_wl", "msisdn_delivered"]
    newest = F.col("d_date") == F.last_day("strmonth")
    old, new = rows.where(~newest).select(columns), rows.where(newest).select(columns)
    return changes.snapshot_changes(old, new, ["strmonth", "offer_id"])


@query
def attribute_counts(spark, d):
    return attributes.attribute_counts(lens.attributes(spark, d), "attributes")


@query
def contact_sessions(spark, d):
    """Runs of contacts of a subscriber with at most 14 days between neighbours."""
    contacts = lens.whitelist(spark, d).select(F.col("msisdn_wl").alias("msisdn"), "start_date")
    return temporal.day_sessions(contacts, ["msisdn"], "start_date", 14)


@query
def offer_rolling_reach(spark, d):
    """Subscribers that an offer contacted within seven days, for each day with a contact."""
    contacts = lens.whitelist(spark, d).select("offer_id", F.col("start_date").alias("day"), "msisdn_wl")
    return temporal.rolling_reach(contacts, ["offer_id"], "day", "msisdn_wl", 7)


@query
def days_since_contact(spark, d):
    contacts = lens.whitelist(spark, d).select(F.col("msisdn_wl").alias("msisdn"), "start_date")
    return temporal.days_since_last(contacts, ["msisdn"], "start_date")


# Streams


def _in_two_runs(spark, rows, day, result_of):
    """A stream's result after a run over the older files and one, from the checkpoint, over all."""
    files, path, checkpoint = (scratch_path(spark, n) for n in ("arrivals", "closed", "state"))
    newer = F.col(day) >= F.lit(STREAM_SPLIT)
    for arrived in (rows.where(~newer), rows.where(newer)):
        arrived.write.mode("append").parquet(files)
        result = result_of(spark.readStream.schema(rows.schema).parquet(files))
        periods.advance(result, path, checkpoint)
    return periods.so_far(spark, result, path, checkpoint)


@query
def taker_windows(spark, d):
    """Takers per offer in windows of 14 days that begin every 7 days."""
    takers = lens.taker(spark, d).select("offer_id", "take_date", "trx")
    groups = _in_two_runs(
        spark, takers, "take_date",
        lambda stream: periods.windowed(stream, "take_date", ["offer_id"], 14, 7, 10, ["trx"]),
    )
    return groups.select(
        periods.utc_day(F.col("period.start")).alias("first_day"),
        periods.utc_day(F.col("period.end")).alias("end_day"), "offer_id", "rows", "trx",
    )


@query
def first_touch_credit(spark, d):
    """Subscribers per month and the offer that touched them first, kept as state."""
    contacts = lens.whitelist(spark, d).select("msisdn_wl", "start_date", "offer_id")
    touched = _in_two_runs(
        spark, contacts, "start_date",
        lambda stream: periods.first_touch(stream, "start_date", ["msisdn_wl"], "offer_id"),
    )
    month_end = periods.utc_day(F.col("month_end")).alias("month_end")
    return touched.groupBy(month_end, F.col("first.offer_id").alias("offer_id")).agg(
        F.count("msisdn_wl").alias("subscribers")
    )
