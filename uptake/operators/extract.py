"""Campaign table extracts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.functions.dates import in_month, run_dates, tagged
from uptake.sources.schemas import CAMPAIGN_COLUMNS


def campaign_month_listing(summary: DataFrame, month: date | None = None) -> DataFrame:
    """Campaign rows of a month."""
    return in_month(summary, month).select(*CAMPAIGN_COLUMNS)


def campaign_summary_extract(
    summary: DataFrame, extract_date: date, month: date | None = None, all_months: bool = False
) -> DataFrame:
    """Campaign rows of the run's month, tagged with the extract and data day."""
    if month is None and not all_months:
        month = run_dates(extract_date).strmonth
    return tagged(campaign_month_listing(summary, month), extract_date)


def campaign_summary_clean(summary: DataFrame, month: date | None = None) -> DataFrame:
    """Campaign rows with line breaks and tabs in the free-text columns made spaces."""
    flat = {
        c: F.regexp_replace(c, r"[\r\n\t]", " ") for c in ("campaign_initiatives", "email_user")
    }
    return campaign_month_listing(summary, month).withColumns(flat)
