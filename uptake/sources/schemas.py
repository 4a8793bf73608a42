"""Schemas of the input tables and the key each stored table is replaced by."""

from __future__ import annotations

from pyspark.sql import types as T

_DATE, _LONG, _STRING = T.DateType(), T.LongType(), T.StringType()
_MONEY = T.DecimalType(18, 4)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


_SNAPSHOT = {"extract_date": _DATE, "d_date": _DATE}
_TAKER_SNAPSHOT = {"extract_date": _DATE, "data_date": _DATE}
_TAKER_TOTALS = {"total_msisdn": _LONG, "trx": _LONG, "revenue": _MONEY}

CAMPAIGN = _schema(
    strmonth=_DATE,
    offer_id=_LONG,
    campaign_id=_STRING,
    tower=_STRING,
    product=_STRING,
    campaign_initiatives=_STRING,
    start_date=_DATE,
    end_date=_DATE,
    communication_channel=_STRING,
    id_campaign_objective=_STRING,
    id_campaign_category=_STRING,
    camp_category=_STRING,
    wltype=_STRING,
    sender_initial_bc=_STRING,
    email_user=_STRING,
    date_initial_bc=_DATE,
    catcamp=_STRING,
)
CAMPAIGN_COLUMNS = CAMPAIGN.fieldNames()

WHITELIST = _schema(
    strmonth=_DATE, offer_id=_LONG, msisdn_wl=_LONG, msisdn_delivered=_LONG, start_date=_DATE
)
TAKER = _schema(
    strmonth=_DATE, tower_name=_STRING, offer_id=_LONG, msisdn=_LONG, trx=_LONG, revenue=_MONEY
)
SUBSCRIBER = _schema(
    event_date=_DATE,
    msisdn=_LONG,
    kabupaten=_STRING,
    region_sales=_STRING,
    area_sales=_STRING,
    los=_STRING,
)

# Extracts handed over as CSV and loaded with stage_and_replace, by table name.
EXTRACTS = {
    "campaign_summary": T.StructType([*_schema(**_SNAPSHOT).fields, *CAMPAIGN.fields]),
    "wl_offer": _schema(
        **_SNAPSHOT, strmonth=_DATE, offer_id=_LONG, msisdn_wl=_LONG, msisdn_delivered=_LONG
    ),
    "wl_border": _schema(
        level=_STRING,
        **_SNAPSHOT,
        strmonth=_DATE,
        offer_id=_LONG,
        border=_STRING,
        total_msisdn=_LONG,
        msisdn_delivered=_LONG,
    ),
    "wl_recurring": _schema(
        **_SNAPSHOT, strmonth=_DATE, start_date=_DATE, total_offer=_LONG, recurring_msisdn=_LONG
    ),
    "wl_recurring_kabupaten": _schema(
        **_SNAPSHOT,
        strmonth=_DATE,
        start_date=_DATE,
        kabupaten=_STRING,
        total_offer=_LONG,
        recurring_msisdn=_LONG,
    ),
    "wl_los": _schema(
        **_SNAPSHOT,
        strmonth=_DATE,
        offer_id=_LONG,
        los=_STRING,
        total_msisdn=_LONG,
        msisdn_delivered=_LONG,
    ),
    "taker_offer": _schema(**_TAKER_SNAPSHOT, strmonth=_DATE, offer_id=_LONG, **_TAKER_TOTALS),
    "taker_border": _schema(
        level=_STRING,
        **_TAKER_SNAPSHOT,
        strmonth=_DATE,
        offer_id=_LONG,
        border=_STRING,
        **_TAKER_TOTALS,
    ),
}

# The key whose value selects the rows of a sync, by served table. Fixed values.
SYNC_KEYS = {
    "summary_channel": "strmonth",
    "summary_product": "strmonth",
    "summary_kabupaten": "strmonth",
    "top_main_level": "strmonth",
    "top_main_level_l1": "strmonth",
    "taker_border_area": "strmonth",
    "taker_border_region": "strmonth",
    "wl_border_area": "strmonth",
    "wl_border_region": "strmonth",
    "taker_los": "strmonth",
    "taker_border_area_mtd": "strmonth",
    "summary_channel_mtd": "d_date",
    "summary_product_mtd": "d_date",
    "summary_kabupaten_mtd": "d_date",
    "top_main_level_mtd": "d_date",
    "top_main_level_l1_mtd": "d_date",
    "taker_border_region_mtd": "d_date",
    "campaign_summary": "extract_date",
    "wl_offer": "extract_date",
    "wl_los": "extract_date",
    "taker_offer": "extract_date",
    "wl_recurring_kabupaten": "extract_date",
}

# Application catalogue.
TAGS_REFERENCE = _schema(id=T.IntegerType(), tag=_STRING, name=_STRING)
APPLICATION_PORTFOLIO = _schema(
    id=T.IntegerType(),
    application_name=_STRING,
    category=_STRING,
    install_type=_STRING,
    application_type=_STRING,
    business_process=_STRING,
    business_unit=_STRING,
    total_active_users=T.IntegerType(),
    version_age_status=_STRING,
    manufacturer=_STRING,
)
APPLICATION_USAGE = _schema(
    id=T.IntegerType(),
    application_portfolio_id=T.IntegerType(),
    active_user_count=T.IntegerType(),
    date=_DATE,
)
FILTER_REFERENCE = _schema(
    id=T.IntegerType(), name=_STRING, display_name=_STRING, context=_STRING
)
DATA_MANAGEMENT_STORE = _schema(id=T.IntegerType(), name=_STRING)
DATA_MANAGEMENT_STORE_RELATION = _schema(
    id=T.IntegerType(), application_request_id=T.IntegerType(), data_management_store_id=T.IntegerType()
)
APPLICATION_REQUEST = _schema(
    id=T.IntegerType(),
    requester_name=_STRING,
    requester_department=_STRING,
    requester_nik=_STRING,
    apps_owner_pic=_STRING,
    apps_owner_department=_STRING,
    apps_custody_pic=_STRING,
    asset_name=_STRING,
    asset_objective=_STRING,
    description=_STRING,
    sustain_reason=_STRING,
    is_public_facing=T.BooleanType(),
    public_facing_data_sharing_target=_STRING,
    is_contain_pii_data=T.BooleanType(),
    pii_data_description=_STRING,
    url=_STRING,
    ip_address=_STRING,
    asset_location_site_id=_STRING,
    asset_location_site_name=_STRING,
    tag_os_baseline=_STRING,
    tag_access_management=_STRING,
    status=_STRING,
    start_period=_DATE,
)
CATALOGUE_HUB = _schema(
    id=T.IntegerType(),
    tenant_aplikasi=_STRING,
    device_ip_address=_STRING,
    hostname_device_name=_STRING,
    device_type=_STRING,
    device_type_name=_STRING,
    os=_STRING,
    function=_STRING,
    cpu=T.IntegerType(),
    memory_gb=_LONG,
    disk_gb=_LONG,
    server_location=_STRING,
)
SECURITY_ASSESSMENT = _schema(
    id=T.IntegerType(),
    security_name=_STRING,
    apps=_STRING,
    severity_critical=T.IntegerType(),
    severity_high=T.IntegerType(),
    severity_medium=T.IntegerType(),
    severity_low=T.IntegerType(),
    total=T.IntegerType(),
    status=_STRING,
    remark=_STRING,
)
# Columns added to the catalogue table later, with their defaults.
CATALOGUE_ADDED_COLUMNS = {
    "is_public_facing": ("boolean", False),
    "is_contain_pii_data": ("boolean", False),
    "pii_data_description": ("string", None),
    "requester_name": ("string", None),
    "requester_department": ("string", None),
    "requester_nik": ("string", None),
    "apps_custody_pic": ("string", None),
    "asset_objective": ("string", None),
    "sustain_reason": ("string", None),
    "public_facing_data_sharing_target": ("string", None),
    "start_period": ("date", None),
    "apps_development_pic": ("string", None),
    "decline_time": ("timestamp", None),
}
