"""They decide results, so they are stated once and plainly."""

# Label of a subtotal row.
ALL = "ALL"

# Business towers, and the ones that count for the channel, product and L1 KPIs.
TOWERS = ("SIMPATI", "HALO", "AREA", "OTHERS", "BYU")
CORE_TOWERS = ("SIMPATI", "HALO", "AREA")

# Whitelist type buckets.
RULEBASED = "RULEBASED"
REGULER = "REGULER"

# Geography levels of the subscriber dimension.
LEVELS = ("area_sales", "kabupaten", "region_sales")

# Cost per delivered message, by channel.
MESSAGE_COST = {"SMS": 262, "WABA": 100}

# A take-up rate at or above the ceiling is not believed and is set to the floor.
TUR_CEILING = 0.3
TUR_CLAMPED = 0.01

# Days between the day of the data and the day of the extract.
EXTRACT_LAG_DAYS = 2

# Tag kinds of the application catalogue: kind -> (column, id and name used for null tags).
TAG_KINDS = {
    "category": ("tag_category", 997, "Other Category"),
    "function": ("tag_function_application", 998, "Other Function"),
    "db_system": ("tag_db_system", 999, "Other DB System"),
}

# Tag spellings that mean the same, by column.
TAG_RENAMES = {
    "tag_category": {
        "Reporting, Analytic, ML & Visualization": "Reporting, Analytic, ML and Visualization",
    },
    "tag_db_system": {"Database - Maria DB": "Database - MariaDB"},
}

# Application status values.
LIVE = "Live"
ON_REVIEW = "On Review"
DECLINED = "Declined"

# Filter context of the top-10 report.
TOP_10_CONTEXT = "FILTER_TOP_10_BY_TOTAL_USER"

# Sheet columns stored as unbounded text; every other one holds at most 255 characters.
TEXT_COLUMNS = (
    "description",
    "url",
    "ip_address",
    "data_processing_management",
    "source_data_application",
    "tag_data_processing_management",
    "output_application",
    "asset_owner_department",
    "apps_custody_pic",
    "apps_custody_pic_user",
)
VARCHAR_LENGTH = 255
