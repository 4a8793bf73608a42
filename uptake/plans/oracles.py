"""SQL that gives the result of each registered query on the same tables."""

from __future__ import annotations

from uptake.plans.lens_sql import with_ctes

RUN = "DATE '2001-09-03' AS extract_date"
RUN_D_DATE = f"{RUN}, DATE '2001-09-01' AS d_date"
RUN_DATA_DATE = f"{RUN}, DATE '2001-09-01' AS data_date"

CAMPAIGN = """strmonth, offer_id, campaign_id, tower, product, {initiatives}, start_date, end_date,
    communication_channel, id_campaign_objective, id_campaign_category, camp_category, wltype,
    sender_initial_bc, {email}, date_initial_bc, catcamp"""
RAW_CAMPAIGN = CAMPAIGN.format(initiatives="campaign_initiatives", email="email_user")
FLAT = "translate({0}, chr(9) || chr(10) || chr(13), '   ') AS {0}"
FLAT_CAMPAIGN = CAMPAIGN.format(
    initiatives=FLAT.format("campaign_initiatives"), email=FLAT.format("email_user")
)

TAKER_SUMS = """COUNT(DISTINCT msisdn) AS total_msisdn, CAST(SUM(trx) AS BIGINT) AS trx,
    CAST(SUM(revenue) AS DOUBLE) AS revenue"""

SETS = ((), ("tower",), ("wltype",), ("tower", "wltype"))
LEAF = ("tower", "wltype", "initiatives")


def grouped(fixed: str, aggs: str, source: str, sets=SETS) -> str:
    """Aggregate over grouping sets, labelling what a set leaves out."""
    dims = list(dict.fromkeys(c for s in sets for c in s))
    labels = ", ".join(f"CASE GROUPING(x.{c}) WHEN 1 THEN 'ALL' ELSE x.{c} END AS {c}" for c in dims)
    fixed_cols = ", ".join(f"x.{c.strip()}" for c in fixed.split(","))
    listed = ", ".join(
        "(" + ", ".join([fixed_cols, *[f"x.{c}" for c in s]]) + ")" for s in sets
    )
    return f"""SELECT {fixed_cols}, {labels}, {aggs}
        FROM ({source}) x GROUP BY GROUPING SETS ({listed})"""


def div(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


def big(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


def dbl(expr: str, name: str) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name}"


MEAN_TUR = div("SUM(CAST(tur AS DECIMAL(18,12)))", "COUNT(tur)") + " AS tur"
CORE = "('SIMPATI', 'HALO', 'AREA')"

# Facts at the newest snapshot, tolerant of late ones, or two days before it.
WL_NOW = "SELECT w.* FROM wl_offer w SEMI JOIN newest USING (strmonth, extract_date)"
TAKER_NOW = "SELECT t.* FROM taker_offer t SEMI JOIN newest USING (strmonth, extract_date)"
TAKER_LATE = """SELECT t.* FROM taker_offer t JOIN newest n ON t.strmonth = n.strmonth
    AND t.extract_date IN (n.extract_date, n.extract_date + {0})"""
LAGGED = """SELECT f.* FROM {0} f JOIN newest n ON f.strmonth = n.strmonth
    AND f.extract_date = n.extract_date - 2"""

MTD_FACTS = (LAGGED.format("wl_offer"), LAGGED.format("taker_offer"))


def sources(core: bool, wl: str, takers: str, columns: str = "*") -> str:
    """CTEs: campaigns, campaign-target pairs, campaign-taker pairs."""
    where = f"WHERE tower IN {CORE}" if core else ""
    return f"""camp AS (SELECT {columns} FROM base {where}),
        target_pairs AS (SELECT c.*, w.msisdn_wl, w.msisdn_delivered FROM camp c
                         JOIN ({wl}) w USING (strmonth, offer_id)),
        taker_pairs AS (SELECT c.*, t.total_msisdn, t.trx, t.revenue FROM camp c
                        JOIN ({takers}) t USING (strmonth, offer_id))"""


def top_level(core: bool, day: str, wl: str, takers: str) -> str:
    keys = "strmonth, tower, wltype"
    return f"""WITH {sources(core, wl, takers)},
        targets AS ({grouped(day + "strmonth", big("SUM(msisdn_wl)", "total_target"),
                             "SELECT * FROM target_pairs")}),
        delivery AS ({grouped("strmonth", "100 * " + div("SUM(msisdn_delivered)", "SUM(msisdn_wl)")
                              + " AS delivery_rate", "SELECT * FROM target_pairs")}),
        taken AS ({grouped("strmonth", big("SUM(total_msisdn)", "total_taker") + ", "
                           + dbl("SUM(revenue)", "total_revenue"), "SELECT * FROM taker_pairs")}),
        offers AS ({grouped("strmonth", "COUNT(DISTINCT offer_id) AS total_campaign",
                            "SELECT * FROM camp")}),
        rates AS ({grouped("strmonth", MEAN_TUR, f"SELECT * FROM tur WHERE tower IN {CORE}")}),
        tracked AS ({grouped("strmonth", "100 * (" + div("COUNT(taker_offer_id)", "COUNT(offer_id)")
                             + ") AS trackable",
                             f'''SELECT c.*, t.offer_id AS taker_offer_id FROM camp c
                             LEFT JOIN ({takers}) t
                             ON t.strmonth = c.strmonth AND t.offer_id = c.offer_id''')})
        SELECT {day} strmonth, tower, wltype, total_target, total_campaign, delivery_rate,
               total_taker, total_revenue, tur, trackable
        FROM targets LEFT JOIN offers USING ({keys}) LEFT JOIN delivery USING ({keys})
             LEFT JOIN taken USING ({keys}) LEFT JOIN rates USING ({keys})
             LEFT JOIN tracked USING ({keys})"""


def top_level_l1(fixed: str, sets, wl: str, takers: str, nulls_equal: bool) -> str:
    keys = f"{fixed}, tower, wltype, initiatives"
    same = "IS NOT DISTINCT FROM" if nulls_equal else "="

    def on(table: str) -> str:
        equal = " AND ".join(f"targets.{c.strip()} {same} {table}.{c.strip()}" for c in keys.split(","))
        return f"LEFT JOIN {table} ON {equal}"

    shown = ", ".join(f"targets.{c.strip()}" for c in keys.split(","))
    named = "* RENAME (campaign_initiatives AS initiatives)"
    return f"""WITH {sources(True, wl, takers, named)},
        targets AS ({grouped(fixed, big("SUM(msisdn_wl)", "total_target"),
                             "SELECT * FROM target_pairs", sets)}),
        delivery AS ({grouped(fixed, big("SUM(msisdn_delivered)", "delivered") + ", 100 * "
                              + div("SUM(msisdn_delivered)", "SUM(msisdn_wl)")
                              + " AS delivery_rate", "SELECT * FROM target_pairs", sets)}),
        taken AS ({grouped(fixed, ", ".join([
            big("SUM(total_msisdn)", "total_uni_taker"), dbl("SUM(revenue)", "total_revenue"),
            big("SUM(trx)", "total_transaction"),
            div("SUM(revenue)", "SUM(total_msisdn)") + " AS rev_taker",
            div("SUM(revenue)", "SUM(trx)") + " AS rev_trx",
            div("SUM(trx)", "SUM(total_msisdn)") + " AS trx_taker"]),
            "SELECT * FROM taker_pairs", sets)}),
        rates AS ({grouped(fixed, MEAN_TUR, f"SELECT {named} FROM tur WHERE tower IN {CORE}",
                           sets)})
        SELECT {shown}, total_target, total_revenue, total_transaction, total_uni_taker, tur,
               rev_taker, rev_trx, trx_taker, delivery_rate, delivered
        FROM targets {on("delivery")} {on("taken")} {on("rates")}"""


def channel(day: str, wl: str, takers: str, known: bool) -> str:
    keys = "strmonth, tower, wltype, communication_channel"
    columns = (
        "* REPLACE (COALESCE(communication_channel, 'ALL') AS communication_channel)"
        if known
        else "*"
    )
    fixed = "strmonth, communication_channel"
    return f"""WITH {sources(True, wl, takers, columns)},
        targets AS ({grouped(day + fixed, big("SUM(msisdn_wl)", "total_target"),
                             "SELECT * FROM target_pairs")}),
        taken AS ({grouped(fixed, ", ".join([
            big("SUM(total_msisdn)", "taker"), big("SUM(trx)", "trx"),
            dbl("SUM(revenue)", "revenue")]), "SELECT * FROM taker_pairs")}),
        rates AS ({grouped(fixed, MEAN_TUR, f"SELECT {columns} FROM tur WHERE tower IN {CORE}")})
        SELECT {day} {keys}, total_target, taker, trx, tur, revenue,
               {div("revenue", "taker")} AS revenue_per_taker,
               {div("revenue", "trx")} AS revenue_per_trx, {div("trx", "taker")} AS trx_per_taker
        FROM targets LEFT JOIN taken USING ({keys}) LEFT JOIN rates USING ({keys})"""


def product(day: str, wl: str, takers: str, join: str = "JOIN") -> str:
    keys = "strmonth, product, tower, wltype"
    fixed = "strmonth, product"
    billed_sets = tuple((*s, "communication_channel") for s in SETS)
    billed = grouped(
        fixed,
        "SUM(CASE WHEN msisdn_delivered = 0 THEN msisdn_wl ELSE msisdn_delivered END) AS messages",
        "SELECT * FROM target_pairs WHERE communication_channel IN ('SMS', 'WABA')",
        billed_sets,
    )
    return f"""WITH {sources(True, wl, takers)},
        targets AS ({grouped(day + fixed, big("SUM(msisdn_wl)", "total_target"),
                             "SELECT * FROM target_pairs")}),
        taken AS ({grouped(fixed, dbl("SUM(revenue)", "revenue"), "SELECT * FROM taker_pairs")}),
        rates AS ({grouped(fixed, MEAN_TUR, '''SELECT c.*, r.tur FROM camp c
                           JOIN tur r USING (strmonth, offer_id)''')}),
        billed AS ({billed}),
        costs AS (SELECT {keys}, {big('''SUM(messages * CASE communication_channel
                         WHEN 'SMS' THEN 262 WHEN 'WABA' THEN 100 END)''', "cost")}
                  FROM billed GROUP BY ALL),
        delivery AS ({grouped(fixed, "100 * (" + div("SUM(msisdn_delivered)", "SUM(msisdn_wl)")
                              + ") AS delivery_rate", "SELECT * FROM target_pairs")})
        SELECT {day} {keys}, total_target, tur, revenue, cost, delivery_rate
        FROM targets {join} taken USING ({keys}) {join} rates USING ({keys})
             {join} costs USING ({keys}) {join} delivery USING ({keys})"""


def kabupaten(day: str) -> str:
    here = "SEMI JOIN newest USING (strmonth, extract_date) WHERE level = 'kabupaten'"
    fixed = f"{day}strmonth, kabupaten"
    rates = """SELECT strmonth, offer_id, SUM(CAST(tur AS DECIMAL(18,12))) AS tur_sum,
                      COUNT(tur) AS tur_known FROM tur GROUP BY ALL"""
    pairs = f"""SELECT c.*, w.border AS kabupaten, w.total_msisdn AS target,
                       w.msisdn_delivered AS delivered, t.total_msisdn AS taker, t.revenue,
                       r.tur_sum, r.tur_known
                FROM (SELECT * FROM base WHERE tower IN {CORE}) c
                JOIN (SELECT * FROM wl_border {here}) w USING (strmonth, offer_id)
                LEFT JOIN (SELECT * FROM taker_border {here}) t
                     ON t.strmonth = w.strmonth AND t.offer_id = w.offer_id
                        AND t.border = w.border
                LEFT JOIN ({rates}) r ON r.strmonth = w.strmonth AND r.offer_id = w.offer_id"""
    aggs = ", ".join([
        big("SUM(taker)", "total_taker"), dbl("SUM(revenue)", "revenue"),
        "100 * " + div("SUM(delivered)", "SUM(target)") + " AS delivery_rate",
        div("SUM(tur_sum)", "SUM(tur_known)") + " AS tur",
    ])
    return grouped(fixed, aggs, pairs)


def borders(day: str, facts: str, aggs: str, rows: str = "base") -> str:
    return f"""SELECT level, {day} strmonth, border, tower, wltype, campaign_initiatives, {aggs}
        FROM (SELECT c.*, f.* EXCLUDE (strmonth, offer_id, extract_date, {
            "data_date" if facts == "taker_border" else "d_date"})
              FROM {rows} c JOIN {facts} f USING (strmonth, offer_id)
              SEMI JOIN newest n ON n.strmonth = f.strmonth AND n.extract_date = f.extract_date
              WHERE c.tower IN {CORE})
        GROUP BY ALL"""


BORDER_TAKER = ", ".join([
    dbl("SUM(revenue)", "revenue"), big("SUM(trx)", "trx"), big("SUM(total_msisdn)", "unique_taker"),
])
BORDER_WL = ", ".join(
    [big("SUM(total_msisdn)", "total_target"), big("SUM(msisdn_delivered)", "total_delivered")]
)
ALL_CAMPAIGNS = """(SELECT * REPLACE (CASE WHEN wltype ILIKE '%rulebased%' THEN 'RULEBASED'
    ELSE 'REGULER' END AS wltype) FROM summary)"""


def wl_by_attribute(attribute: str, tags: str = "") -> str:
    return f"""SELECT {tags} strmonth, offer_id, {attribute}, COUNT(*) AS total_msisdn,
               COUNT(msisdn_delivered) AS msisdn_delivered
        FROM (SELECT strmonth, offer_id, msisdn_wl, MAX(msisdn_delivered) AS msisdn_delivered
              FROM wl GROUP BY ALL) LEFT JOIN dim ON msisdn_wl = msisdn
        GROUP BY strmonth, offer_id, {attribute}"""


def taker_by_attribute(attribute: str, name: str, tags: str = "") -> str:
    return f"""SELECT {tags} strmonth, offer_id, {attribute} AS {name}, {TAKER_SUMS}
        FROM taker LEFT JOIN dim USING (msisdn) GROUP BY strmonth, offer_id, {attribute}"""


def all_levels(by_attribute) -> str:
    return " UNION ALL ".join(
        f"({by_attribute(level)})" for level in ("area_sales", "kabupaten", "region_sales")
    )


USAGE_YEARS = "SELECT *, CAST(year(date) AS INTEGER) AS year FROM usage"
TAG_IDS = "(101, 103, 201, 202, 998, 301, 302, 999)"


def tag_filter(kind: str, column: str, other: int) -> str:
    chosen = f"SELECT name FROM tags WHERE id IN {TAG_IDS} AND tag = '{kind}'"
    return f"""({column} IN ({chosen}) OR NOT EXISTS ({chosen})
        OR ({other} IN {TAG_IDS} AND {column} IS NULL))"""


APP = """id, vendor_name, asset_name, description, tag_category, tag_function_application,
    tag_db_system"""
WITH_TAG_IDS = """(SELECT a.*, c.id AS tag_category_id, f.id AS tag_function_application_id,
        d.id AS tag_db_system_id FROM app a
    LEFT JOIN tags c ON c.tag = 'category' AND c.name = a.tag_category
    LEFT JOIN tags f ON f.tag = 'function' AND f.name = a.tag_function_application
    LEFT JOIN tags d ON d.tag = 'db_system' AND d.name = a.tag_db_system)"""
TAG_COUNTS = """SELECT t.id, t.tag, t.name, COUNT(*) AS count FROM app a
    JOIN tags t ON t.name = a.tag_category OR t.name = a.tag_function_application
         OR t.name = a.tag_db_system GROUP BY ALL"""
TAG_COUNTS_OTHER = f"""SELECT * FROM ({TAG_COUNTS})
    UNION ALL SELECT 997, 'category', 'Other Category', COUNT(*) FROM app
              WHERE tag_category IS NULL HAVING COUNT(*) > 0
    UNION ALL SELECT 998, 'function', 'Other Function', COUNT(*) FROM app
              WHERE tag_function_application IS NULL HAVING COUNT(*) > 0
    UNION ALL SELECT 999, 'db_system', 'Other DB System', COUNT(*) FROM app
              WHERE tag_db_system IS NULL HAVING COUNT(*) > 0"""


def matrix(column: str) -> str:
    return f"""SELECT c.category, m.{column}, COUNT(p.id) AS count
        FROM (SELECT DISTINCT category FROM portfolio) c
        CROSS JOIN (SELECT DISTINCT {column} FROM portfolio WHERE {column} IS NOT NULL) m
        LEFT JOIN portfolio p ON p.category = c.category AND p.{column} = m.{column}
        GROUP BY ALL"""


FOLDED = """SELECT MAX(status_division) AS status_division,
        string_agg(no, chr(10) ORDER BY place) AS no,
        string_agg(asset_owner_role, chr(10) ORDER BY place) AS asset_owner_role,
        string_agg(description, chr(10) ORDER BY place) AS description,
        string_agg(remark_2_g_4_g, chr(10) ORDER BY place) AS remark_2_g_4_g, MIN(place) AS place
    FROM records GROUP BY record"""


def clean(column: str) -> str:
    return f"""CASE WHEN NOT regexp_full_match({column}, '\\s*') AND {column} <> '-'
        THEN trim(regexp_replace({column}, '\\s+', ' ', 'g')) END"""


INGESTED = f"""SELECT CAST(row_number() OVER (ORDER BY place) AS INTEGER) AS id,
    {", ".join(f"{clean(c)} AS {c}" for c in
               ("status_division", "asset_owner_role", "description", "remark_2_g_4_g"))}
    FROM ({FOLDED})"""

PLACED = "* REPLACE (place[1] || ':' || place[2] AS place)"
TOP_MTD = top_level(True, "d_date, ", *MTD_FACTS)
WL_BORDER = all_levels(
    lambda level: f"SELECT '{level}' AS level, * RENAME ({level} AS border) FROM "
    f"({wl_by_attribute(level, RUN_D_DATE + ',')})"
)
TAKER_BORDER = all_levels(
    lambda level: taker_by_attribute(level, "border", f"'{level}' AS level, {RUN_DATA_DATE},")
)

_BODIES = {
    "replace_mtd": f"SELECT * FROM ({TOP_MTD}) WHERE strmonth <> DATE '1998-05-01'",
    "sync_summary_channel": f"""SELECT * FROM ({channel("", WL_NOW, TAKER_LATE.format(1), False)})
        WHERE strmonth = DATE '1997-03-01'""",
    "sync_top_main_level_mtd": f"""SELECT * FROM ({TOP_MTD})
        WHERE d_date IN (DATE '1997-03-31', DATE '1997-04-30')""",
    "load_wl_border": WL_BORDER,
    "load_taker_border": TAKER_BORDER,
    "soft_delete_stored": """SELECT id, is_deleted OR id = 99 AS is_deleted,
        CASE WHEN id = 99 THEN TIMESTAMP '2001-08-20 12:00:00' ELSE deleted_at END AS deleted_at,
        COALESCE(CASE tag_category WHEN 'ECONOMY' THEN 'Economy' WHEN 'SMALL' THEN 'Small'
                 ELSE tag_category END, 'Other Category') AS tag_category,
        COALESCE(tag_db_system, 'Other DB System') AS tag_db_system, false AS is_public_facing
        FROM app""",
    "campaign_summary_extract": f"SELECT {RUN_D_DATE}, {RAW_CAMPAIGN} FROM campaign",
    "campaign_summary_clean": f"SELECT {FLAT_CAMPAIGN} FROM campaign",
    "campaign_month_listing": f"SELECT {RAW_CAMPAIGN} FROM campaign",
    "wl_by_offer": f"""SELECT {RUN_D_DATE}, strmonth, offer_id,
        COUNT(DISTINCT msisdn_wl) AS msisdn_wl, COUNT(DISTINCT msisdn_delivered) AS msisdn_delivered
        FROM wl GROUP BY strmonth, offer_id""",
    "wl_total_by_offer": f"""SELECT {RUN_DATA_DATE}, strmonth, offer_id,
        COUNT(DISTINCT msisdn_wl) AS total_wl FROM wl GROUP BY strmonth, offer_id""",
    "wl_border": WL_BORDER,
    "wl_kabupaten": wl_by_attribute("kabupaten"),
    "wl_region": wl_by_attribute("region_sales"),
    "wl_los": wl_by_attribute("los", RUN_D_DATE + ","),
    "wl_recurring": f"""SELECT {RUN_D_DATE}, strmonth, start_date, total_offer,
        COUNT(DISTINCT msisdn_wl) AS recurring_msisdn
        FROM (SELECT strmonth, start_date, msisdn_wl, COUNT(DISTINCT offer_id) AS total_offer
              FROM wl GROUP BY ALL) GROUP BY strmonth, start_date, total_offer""",
    "wl_recurring_kabupaten": f"""SELECT {RUN_D_DATE}, strmonth, start_date, kabupaten, total_offer,
        COUNT(DISTINCT msisdn_wl) AS recurring_msisdn
        FROM (SELECT strmonth, start_date, kabupaten, msisdn_wl,
                     COUNT(DISTINCT offer_id) AS total_offer
              FROM wl LEFT JOIN dim ON msisdn_wl = msisdn GROUP BY ALL)
        GROUP BY strmonth, start_date, kabupaten, total_offer""",
    "wl_first_touch_attribution": """SELECT strmonth, offer_id, COUNT(msisdn_wl) AS total_msisdn
        FROM (SELECT *, row_number() OVER (PARTITION BY strmonth, msisdn_wl
                                           ORDER BY start_date, offer_id) AS place FROM wl)
        WHERE place = 1 GROUP BY strmonth, offer_id""",
    "taker_by_tower": f"""SELECT {RUN_DATA_DATE}, strmonth, tower_name, {TAKER_SUMS} FROM taker
        WHERE tower_name IN {CORE} GROUP BY strmonth, tower_name
        UNION ALL SELECT {RUN_DATA_DATE}, strmonth, 'ALL', {TAKER_SUMS} FROM taker
        WHERE tower_name IN {CORE} GROUP BY strmonth""",
    "taker_by_offer": f"""SELECT {RUN_DATA_DATE}, strmonth, offer_id, {TAKER_SUMS} FROM taker
        WHERE tower_name IN {CORE} GROUP BY strmonth, offer_id""",
    "taker_border": TAKER_BORDER,
    "taker_kabupaten": taker_by_attribute("kabupaten", "kabupaten"),
    "taker_region": taker_by_attribute("region_sales", "region_sales"),
    "taker_los": taker_by_attribute("los", "los", RUN_D_DATE + ","),
    "tur_formulation": """SELECT strmonth, tower, campaign_initiatives, start_date, end_date,
        communication_channel, totalcid, total_wl, total_wl AS eligible_wl, delivered, taker,
        CAST(trx AS BIGINT) AS trx, CAST(rev AS DOUBLE) AS rev, offer_id, campaign_id, wltype,
        email_user, tur, d_date FROM tur""",
    "summary_channel": channel("", WL_NOW, TAKER_LATE.format(1), known=False),
    "summary_channel_mtd": channel("d_date, ", *MTD_FACTS, known=True),
    "summary_product": product("", WL_NOW, TAKER_LATE.format(1)),
    "summary_product_all": product("", WL_NOW, TAKER_LATE.format(1), "LEFT JOIN"),
    "summary_product_mtd": product("d_date, ", *MTD_FACTS),
    "summary_kabupaten": kabupaten(""),
    "summary_kabupaten_mtd": kabupaten("d_date, "),
    "top_main_level": top_level(False, "", WL_NOW, TAKER_LATE.format(2)),
    "top_main_level_mtd": top_level(True, "d_date, ", *MTD_FACTS),
    "top_main_level_l1": top_level_l1(
        "strmonth", (*SETS, LEAF), WL_NOW, TAKER_LATE.format(2), nulls_equal=True
    ),
    "top_main_level_l1_mtd": top_level_l1(
        "d_date, strmonth", (LEAF,), WL_NOW, TAKER_NOW, nulls_equal=False
    ),
    "border_taker": borders("", "taker_border", BORDER_TAKER),
    "border_taker_mtd": borders("d_date, ", "taker_border", BORDER_TAKER),
    "border_wl": borders("", "wl_border", BORDER_WL),
    "border_wl_mtd": borders("d_date, ", "wl_border", BORDER_WL),
    "border_wl_all_snapshots": borders("", "wl_border", BORDER_WL, ALL_CAMPAIGNS),
    "run_dates": """SELECT DISTINCT day AS run_date, day AS extract_date, day - 2 AS data_date,
        CAST(date_trunc('month', day - 2) AS DATE) AS strmonth,
        CAST(date_trunc('month', day - 2) AS DATE) AS wl_dim_date,
        CAST(date_trunc('month', day) AS DATE) - 1 AS taker_dim_date
        FROM (SELECT CAST(o_orderdate AS DATE) AS day FROM orders)""",
    "latest_snapshot": """SELECT extract_date, d_date, strmonth, offer_id, communication_channel
        FROM base""",
    "latest_snapshot_tolerant": f"""SELECT extract_date, data_date, strmonth, offer_id, total_msisdn,
        CAST(trx AS BIGINT) AS trx, CAST(revenue AS DOUBLE) AS revenue
        FROM ({TAKER_LATE.format(2)})""",
    "lagged_snapshot": LAGGED.format("wl_offer"),
    "replace_partition": f"""SELECT * REPLACE (CAST(active_user_count
            + CASE WHEN year IN (1996, 1997) THEN 1 ELSE 0 END AS INTEGER) AS active_user_count)
        FROM ({USAGE_YEARS}) WHERE year <> 1998""",
    "border_tables": f"""SELECT * EXCLUDE (level, border), border AS kabupaten
        FROM ({borders("", "taker_border", BORDER_TAKER)}) WHERE level = 'kabupaten'""",
    "stage_and_replace": f"""SELECT DATE '2001-09-02' AS extract_date,
               DATE '2001-08-31' AS data_date, strmonth, offer_id, {TAKER_SUMS}
        FROM taker WHERE tower_name IN {CORE} GROUP BY strmonth, offer_id
        UNION ALL SELECT {RUN_DATA_DATE}, strmonth, offer_id, {TAKER_SUMS}
        FROM taker GROUP BY strmonth, offer_id""",
    "csv_round_trip": f"SELECT {RUN_D_DATE}, {FLAT_CAMPAIGN} FROM campaign",
    "sync_by_key": f"""SELECT * REPLACE (CAST(active_user_count
            + CASE WHEN year = 1999 THEN 1 ELSE 0 END AS INTEGER) AS active_user_count)
        FROM ({USAGE_YEARS})""",
    "sync_append": f"""{USAGE_YEARS} UNION ALL
        SELECT * FROM ({USAGE_YEARS}) WHERE year = 1999""",
    "sync_upsert": f"""SELECT * REPLACE (CAST(active_user_count
            + CASE WHEN year = 1999 AND active_user_count > 1 THEN 1 ELSE 0 END AS INTEGER)
              AS active_user_count)
        FROM ({USAGE_YEARS})""",
    "available_dates": "SELECT DISTINCT extract_date FROM summary",
    "non_empty_check": f"""SELECT strmonth, offer_id, {TAKER_SUMS} FROM taker
        WHERE tower_name IN {CORE} GROUP BY strmonth, offer_id""",
    "catalog_search": f"""SELECT DISTINCT {APP}, tag_category_id, tag_function_application_id,
        tag_db_system_id, is_deleted, deleted_at, status, decline_time FROM {WITH_TAG_IDS}
        WHERE NOT is_deleted AND status = 'Live'
          AND (vendor_name ILIKE '%B%' OR asset_name ILIKE '%B%')
          AND {tag_filter("category", "tag_category", 997)}
          AND {tag_filter("function", "tag_function_application", 998)}
          AND {tag_filter("db_system", "tag_db_system", 999)}""",
    "catalog_search_all": f"""SELECT DISTINCT {APP}, tag_category_id, tag_function_application_id,
        tag_db_system_id, is_deleted, deleted_at FROM {WITH_TAG_IDS} WHERE NOT is_deleted""",
    "catalog_review": f"""SELECT DISTINCT {APP}, is_deleted, deleted_at,
        COALESCE(status, 'On Review') AS status, decline_time FROM app
        WHERE NOT is_deleted AND (vendor_name ILIKE '%ed%' OR asset_name ILIKE '%ed%')
          AND (status IS NULL OR status = 'On Review' OR (status = 'Declined'
               AND decline_time >= TIMESTAMP '2001-08-20 12:00:00' - INTERVAL 24 HOUR))""",
    "tag_counts": TAG_COUNTS,
    "tag_counts_with_other": TAG_COUNTS_OTHER,
    "tag_group_total": f"SELECT COUNT(*) AS total FROM ({TAG_COUNTS_OTHER})",
    "app_details": """SELECT id, asset_name, vendor_name, apps_owner_pic, owner_phone_number, tsa,
        COALESCE(status, 'On Review') AS status, version, description, principle, is_deleted,
        deleted_at, decline_time,
        concat_ws('|', tag_db_system, tag_function_application, tag_category) AS tags
        FROM app WHERE id = 53""",
    "tag_list": "SELECT id, tag, name FROM tags WHERE tag = 'function'",
    "normalize_tags": """SELECT id, vendor_name, asset_name, description,
        COALESCE(CASE tag_category WHEN 'ECONOMY' THEN 'Economy' WHEN 'SMALL' THEN 'Small'
                 ELSE tag_category END, 'Other Category') AS tag_category,
        COALESCE(tag_function_application, 'Other Function') AS tag_function_application,
        COALESCE(tag_db_system, 'Other DB System') AS tag_db_system FROM app""",
    "soft_delete": """SELECT id, is_deleted OR id = 99 AS is_deleted,
        CASE WHEN id = 99 THEN TIMESTAMP '2001-08-20 12:00:00' ELSE deleted_at END AS deleted_at
        FROM app""",
    "install_type_summary": """SELECT install_type, COUNT(*) AS total_apps FROM portfolio
        GROUP BY ALL""",
    "category_manufacturer_summary": """SELECT category, manufacturer, COUNT(*) AS total_apps
        FROM portfolio GROUP BY ALL""",
    "category_version_status_summary": """SELECT category, version_age_status,
        COUNT(*) AS total_apps FROM portfolio GROUP BY ALL""",
    "category_manufacturer_matrix": matrix("manufacturer"),
    "category_version_status_matrix": matrix("version_age_status"),
    "top10_active_users": """SELECT application_name AS value,
        CAST(SUM(total_active_users) AS BIGINT) AS total_active_users
        FROM portfolio GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "apps_count_by": "SELECT manufacturer AS value, COUNT(*) AS count FROM portfolio GROUP BY 1",
    "filters_by_context": """SELECT c_name AS name, 'Customer ' || c_custkey AS display_name
        FROM customer WHERE c_mktsegment = 'MACHINERY'""",
    "top10_filters": """SELECT c_name AS name, 'Customer ' || c_custkey AS display_name
        FROM customer WHERE c_mktsegment = 'HOUSEHOLD'""",
    "distinct_manufacturers": """SELECT DISTINCT manufacturer FROM portfolio
        WHERE manufacturer IS NOT NULL""",
    "portfolio_listing": """SELECT f.*, CASE WHEN p_retailprice < 950 THEN 'Business App'
            ELSE 'Infrastructure' END AS application_type,
        split_part(p_name, ' ', 1) AS business_process, split_part(p_name, ' ', 2) AS business_unit
        FROM portfolio f JOIN part ON p_partkey = id""",
    "usage_listing": """SELECT CAST(application_portfolio_id AS BIGINT) * 10000 + year(date) * 12
        - 23900 + month(date) AS id, application_portfolio_id, p_name AS application_name,
        active_user_count, date FROM usage JOIN part ON p_partkey = application_portfolio_id""",
    "request_store_relation": """SELECT l_orderkey AS application_request_id,
        o_orderpriority AS asset_name, l_suppkey AS data_management_store_id, s_name AS store_name
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             JOIN supplier ON l_suppkey = s_suppkey""",
    "schema_evolve": """SELECT *, false AS is_public_facing, false AS is_contain_pii_data,
        CAST(NULL AS VARCHAR) AS pii_data_description, CAST(NULL AS VARCHAR) AS requester_name,
        CAST(NULL AS VARCHAR) AS requester_department, CAST(NULL AS VARCHAR) AS requester_nik,
        CAST(NULL AS VARCHAR) AS apps_custody_pic, CAST(NULL AS VARCHAR) AS asset_objective,
        CAST(NULL AS VARCHAR) AS sustain_reason,
        CAST(NULL AS VARCHAR) AS public_facing_data_sharing_target,
        CAST(NULL AS DATE) AS start_period, CAST(NULL AS VARCHAR) AS apps_development_pic
        FROM app""",
    "fk_check": """SELECT COUNT(*) AS violations FROM part
        WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem)""",
    "next_ids": """SELECT (SELECT MAX(p_partkey) FROM part)
            + row_number() OVER (ORDER BY conv_id, turn) AS id,
        CASE WHEN turn = 0 THEN 'Division ' || conv_id END AS no,
        CASE WHEN role <> 'system' THEN role END AS role, text, conv_id || ':' || turn AS place
        FROM conversations""",
    "snake_case_columns": f"SELECT {PLACED} FROM sheet",
    "clean_nulls": f"""SELECT CAST(doc_id AS INTEGER) AS id, {clean("text")} AS text,
        {clean("lang")} AS lang, {clean("source")} AS source FROM documents""",
    "fold_rows_status_division": f"SELECT {PLACED} FROM ({FOLDED})",
    "fold_rows_no": f"""SELECT {PLACED} FROM (SELECT MAX(status_division) AS no,
        string_agg(asset_owner_role, chr(10) ORDER BY place) AS role,
        string_agg(description, chr(10) ORDER BY place) AS text, MIN(place) AS place
        FROM records GROUP BY record)""",
    "surrogate_id": f"""SELECT {PLACED} FROM (SELECT row_number() OVER (ORDER BY place) AS id, status_division AS no,
        asset_owner_role AS role, description AS text, place FROM sheet)""",
    "column_lengths": """SELECT column_name, max_length, max_length > 255 AS too_long
        FROM (UNPIVOT (SELECT CAST(MAX(length(text)) AS INTEGER) AS text,
                              CAST(MAX(length(lang)) AS INTEGER) AS lang,
                              CAST(MAX(length(source)) AS INTEGER) AS source FROM documents)
              ON text, lang, source INTO NAME column_name VALUE max_length)""",
    "column_types": f"""SELECT column_name, max_length, max_length > 255 AS too_long,
        CASE column_name WHEN 'description' THEN 'string' ELSE 'varchar(255)' END AS data_type
        FROM (UNPIVOT (SELECT {", ".join(f"CAST(MAX(length({c})) AS INTEGER) AS {c}" for c in
              ("status_division", "asset_owner_role", "description", "remark_2_g_4_g"))}
              FROM ({INGESTED}))
              ON status_division, asset_owner_role, description, remark_2_g_4_g
              INTO NAME column_name VALUE max_length)""",
    "catalog_ingest": INGESTED,
    "catalog_reload": INGESTED,
    "taker_last_contact": """SELECT t.msisdn, t.offer_id, t.take_date, w.start_date AS contact_date,
        w.contact_offer, CAST(t.take_date - w.start_date AS INTEGER) AS days_since
        FROM taker t ASOF LEFT JOIN (
            SELECT msisdn_wl, start_date, MAX(offer_id) AS contact_offer FROM wl GROUP BY ALL
        ) w ON t.msisdn = w.msisdn_wl AND t.take_date >= w.start_date""",
    "takers_in_campaign": """SELECT c.offer_id, c.campaign_id, c.start_date, c.end_date,
        c.communication_channel, COUNT(*) AS takers, COUNT(DISTINCT t.msisdn) AS uni_taker,
        CAST(SUM(t.trx) AS BIGINT) AS trx
        FROM taker t JOIN campaign c
            ON t.offer_id = c.offer_id AND t.take_date BETWEEN c.start_date AND c.end_date
        GROUP BY ALL""",
    "reach_by_period": """WITH hashed AS (
            SELECT start_date, md5(CAST(msisdn_wl AS VARCHAR)) AS h FROM wl
        ), ranked AS (
            SELECT unnest(['day', 'month', 'all']) AS level,
                unnest([start_date, CAST(date_trunc('month', start_date) AS DATE), NULL]) AS period,
                substr(h, 1, 3) AS register, CAST('0x' || substr(h, 4, 13) AS BIGINT) AS rest
            FROM hashed
        ), registers AS (
            SELECT level, period, register,
                MAX(CASE WHEN rest > 0 THEN 53 - length(bin(rest)) ELSE 53 END) AS rank
            FROM ranked GROUP BY ALL
        ), sums AS (
            SELECT level, period, COUNT(*) AS met,
                0.7213::DOUBLE / (1 + 1.079::DOUBLE / 4096) * 4096 * 4096
                    / (4096 - COUNT(*) + SUM(pow(2.0::DOUBLE, -rank))) AS raw
            FROM registers GROUP BY ALL
        )
        SELECT level, period, CAST(round(CASE WHEN raw <= 10240 AND met < 4096
            THEN 4096::DOUBLE * ln(4096::DOUBLE / (4096 - met)) ELSE raw END) AS BIGINT) AS reach
        FROM sums""",
    "attribute_counts": """SELECT key, value, COUNT(*) AS apps FROM (
            SELECT unnest(['vendor', 'category', 'status']) AS key,
                unnest([vendor_name, tag_category, status]) AS value
            FROM app WHERE id % 50 <> 0
        ) WHERE value IS NOT NULL GROUP BY ALL
        UNION ALL SELECT NULL, NULL, COUNT(*) FROM app WHERE id % 50 = 0 HAVING COUNT(*) > 0""",
    "contact_sessions": """WITH daily AS (
            SELECT msisdn_wl AS msisdn, start_date, COUNT(*) AS n FROM wl GROUP BY ALL
        ), begun AS (
            SELECT *, CASE WHEN start_date - lag(start_date) OVER k <= 14 THEN 0 ELSE 1 END AS begins
            FROM daily WINDOW k AS (PARTITION BY msisdn ORDER BY start_date)
        ), numbered AS (
            SELECT *, SUM(begins) OVER (PARTITION BY msisdn ORDER BY start_date) AS session FROM begun
        )
        SELECT msisdn, MIN(start_date) AS first_day, MAX(start_date) AS last_day, COUNT(*) AS days,
            CAST(SUM(n) AS BIGINT) AS rows
        FROM numbered GROUP BY msisdn, session""",
    "whitelist_changes": """WITH counted AS (
            SELECT strmonth, offer_id, msisdn_wl, msisdn_delivered,
                SUM(CASE WHEN d_date = last_day(strmonth) THEN 1 ELSE -1 END) AS n
            FROM wl_offer GROUP BY ALL HAVING n <> 0
        )
        SELECT strmonth, offer_id, msisdn_wl, msisdn_delivered,
            CASE WHEN n > 0 THEN 'added' ELSE 'removed' END AS change,
            CAST(abs(n) AS BIGINT) AS copies,
            MAX(n) OVER k * MIN(n) OVER k < 0 AS updated
        FROM counted WINDOW k AS (PARTITION BY strmonth, offer_id)""",
    "offer_rolling_reach": """WITH daily AS (
            SELECT offer_id, start_date AS day, list(DISTINCT msisdn_wl) AS members, COUNT(*) AS n
            FROM wl GROUP BY ALL
        )
        SELECT a.offer_id, a.day,
            CAST(length(list_distinct(flatten(list(b.members)))) AS BIGINT) AS reach,
            CAST(SUM(b.n) AS BIGINT) AS rows
        FROM daily a JOIN daily b ON a.offer_id = b.offer_id AND b.day BETWEEN a.day - 6 AND a.day
        GROUP BY a.offer_id, a.day""",
    "days_since_contact": """SELECT msisdn_wl AS msisdn, start_date, COUNT(*) AS rows,
            start_date - lag(start_date) OVER (PARTITION BY msisdn_wl ORDER BY start_date) AS days_since
        FROM wl GROUP BY msisdn_wl, start_date""",
    "taker_windows": """WITH placed AS (
            SELECT offer_id, trx, DATE '1970-01-01'
                + CAST(7 * ((take_date - DATE '1970-01-01') // 7 - before) AS INTEGER) AS first_day
            FROM taker, (SELECT unnest([0, 1]) AS before)
        )
        SELECT first_day, first_day + 14 AS end_day, offer_id, COUNT(*) AS rows,
            CAST(SUM(trx) AS BIGINT) AS trx
        FROM placed GROUP BY ALL""",
    "first_touch_credit": """SELECT last_day(start_date) AS month_end, offer_id,
            COUNT(msisdn_wl) AS subscribers
        FROM (SELECT *, row_number() OVER (PARTITION BY last_day(start_date), msisdn_wl
                                           ORDER BY start_date, offer_id) AS place FROM wl)
        WHERE place = 1 GROUP BY ALL""",
}

ORACLES = {name: with_ctes(body) for name, body in _BODIES.items()}
