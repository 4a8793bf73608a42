"""The derivations of ``lens`` as SQL common table expressions."""

from __future__ import annotations

import re

CTES = {
    "facts": """
        SELECT l.*, l_suppkey AS offer_id, o_custkey AS msisdn, o_orderpriority,
               CAST(o_orderdate AS DATE) AS day,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS strmonth
        FROM lineitem l JOIN orders ON l_orderkey = o_orderkey""",
    "wl": """
        SELECT strmonth, offer_id, msisdn AS msisdn_wl,
               CASE WHEN l_returnflag <> 'R' THEN msisdn END AS msisdn_delivered,
               day AS start_date
        FROM facts""",
    "taker": """
        SELECT strmonth, offer_id, msisdn, CAST(l_quantity AS BIGINT) AS trx,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'SIMPATI' WHEN '2-HIGH' THEN 'HALO'
                    WHEN '3-MEDIUM' THEN 'AREA' WHEN '4-NOT SPECIFIED' THEN 'OTHERS'
                    WHEN '5-LOW' THEN 'BYU' END AS tower_name,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(1 - l_discount AS DECIMAL(4,2))
                    AS DECIMAL(18,4)) AS revenue,
               day + l_linenumber AS take_date
        FROM facts WHERE l_linestatus = 'F'""",
    "dim": """
        SELECT c_custkey AS msisdn, n_name AS kabupaten, r_name AS region_sales,
               CASE WHEN r_regionkey < 2 THEN 'WEST' ELSE 'EAST' END AS area_sales,
               c_mktsegment AS los
        FROM customer JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey""",
    "offer_rows": """
        SELECT *, CAST(right(s_name, 1) AS INTEGER) AS digit,
               unnest(CASE WHEN s_acctbal < 1500 THEN ['SMS', 'WABA']
                           WHEN s_acctbal < 4000 THEN ['SMS'] WHEN s_acctbal < 6000 THEN ['WABA']
                           WHEN s_acctbal < 8000 THEN ['APP'] ELSE [NULL] END)
                   AS communication_channel
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "months": """
        SELECT CAST(unnest(generate_series(date_trunc('month', MIN(o_orderdate)),
                                           date_trunc('month', MAX(o_orderdate)),
                                           INTERVAL 1 MONTH)) AS DATE) AS strmonth
        FROM orders""",
    "campaign": """
        SELECT strmonth, s_suppkey AS offer_id, 'C' || s_suppkey AS campaign_id,
               ['SIMPATI', 'HALO', 'AREA', 'OTHERS', 'BYU'][n_regionkey + 1] AS tower,
               n_name AS product,
               CASE WHEN s_acctbal <= 9500 THEN CASE WHEN s_acctbal > 7000 THEN ' ' ELSE '' END
                    || 'Initiative' || chr(9) || digit END AS campaign_initiatives,
               least(strmonth + digit * 10 // 3, last_day(strmonth)) AS start_date,
               last_day(strmonth) AS end_date, communication_channel,
               CAST(s_nationkey AS VARCHAR) AS id_campaign_objective,
               CAST(n_regionkey AS VARCHAR) AS id_campaign_category,
               CASE WHEN s_acctbal < 0 THEN 'DEBT' ELSE 'CREDIT' END AS camp_category,
               CASE WHEN digit < 3 THEN 'RuleBased-A' WHEN digit < 7 THEN 'reguler' END AS wltype,
               'S' || digit AS sender_initial_bc,
               'user' || s_suppkey || chr(10) || '@example.com' AS email_user,
               strmonth AS date_initial_bc, 'BAU' AS catcamp
        FROM offer_rows CROSS JOIN months""",
    "summary": """
        SELECT c.*, last_day(strmonth) + o.days AS d_date,
               last_day(strmonth) + o.days + 2 AS extract_date
        FROM campaign c JOIN (VALUES (-2), (0)) o(days)
             ON c.start_date <= last_day(c.strmonth) + o.days""",
    "wl_copies": """
        SELECT w.*, last_day(strmonth) + o.days AS d_date,
               last_day(strmonth) + o.days + 2 AS extract_date
        FROM wl w JOIN (VALUES (-2), (0)) o(days)
             ON w.start_date <= last_day(w.strmonth) + o.days""",
    "wl_offer": """
        SELECT extract_date, d_date, strmonth, offer_id,
               COUNT(DISTINCT msisdn_wl) AS msisdn_wl,
               COUNT(DISTINCT msisdn_delivered) AS msisdn_delivered
        FROM wl_copies GROUP BY ALL""",
    "taker_copies": """
        SELECT t.*, last_day(strmonth) + o.days AS data_date,
               last_day(strmonth) + o.days + 2 AS extract_date, o.days
        FROM taker t JOIN (VALUES (-2), (0), (1), (2)) o(days)
             ON t.take_date <= last_day(t.strmonth) + o.days""",
    "taker_offer": """
        SELECT extract_date, data_date, strmonth, offer_id,
               COUNT(DISTINCT msisdn) AS total_msisdn, SUM(trx) AS trx, SUM(revenue) AS revenue
        FROM taker_copies GROUP BY ALL""",
    "wl_dedup": """
        SELECT extract_date, d_date, strmonth, offer_id, msisdn_wl,
               MAX(msisdn_delivered) AS msisdn_delivered
        FROM wl_copies GROUP BY ALL""",
    "wl_border": """
        SELECT level, extract_date, d_date, strmonth, offer_id, border,
               COUNT(*) AS total_msisdn, COUNT(msisdn_delivered) AS msisdn_delivered
        FROM (SELECT w.*, unnest(['area_sales', 'kabupaten', 'region_sales']) AS level,
                     unnest([area_sales, kabupaten, region_sales]) AS border
              FROM wl_dedup w LEFT JOIN dim ON msisdn_wl = msisdn)
        GROUP BY ALL""",
    "taker_border": """
        SELECT level, extract_date, data_date, strmonth, offer_id, border,
               COUNT(DISTINCT msisdn) AS total_msisdn, SUM(trx) AS trx, SUM(revenue) AS revenue
        FROM (SELECT t.*, unnest(['area_sales', 'kabupaten', 'region_sales']) AS level,
                     unnest([area_sales, kabupaten, region_sales]) AS border
              FROM taker_copies t LEFT JOIN dim USING (msisdn) WHERE days <= 0)
        GROUP BY ALL""",
    "newest": """
        SELECT strmonth, MAX(extract_date) AS extract_date, MAX(d_date) AS d_date
        FROM summary GROUP BY strmonth""",
    "base": """
        SELECT s.* REPLACE (CASE WHEN wltype ILIKE '%rulebased%' THEN 'RULEBASED'
                                 ELSE 'REGULER' END AS wltype)
        FROM summary s SEMI JOIN newest USING (strmonth, extract_date)""",
    "tur_rows": """
        SELECT s.strmonth, s.offer_id, s.campaign_id, s.tower,
               TRIM(s.campaign_initiatives) AS campaign_initiatives, s.start_date, s.end_date,
               s.communication_channel, s.wltype, s.email_user, s.d_date,
               COUNT(DISTINCT s.offer_id) AS totalcid
        FROM summary s SEMI JOIN newest n ON s.strmonth = n.strmonth AND s.d_date = n.d_date
        GROUP BY ALL""",
    "tur_pairs": """
        SELECT r.*, CAST(w.msisdn_wl AS DOUBLE) AS total_wl,
               CAST(CASE WHEN w.msisdn_delivered <> 0 THEN w.msisdn_delivered
                         ELSE w.msisdn_wl END AS DOUBLE) AS delivered,
               CAST(t.total_msisdn AS DOUBLE) AS taker, t.trx, t.revenue AS rev
        FROM tur_rows r
        LEFT JOIN wl_offer w ON w.strmonth = r.strmonth AND w.offer_id = r.offer_id
             AND w.d_date = r.d_date
        LEFT JOIN taker_offer t ON t.strmonth = r.strmonth AND t.offer_id = r.offer_id
             AND t.data_date IN (r.d_date, r.d_date + 1)""",
    "tur_raw": """
        SELECT *, CASE WHEN NOT (taker > 0 AND delivered > 0) THEN NULL
                       WHEN delivered > taker THEN taker / delivered
                       WHEN delivered < taker THEN taker / total_wl END AS raw
        FROM tur_pairs""",
    "tur": """
        SELECT * EXCLUDE (raw, wltype), CASE WHEN raw >= 0.3 THEN 0.01 ELSE raw END AS tur,
               CASE WHEN wltype ILIKE '%rulebased%' THEN 'RULEBASED' ELSE 'REGULER' END AS wltype
        FROM tur_raw""",
    "app": """
        SELECT CAST(p_partkey AS INTEGER) AS id, p_brand AS vendor_name, p_name AS asset_name,
               p_type || ' ' || p_name AS description,
               CASE WHEN p_size > 4 THEN p_type END AS tag_category,
               CASE WHEN p_size < 40 THEN split_part(p_name, ' ', 1) END
                   AS tag_function_application,
               CASE WHEN p_size < 20 OR p_size > 30 THEN split_part(p_name, ' ', 2) END
                   AS tag_db_system,
               CASE WHEN p_size <= 20 THEN 'Live' WHEN p_size <= 30 THEN 'On Review'
                    WHEN p_size <= 40 THEN 'Declined' END AS status,
               p_retailprice > 980 AS is_deleted,
               CASE WHEN p_retailprice > 980 THEN TIMESTAMP '2001-01-01 00:00:00' END
                   AS deleted_at,
               CASE WHEN p_size > 30 AND p_size <= 40
                    THEN CAST(DATE '2001-08-01' + (p_size - 16) AS TIMESTAMP) END AS decline_time,
               'pic ' || p_brand AS apps_owner_pic, CAST(NULL AS VARCHAR) AS owner_phone_number,
               CAST(NULL AS VARCHAR) AS tsa, '1' AS version, p_type AS principle
        FROM part""",
    "tags": """
        SELECT CAST(start + row_number() OVER (PARTITION BY tag ORDER BY name) AS INTEGER) AS id,
               tag, name
        FROM (SELECT DISTINCT 100 AS start, 'category' AS tag, tag_category AS name FROM app
              UNION ALL
              SELECT DISTINCT 200, 'function', tag_function_application FROM app
              UNION ALL
              SELECT DISTINCT 300, 'db_system', tag_db_system FROM app)
        WHERE name IS NOT NULL""",
    "portfolio": """
        SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS application_name, p_type AS category,
               CASE WHEN p_size < 30 THEN 'Cloud' ELSE 'On Premise' END AS install_type,
               p_size AS total_active_users,
               CASE WHEN p_size < 20 THEN 'Current' WHEN p_size < 40 THEN '1 Version Behind'
                    WHEN p_size < 48 THEN 'Old Versions' END AS version_age_status,
               CASE WHEN p_size <= 45 THEN p_brand END AS manufacturer
        FROM part""",
    "usage": """
        SELECT CAST(l_partkey AS INTEGER) AS application_portfolio_id,
               last_day(CAST(l_shipdate AS DATE)) AS date,
               CAST(COUNT(*) AS INTEGER) AS active_user_count
        FROM lineitem GROUP BY ALL""",
    "sheet": """
        SELECT CASE WHEN turn = 0 THEN 'Division ' || conv_id END AS status_division,
               CAST(conv_id AS VARCHAR) AS no,
               CASE WHEN role <> 'system' THEN role END AS asset_owner_role, text AS description,
               CASE turn WHEN 1 THEN '-' WHEN 2 THEN '  ' ELSE 'a ' || chr(9) || ' b' END
                   AS remark_2_g_4_g,
               [conv_id, turn] AS place
        FROM conversations""",
    "records": """
        SELECT *, SUM(CASE WHEN status_division IS NULL THEN 0 ELSE 1 END)
                      OVER (ORDER BY place) AS record
        FROM sheet""",
}


def with_ctes(body: str) -> str:
    """Put the CTEs the text uses in front of it, in order of dependence."""
    used: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in used and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(CTES[name])
                used.append(name)

    visit(body)
    if not used:
        return body
    ctes = ",\n".join(f"{name} AS ({CTES[name]})" for name in used)
    own = body.lstrip()
    if own.startswith("WITH "):
        return f"WITH {ctes},\n{own[len('WITH ') :]}"
    return f"WITH {ctes}\n{own}"
