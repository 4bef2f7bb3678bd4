"""Common table expressions of the check statements.

They are written from the definitions of the features: facts summed per
campaign, currency and day, one table of rates per conversion, attributes last.
"""

from __future__ import annotations

import re

T = "DATE '2024-03-01'"
Y = "DATE '2024-02-29'"

CAMPAIGN_ATTRS = (
    "client_name, client_id, global_account_name, RTC_vertical, vertical_name, campaign_name, campaign_id, "
    "AS_name, AS_email, manager_name, manager_email, cost_center, currency_code, ranking, country, subregion, "
    "region, campaign_scenario, campaign_type_name, campaign_revenue_type, campaign_funnel_id")
CLIENT_ATTRS = (
    "client_name, client_id, global_account_name, RTC_vertical, vertical_name, AS_name, AS_email, manager_name, "
    "manager_email, cost_center, currency_code, ranking, country, subregion, region")
SERIES_ATTRS = (
    "combo, client_name, client_id, campaign_name, campaign_id, AS_name, AS_email, manager_name, manager_email, "
    "cost_center, currency_code, ranking, country, subregion, region")
TAG_ATTRS = (
    "partner_name, partner_id, TS_name, ts_engineer_email, manager_name, manager_email, ranking, ts_cost_center, "
    "ts_country, ts_subregion, ts_region, RTC_vertical, vertical_name, global_account_name")
MEASURES = ["clicks", "displays", "conversions", "spend", "tac", "rext", "rext_euro", "order_value"]


def names(text: str) -> list[str]:
    return [c.strip() for c in text.split(",")]


def sums(columns: list[str]) -> str:
    return ", ".join(f"sum({c}) AS {c}" for c in columns)


CTES: dict[str, str] = {}

# ---- the star schema --------------------------------------------------------

CTES["x_employee"] = """
SELECT c_custkey AS employee_id, c_mktsegment || CASE WHEN c_custkey % 7 = 3 THEN '-ANN' ELSE '' END || ' C' || c_custkey AS full_name,
       lower(c_mktsegment || '.' || c_custkey || '@example.test') AS email, CAST(c_nationkey AS VARCHAR) AS country,
       CASE WHEN c_nationkey % 5 = 1 THEN 'LM' ELSE 'US' END AS cost_center_country,
       ['FIELD', 'OFFICE', 'OTHER'][c_custkey % 3 + 1] AS cost_center_activity,
       CASE WHEN c_custkey % 25 <> 24 THEN c_custkey // 10 END AS direct_reports_id
FROM customer"""

CTES["x_client"] = """
SELECT s_suppkey AS client_id, 'client ' || s_suppkey AS client_name, s_suppkey * 10 + c AS campaign_id,
       CASE WHEN s_suppkey % 10 = 5 THEN ' "camp, aign"' || chr(10) || c || ' ' ELSE 'campaign ' || c END AS campaign_name,
       s_suppkey // 3 + CASE WHEN s_suppkey % 20 = 1 THEN c ELSE 0 END AS account_strategist_employee_id,
       s_suppkey // 4 AS ts_engineer_employee_id, CAST(1 + s_suppkey % 5 AS INTEGER) AS client_currency_id,
       s_suppkey AS partner_id, 'partner ' || s_suppkey AS partner_name,
       CASE WHEN s_suppkey % 3 = 0 THEN 'TIER 2' ELSE 'TIER 1' END AS ranking,
       CASE WHEN c = 0 THEN 'WEB' ELSE 'APP' END AS campaign_scenario,
       CASE WHEN s_suppkey % 2 = 0 THEN 'CONVERSION' ELSE 'TRAFFIC' END AS campaign_type_name,
       CAST(s_suppkey % 4 AS INTEGER) AS campaign_revenue_type, CAST(1 + c AS INTEGER) AS campaign_funnel_id,
       CASE WHEN s_suppkey % 10 <> 8 THEN 'vertical ' || (s_suppkey % 6) WHEN c = 1 THEN 'either' END AS vertical_name,
       CASE WHEN s_suppkey % 10 <> 8 THEN 'group ' || (s_suppkey % 2) WHEN c = 0 THEN 'either' END AS RTC_vertical,
       CASE s_suppkey % 10 WHEN 8 THEN NULL WHEN 9 THEN 'FILLER' ELSE 'RETAIL' END AS vertical_level_3_name,
       'global ' || (s_suppkey % 7) AS global_account_name,
       CASE s_nationkey % 8 WHEN 0 THEN 'US' WHEN 1 THEN 'CANADA' WHEN 2 THEN 'BRAZIL' WHEN 3 THEN 'ARGENTINA'
            WHEN 4 THEN 'MEXICO' WHEN 5 THEN 'PERU' WHEN 6 THEN 'CHILE' ELSE 'FRANCE' END AS country_name,
       CASE s_nationkey % 8 WHEN 0 THEN 'US' WHEN 1 THEN 'CANADA' WHEN 2 THEN 'BRAZIL' WHEN 7 THEN 'FRANCE'
            ELSE 'SOUTH AMERICA' END AS level_1,
       CASE s_nationkey % 8 WHEN 0 THEN 'NORTH AMERICA' WHEN 1 THEN 'NORTH AMERICA' WHEN 7 THEN 'SEMEA'
            ELSE 'LATAM' END AS level_2,
       CASE WHEN s_nationkey % 8 = 7 THEN 'EMEA' ELSE 'AMERICAS' END AS level_3
FROM supplier CROSS JOIN (VALUES (0), (1)) AS v(c)"""

CTES["x_currency"] = """
SELECT r_regionkey + 1 AS currency_id, ['EUR', 'USD', 'BRL', 'JPY', 'GBP'][r_regionkey + 1] AS currency_code FROM region"""

CTES["x_country"] = """
SELECT CAST(n_nationkey AS VARCHAR) AS country_code, n_name AS country, r_name || ' AREA' AS subregion, r_name AS region
FROM nation JOIN region ON n_regionkey = r_regionkey"""

_GAPS = """NOT (digit = 4 AND day = DATE '2024-02-29')
  AND NOT (digit = 5 AND dayofyear(day) % 2 = 0 AND day < DATE '2024-02-28')
  AND NOT (digit = 6 AND day IN (DATE '2024-02-15', DATE '2024-02-16'))"""
_FACTOR = """CASE WHEN day = DATE '2024-02-29' AND digit = 1 THEN 4.0e0
            WHEN day = DATE '2024-02-29' AND digit = 2 THEN 0.0625e0 ELSE 1.0e0 END"""
_TAC_FACTOR = """CASE WHEN day = DATE '2024-02-29' AND digit = 3 THEN 1.5e0 WHEN digit = 7 THEN 1.25e0 ELSE 1.0e0 END"""

CTES["x_stats"] = f"""
SELECT day, campaign_id, client_id, q * 20 AS displays, q AS clicks, floor(q / 5) AS conversions, ov AS order_value,
       p * f AS revenue_local, cost * f * g AS tac_local, p * f * 0.875e0 AS revenue_euro,
       cost * f * g * 0.875e0 AS tac_euro, affiliate_currency_id
FROM (SELECT *, {_FACTOR} AS f, {_TAC_FACTOR} AS g
      FROM (SELECT {T} - CAST(1 + l_orderkey % 60 AS INTEGER) AS day, l_suppkey AS client_id, l_suppkey % 10 AS digit,
                   l_suppkey * 10 + l_linenumber % 2 AS campaign_id,
                   CAST(1 + l_partkey % 5 AS INTEGER) AS affiliate_currency_id, l_quantity AS q,
                   floor(l_extendedprice) AS p, floor(floor(l_extendedprice) * (1 - l_discount)) AS cost,
                   floor(floor(l_extendedprice) * 5 * (1 + l_tax)) AS ov
            FROM lineitem)
      WHERE day <> DATE '2024-01-20' AND {_GAPS} AND NOT (client_id % 20 = 1 AND campaign_id % 10 = 1 AND day = {Y}))
JOIN (VALUES (0), (1)) AS v(n) ON n = 0 OR q >= 45"""

CTES["x_stats_2"] = f"""
SELECT day, campaign_id, cost * {_FACTOR} * {_TAC_FACTOR} AS tac_local,
       p * {_FACTOR} * CASE WHEN day = {Y} AND nk % 8 = 2 THEN 8.0e0 ELSE 1.0e0 END AS revenue_local,
       affiliate_currency_id
FROM (SELECT {T} - CAST(1 + l_orderkey % 30 AS INTEGER) AS day, s_suppkey % 10 AS digit, s_nationkey AS nk,
             l_suppkey * 10 + l_linenumber % 2 AS campaign_id, CAST(1 + l_partkey % 5 AS INTEGER) AS affiliate_currency_id,
             floor(l_extendedprice) AS p, floor(floor(l_extendedprice) * (1 - l_discount)) AS cost
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
WHERE {_GAPS}"""

CTES["x_days"] = f"""
SELECT CAST(unnest(generate_series(DATE '2024-01-01', {Y}, INTERVAL 1 DAY)) AS DATE) AS day"""

CTES["x_fx_daily"] = """
SELECT s.c AS source_currency_id, t.c AS destination_currency_id, day,
       CASE WHEN s.c = t.c THEN 1.0e0 ELSE 1.0e0 + 0.125e0 * (s.c - t.c) + (dayofyear(day) % 5) / 1024.0e0 END AS rate
FROM (SELECT r_regionkey + 1 AS c FROM region) s CROSS JOIN (SELECT r_regionkey + 1 AS c FROM region) t CROSS JOIN x_days
WHERE NOT (s.c = 3 AND t.c = 1 AND dayofyear(day) % 7 = 0)"""

CTES["x_fx_year"] = """
SELECT s.c AS source_currency_id, t.c AS destination_currency_id, 2024 AS year_code, f.n AS forecast_type_id,
       1.0e0 + 0.125e0 * (s.c - t.c) + f.n * 8 AS rate
FROM (SELECT r_regionkey + 1 AS c FROM region) s CROSS JOIN (SELECT r_regionkey + 1 AS c FROM region) t
CROSS JOIN (VALUES (0), (1)) AS f(n) WHERE s.c <> 3"""

CTES["x_events"] = f"""
SELECT partner_id, day, site_type, event_name,
       CAST(CASE WHEN day = {Y} AND partner_id % 10 = 1 AND site_type = 'm' THEN usual // 5
                 WHEN day = {Y} AND partner_id % 10 = 2 AND event_name = 'sales' THEN 0 ELSE usual END AS BIGINT) AS events
FROM (SELECT partner_id, site_type, event_name, day, 400 + (dayofyear(day) * 37 + partner_id * 11 + c) % 60 AS usual
      FROM (SELECT partner_id, site_type, event_name, count(*) AS c
            FROM (SELECT user_id AS partner_id,
                         CASE WHEN event_id % 3 = 0 THEN 'm' WHEN event_id % 3 = 1 AND user_id % 10 = 3 THEN 'unknown'
                              ELSE 'd' END AS site_type,
                         CASE event_type WHEN 'view' THEN 'page' WHEN 'click' THEN 'itempageview'
                              WHEN 'purchase' THEN 'sales' WHEN 'signup' THEN 'basket' ELSE 'homepage' END AS event_name
                  FROM events)
            GROUP BY ALL) CROSS JOIN x_days)
WHERE day <> DATE '2024-01-20' AND NOT (partner_id % 10 = 6 AND day = DATE '2024-02-15')"""

CTES["x_import_reports"] = """
SELECT 'schema_1' AS table_schema, event_type || '_table' AS table_name,
       date_trunc('day', max(ts)) + CASE WHEN event_type = 'error' THEN INTERVAL 29 DAY ELSE INTERVAL 31 DAY END AS update_time
FROM events GROUP BY event_type"""

CTES["x_run_history"] = f"""
SELECT DISTINCT {T} - CAST(o_orderkey % 40 AS INTEGER) AS run_date, 'job_' || lower(o_orderstatus) AS script,
       'geo ' || o_custkey AS geo FROM orders"""

CTES["x_sent_history"] = f"""
SELECT {T} AS run_date, email AS "to",
       'KPI AS Alert for ' || upper(full_name[1]) || lower(split_part(full_name, ' ', 1)[2:]) || ' ' || split_part(full_name, ' ', 2)
       AS subject
FROM x_employee WHERE employee_id % 5 = 2"""

# ---- daily features ---------------------------------------------------------

CTES["x_owner"] = """
SELECT e.employee_id, e.full_name AS owner_name, e.email AS owner_email, m.full_name AS manager_name,
       m.email AS manager_email, e.cost_center_country AS cost_center, e.country AS country_code
FROM (SELECT DISTINCT employee_id, full_name, email, cost_center_country, country, direct_reports_id
      FROM x_employee em WHERE {employees}) e
JOIN (SELECT DISTINCT employee_id, full_name, email FROM x_employee) m ON e.direct_reports_id = m.employee_id"""

CTES["x_facts"] = f"""
SELECT DISTINCT day, displays, clicks, conversions, order_value, revenue_local, tac_local, revenue_euro, tac_euro,
       campaign_id, affiliate_currency_id FROM x_stats WHERE day >= {T} - 60"""

CTES["x_dim"] = """
SELECT DISTINCT k.campaign_id, k.client_currency_id, k.client_name, k.client_id, k.global_account_name, k.RTC_vertical, k.vertical_name,
       k.campaign_name, k.ranking, k.campaign_scenario, k.campaign_type_name, k.campaign_revenue_type, k.campaign_funnel_id,
       w.owner_name AS AS_name, w.owner_email AS AS_email, w.manager_name, w.manager_email, w.cost_center, m.currency_code, z.country,
       z.subregion, z.region
FROM (SELECT * FROM x_client WHERE {clients}) k, x_owner w, x_currency m, x_country z
WHERE w.employee_id = k.account_strategist_employee_id AND m.currency_id = k.client_currency_id AND z.country_code = w.country_code"""

CTES["x_fact_sums"] = """
SELECT campaign_id, affiliate_currency_id, day, sum(clicks) AS n_clicks, sum(displays) AS n_displays, sum(conversions) AS n_conversions,
       sum(order_value) AS ordered, sum(revenue_local) AS revenue, sum(tac_local) AS media, sum(revenue_euro - tac_euro) AS euro,
       sum(revenue_local) FILTER (tac_local IS NOT NULL) AS paired_revenue, sum(tac_local) FILTER (revenue_local IS NOT NULL) AS paired_media
FROM x_facts GROUP BY ALL"""

CTES["x_day_rate"] = f"""
SELECT DISTINCT source_currency_id AS affiliate_currency_id, destination_currency_id AS client_currency_id, day, rate
FROM x_fx_daily WHERE day >= {T} - 60"""

CTES["x_priced"] = """
SELECT campaign_id, client_currency_id, day, coalesce(sum(n_clicks), 0) AS clicks, coalesce(sum(n_displays), 0) AS displays,
       coalesce(sum(n_conversions), 0) AS conversions, coalesce(sum(revenue), 0) AS spend, coalesce(sum(media * rate), 0) AS tac,
       coalesce(sum(paired_revenue - paired_media * rate), 0) AS rext, coalesce(sum(euro), 0) AS rext_euro,
       coalesce(sum(ordered), 0) AS order_value
FROM x_fact_sums JOIN (SELECT DISTINCT campaign_id, client_currency_id FROM x_dim) USING (campaign_id)
JOIN x_day_rate USING (affiliate_currency_id, client_currency_id, day)
GROUP BY ALL"""

CTES["x_campaign"] = f"""
SELECT {CAMPAIGN_ATTRS}, day, {", ".join(MEASURES)} FROM x_priced JOIN x_dim USING (campaign_id, client_currency_id)"""


def union_sql(attrs: str, series: str) -> str:
    return f"""
SELECT *, CASE WHEN spend = 0 THEN NULL ELSE rext / spend END AS margin FROM (
  SELECT {attrs}, 'NOT A CAMPAIGN' AS campaign_name, CAST(-1 AS BIGINT) AS campaign_id,
         'NOT A CAMPAIGN' AS campaign_scenario, 'NOT A CAMPAIGN' AS campaign_type_name,
         CAST(-11 AS INTEGER) AS campaign_revenue_type, CAST(-11 AS INTEGER) AS campaign_funnel_id,
         client_name AS {series}, day, {sums(MEASURES)}
  FROM x_campaign GROUP BY {attrs}, day
  UNION ALL
  SELECT {attrs}, campaign_name, campaign_id, campaign_scenario, campaign_type_name, campaign_revenue_type,
         campaign_funnel_id, client_name || ': ' || campaign_name AS {series}, day, {", ".join(MEASURES)}
  FROM x_campaign)"""


CTES["x_union"] = union_sql(CLIENT_ATTRS, "combo")

CTES["x_exec_client"] = """
SELECT DISTINCT level_1, level_2, level_3, country_name, campaign_id, account_strategist_employee_id, client_currency_id,
       client_id, client_name
FROM x_client WHERE level_3 = 'AMERICAS' AND ranking = 'TIER 1' AND vertical_level_3_name NOT IN ('FILLER')"""


CTES["x_conversion"] = """
SELECT g.source, g.target, g.day, coalesce(any_value(y.rate), any_value(d.rate)) AS rate
FROM (SELECT a.currency_id AS source, b.currency_id AS target, day FROM x_currency a, x_currency b, x_days) g
LEFT JOIN x_fx_daily d ON d.source_currency_id = g.source AND d.destination_currency_id = g.target AND d.day = g.day
LEFT JOIN x_fx_year y ON y.source_currency_id = g.source AND y.destination_currency_id = g.target AND y.forecast_type_id = 0
     AND y.year_code = year(g.day)
GROUP BY ALL"""

CTES["x_place"] = """
SELECT DISTINCT e.campaign_id, e.client_currency_id, e.client_id, e.client_name, level_3 AS area, level_2 AS region,
       CASE WHEN list_contains(['US', 'CANADA', 'BRAZIL'], level_1) THEN level_1 WHEN level_1 <> 'SOUTH AMERICA' THEN NULL
            WHEN list_contains(['ARGENTINA', 'MEXICO', 'CHILE', 'COLOMBIA'], country_name) THEN country_name ELSE 'SAM OTHER' END AS country
FROM x_exec_client e SEMI JOIN x_employee p ON p.employee_id = e.account_strategist_employee_id"""

CTES["x_month_sums"] = f"""
SELECT campaign_id, affiliate_currency_id, day, coalesce(sum(revenue_local), 0) AS revenue, coalesce(sum(tac_local), 0) AS media
FROM (SELECT DISTINCT day, campaign_id, tac_local, revenue_local, affiliate_currency_id FROM x_stats_2 WHERE day >= {T} - 30)
GROUP BY ALL"""


def margin_sql(places: str, keys: str) -> str:
    """Margin in dollars: what was earned, less the media in the client's currency, both turned into dollars."""
    return f"""
SELECT day, {keys}, sum(revenue * coalesce(dollars, 0) - media * coalesce(local, 0) * coalesce(dollars, 1)) AS RexT_USD_Constant
FROM (SELECT s.day, {keys}, revenue, media, u.rate AS dollars, c.rate AS local
      FROM x_month_sums s JOIN ({places}) p USING (campaign_id)
      LEFT JOIN x_conversion u ON u.source = p.client_currency_id AND u.target = 2 AND u.day = s.day
      LEFT JOIN x_conversion c ON c.source = s.affiliate_currency_id AND c.target = p.client_currency_id AND c.day = s.day)
GROUP BY day, {keys}"""


CTES["x_territory"] = margin_sql("SELECT DISTINCT campaign_id, client_currency_id, area, region, country FROM x_place", "area, region, country")
CTES["x_account"] = margin_sql(
    f"SELECT * FROM x_place WHERE client_id IN (SELECT client_id FROM x_stats WHERE day BETWEEN {T} - 25 AND {Y} GROUP BY client_id "
    "HAVING count(DISTINCT day) = 25)", "area, region, country, client_name")

CTES["x_partner"] = """
SELECT DISTINCT k.campaign_id, k.partner_name, k.partner_id, k.ranking, k.RTC_vertical, k.vertical_name, k.global_account_name,
       w.owner_name AS TS_name, w.owner_email AS ts_engineer_email, w.manager_name, w.manager_email, w.cost_center AS ts_cost_center,
       z.country AS ts_country, z.subregion AS ts_subregion, z.region AS ts_region
FROM (SELECT * FROM x_client WHERE {clients}) k, x_owner w, x_country z
WHERE w.employee_id = k.ts_engineer_employee_id AND z.country_code = w.country_code"""

CTES["x_media"] = f"""
SELECT campaign_id, day, sum(tac_local) AS media
FROM (SELECT DISTINCT campaign_id, day, tac_local FROM x_stats_2 WHERE day >= {T} - 30 AND day < {T}) GROUP BY ALL"""

CTES["x_live"] = f"""
SELECT * FROM (
  SELECT {TAG_ATTRS}, len(list_distinct(list(day))) AS days_live, coalesce(sum(media) FILTER (day >= {T} - 2), 0) AS recent_tac
  FROM x_media JOIN x_partner USING (campaign_id) GROUP BY ALL)
WHERE days_live >= 25 AND recent_tac > 0"""

CTES["x_tag"] = f"""
SELECT {TAG_ATTRS}, day, site_type, event_name, CAST(sum(events) AS BIGINT) AS events
FROM (SELECT l.* REPLACE (CASE WHEN ts_cost_center = 'LM' THEN 'LATAM' ELSE ts_subregion END AS ts_subregion),
             e.day, e.site_type, e.event_name, e.events
      FROM x_live l
      JOIN (SELECT partner_id, day, site_type,
                   CASE event_name WHEN 'page' THEN 'homepage' WHEN 'itempageview' THEN 'product' ELSE event_name END AS event_name,
                   sum(events) AS events
            FROM x_events WHERE day >= {T} - 60 GROUP BY ALL) e ON l.partner_id = e.partner_id)
GROUP BY {TAG_ATTRS}, day, site_type, event_name"""

# ---- cleaning, fill, detection ----------------------------------------------

CTES["x_disqualified"] = f"""
SELECT combo, count(*) FILTER (day = {Y}) = 0 AS no_data_yesterday,
       coalesce(sum(round_even(tac, 2)) FILTER (day IN ({Y}, {Y} - 1)) <= 0, FALSE) AS no_recent_tac,
       count(*) FILTER (day >= {Y} - 29) BETWEEN 1 AND 24 AS not_live
FROM x_union GROUP BY combo
HAVING no_data_yesterday OR no_recent_tac OR not_live"""

_TEXTS = ["client_name", "global_account_name", "RTC_vertical", "vertical_name", "campaign_name", "AS_name", "AS_email",
          "manager_name", "manager_email", "cost_center", "currency_code", "ranking", "country", "subregion", "region",
          "campaign_scenario", "campaign_type_name"]


def clean_texts(columns: list[str]) -> str:
    return ", ".join(f"coalesce({c}, '0') AS {c}" for c in columns)


def ratio(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN 0 ELSE {a} / {b} END"


CTES["x_eligible"] = f"""
SELECT * REPLACE ({clean_texts(_TEXTS)}, coalesce(margin, 0) AS margin),
       {ratio("spend", "order_value")} AS cos, {ratio("clicks", "displays")} AS ctr, {ratio("conversions", "clicks")} AS cr
FROM x_union WHERE combo NOT IN (SELECT combo FROM x_disqualified)"""


def fill_sql(source: str, key: str, metrics: list[str], order: str = "day") -> str:
    medians = ", ".join(f"median({m}) AS med_{m}" for m in metrics)
    values = ", ".join(f"CASE WHEN g.unseen THEN p.med_{m} ELSE 0 END AS {m}" for m in metrics)
    doubles = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in metrics)
    return f"""
WITH cal AS (SELECT d.day, d.day NOT IN (SELECT DISTINCT day FROM {source}) AS unseen
             FROM (SELECT CAST(unnest(generate_series((SELECT min(day) FROM {source}), (SELECT max(day) FROM {source}),
                                                      INTERVAL 1 DAY)) AS DATE) AS day) d),
     p AS (SELECT {key}, min(day) AS start_day, {medians} FROM {source} GROUP BY {key}),
     g AS (SELECT p.{key}, cal.day, cal.unseen FROM p CROSS JOIN cal
           LEFT JOIN (SELECT DISTINCT {key}, day FROM {source}) s ON s.{key} = p.{key} AND s.day = cal.day
           WHERE s.day IS NULL AND (cal.unseen OR cal.day >= p.start_day)),
     f AS (SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1)
SELECT * REPLACE ({doubles}) FROM {source}
UNION ALL BY NAME
SELECT f.* REPLACE (g.day AS day, {values}) FROM g JOIN p ON p.{key} = g.{key} JOIN f ON f.{key} = g.{key}"""


def stats_sql(source: str, key: str, metrics: list[str], extra: str = "") -> str:
    return "\nUNION ALL\n".join(f"""
SELECT {key}, '{m}' AS kpi, count(*) AS n_rows, max(day) AS last_day, count(*) FILTER (day = {Y}) AS n_yesterday, {extra}
       avg({m}) AS mean, var_samp({m}) AS variance, quantile_cont({m}, 0.25) AS q1, quantile_cont({m}, 0.5) AS median,
       quantile_cont({m}, 0.75) AS q3, max({m}) FILTER (day = {Y}) AS value, min({m}) FILTER (day = {Y} - 1) AS value_before
FROM {source} GROUP BY {key}""" for m in metrics)


_CRITICAL = """CASE kpi WHEN 'events' THEN 5.0238861873148934e0 WHEN 'cos' THEN 12.115665146397381e0
  WHEN 'ctr' THEN 10.827566170662935e0 WHEN 'cr' THEN 10.827566170662935e0 WHEN 'spend' THEN 9.140593461244016e0
  WHEN 'rext' THEN 9.140593461244016e0 ELSE 5.0238861873148934e0 END"""
_DEVIATION = "CASE WHEN kpi IN ('cos', 'cr', 'ctr') THEN 0.0001e0 ELSE 1 END"


def flags_sql(source: str, guarded: bool = True) -> str:
    material = f"n_yesterday = 1 AND coalesce(abs(abs(median) - abs(value)) >= {_DEVIATION}, FALSE)" if guarded else "TRUE"
    return f"""
SELECT *, (CASE WHEN kpi = 'events' THEN neg ELSE neg OR pos END) AND is_material AS is_alert
FROM (SELECT *, base AND below_fence AND fell AS neg, base AND above_fence AND rose AS pos
      FROM (SELECT *, enough_rows AND ends_yesterday AND is_outlier AS base
            FROM (SELECT *, n_rows >= 25 AS enough_rows, last_day = {Y} AS ends_yesterday,
                         CASE WHEN variance <> 0 THEN power(value - mean, 2) / variance END AS score,
                         coalesce(CASE WHEN variance <> 0 THEN power(value - mean, 2) / variance END > {_CRITICAL}, FALSE) AS is_outlier,
                         coalesce(value < q1 - 3 * (q3 - q1), FALSE) AS below_fence,
                         coalesce(value > q3 + 3 * (q3 - q1), FALSE) AS above_fence,
                         coalesce(value <= value_before * 0.9e0, FALSE) AS fell,
                         coalesce(value >= value_before * 1.1e0, FALSE) AS rose, {material} AS is_material
                  FROM {source})))"""


# of several rows on a series' first day the least by its measures is copied
FIRST_ROW = "day, clicks, displays, conversions, spend"
CTES["x_filled"] = fill_sql("x_eligible", "combo", ["spend", "cos", "ctr", "cr", "rext"], FIRST_ROW)
CTES["x_as_stats"] = stats_sql("x_filled", "combo", ["rext", "spend", "cos", "cr", "ctr"],
                               f"max(rext_euro) FILTER (day = {Y}) AS rext_euro_yesterday,")
CTES["x_as_flags"] = f"""
SELECT * REPLACE (is_alert OR is_override AS is_alert), is_alert AS is_statistical
FROM (SELECT *, coalesce(kpi = 'rext' AND n_yesterday = 1 AND rext_euro_yesterday <= -1000, FALSE) AS is_override
      FROM ({flags_sql("x_as_stats")}))"""
CTES["x_as_results"] = f"""
SELECT {SERIES_ATTRS}, kpi, {T} AS run_date, is_alert
FROM (SELECT DISTINCT {SERIES_ATTRS} FROM x_filled) JOIN (
  SELECT combo, kpi, is_alert FROM x_as_flags
  UNION ALL SELECT DISTINCT combo, 'rext_euro', FALSE FROM x_as_flags) USING (combo)"""

CTES["x_ts_clean"] = "SELECT * REPLACE ({}) FROM x_tag".format(
    clean_texts([c for c in names(TAG_ATTRS) if c != "partner_id"]))
CTES["x_ts_series"] = f"""
SELECT *, partner_name || ' ' || event_name || ' on ' || site_type || ' managed by ' || TS_name AS combo
FROM (SELECT {TAG_ATTRS}, day, site_type, event_name, events FROM x_ts_clean
      UNION ALL
      SELECT {TAG_ATTRS}, day, 'SITE LEVEL', 'SITE LEVEL', CAST(sum(events) AS BIGINT) FROM x_ts_clean GROUP BY {TAG_ATTRS}, day)"""
CTES["x_ts_filled"] = fill_sql("x_ts_series", "combo", ["events"])
CTES["x_ts_flags"] = flags_sql("(" + stats_sql("x_ts_filled", "combo", ["events"]) + ")")
CTES["x_ts_results"] = f"""
SELECT {TAG_ATTRS}, site_type, event_name, combo, {T} AS run_date, is_alert
FROM (SELECT DISTINCT {TAG_ATTRS}, site_type, event_name, combo FROM x_ts_filled) JOIN x_ts_flags USING (combo)"""
CTES["x_ts_alerts"] = """
SELECT DISTINCT * EXCLUDE (global_account_name) FROM x_ts_results
WHERE is_alert AND site_type <> 'SITE LEVEL' AND event_name <> 'SITE LEVEL'"""

_TERRITORY = "(SELECT day, coalesce(area, '0') AS area, coalesce(region, '0') AS region, coalesce(country, '0') AS country, RexT_USD_Constant FROM x_territory)"
CTES["x_territory_series"] = "\nUNION ALL\n".join(
    f"SELECT {c} AS series, day, sum(RexT_USD_Constant) AS RexT FROM {_TERRITORY} GROUP BY {c}, day"
    for c in ("area", "region", "country"))
CTES["x_territory_filled"] = fill_sql("x_territory_series", "series", ["RexT"])
CTES["x_territory_flags"] = flags_sql("(" + stats_sql("x_territory_filled", "series", ["RexT"]) + ")")
CTES["x_territory_text"] = """
SELECT coalesce(string_agg(series, ', ' ORDER BY series), 'NONE') AS alerts FROM x_territory_flags WHERE is_alert"""

CTES["x_account_series"] = """
SELECT coalesce(client_name, '0') AS client_name, coalesce(region, '0') AS region,
       coalesce(client_name, '0') || '|' || coalesce(region, '0') AS series, day, sum(RexT_USD_Constant) AS exec
FROM x_account GROUP BY ALL"""
CTES["x_account_flags"] = flags_sql("(" + stats_sql(
    "x_account_series", "series", ["exec"],
    f"any_value(client_name) AS client_name, any_value(region) AS region, "
    f"avg(exec) FILTER (day >= {T} - 8 AND day < {Y}) AS expected, arg_max(exec, day) AS actual,") + ")", guarded=False)
CTES["x_account_alerts"] = """
SELECT client_name, region, expected, actual, abs(actual - expected) AS magnitude, (actual - expected) / expected AS percent_diff
FROM x_account_flags WHERE is_alert AND expected > 0"""

# ---- reports ----------------------------------------------------------------

CTES["x_rank"] = """
SELECT * FROM (VALUES ('rext', 1), ('spend', 2), ('cos', 3), ('cr', 4), ('ctr', 5)) AS v(kpi, kpi_rank)"""
CTES["x_margin"] = """
SELECT combo, avg(rext_euro) AS avg_rext_euro FROM x_filled WHERE campaign_name = 'NOT A CAMPAIGN' GROUP BY combo"""
CTES["x_as_alerts"] = """
SELECT r.*, CAST(k.kpi_rank AS INTEGER) AS kpi_rank, m.avg_rext_euro
FROM x_as_results r LEFT JOIN x_margin m USING (combo) JOIN x_rank k USING (kpi)
WHERE r.is_alert AND campaign_name = 'NOT A CAMPAIGN'"""
CTES["x_as_recap"] = "SELECT ranking, AS_name, combo, kpi, avg_rext_euro, kpi_rank FROM x_as_alerts WHERE AS_name <> manager_name"
CTES["x_as_summary"] = """
SELECT ranking, count(DISTINCT AS_name) AS emails_sent, count(*) AS total_alerts FROM x_as_recap GROUP BY ranking"""

CTES["x_chart_long"] = """
SELECT combo, AS_name, AS_email, currency_code, kpi, day, value
FROM (UNPIVOT (SELECT combo, AS_name, AS_email, currency_code, day, rext, spend, cos, cr, ctr FROM x_filled)
      ON rext, spend, cos, cr, ctr INTO NAME kpi VALUE value)
SEMI JOIN x_as_alerts USING (combo, AS_name, AS_email, kpi)"""


def number_text(x: str, digits: int = 2) -> str:
    return f"format('{{:,.{digits}f}}', round_even({x}, {digits}) + 0.0e0)"


def currency_text(x: str, prefix: str = "''", symbol: str = "$", code: str | None = None) -> str:
    tail = f" || CASE WHEN {code} = '' THEN '' ELSE ' ' || {code} END" if code else ""
    return f"(CASE WHEN {x} < 0 THEN '-' ELSE {prefix} END || '{symbol}' || {number_text(f'abs({x})')}{tail})"


def percent_text(x: str, plus: bool = False, digits: int = 2) -> str:
    scaled = f"round_even(({x}) * 100, {digits})"
    sign = f"CASE WHEN {scaled} > 0 THEN '+' ELSE '' END || " if plus else ""
    return f"({sign}{number_text(scaled, digits)} || '%')"


def compact_text(x: str) -> str:
    def scaled(unit: str, suffix: str) -> str:
        return f"CAST(CAST(round_even({x} / {unit}, 0) AS BIGINT) AS VARCHAR) || '{suffix}'"
    return (f"(CASE WHEN {x} < 1000 THEN {number_text(x, 0)} WHEN {x} < 1000000 THEN {scaled('1e3', 'K')} "
            f"WHEN {x} < 1000000000 THEN {scaled('1e6', 'M')} ELSE {scaled('1e9', 'B')} END)")


def title_text(x: str) -> str:
    """Title case of a text of two words."""
    def word(n: int) -> str:
        part = f"split_part({x}, ' ', {n})"
        return f"upper({part}[1]) || lower({part}[2:])"
    return f"({word(1)} || ' ' || {word(2)})"


_STEP = """CASE WHEN kpi IN ('spend', 'rext', 'events')
  THEN CASE WHEN hi < 100 THEN 5.0e0 WHEN hi < 1000 THEN 10.0e0 WHEN hi < 10000 THEN 100.0e0 ELSE 1000.0e0 END
  ELSE CASE WHEN hi < 0.30e0 THEN 0.01e0 ELSE 0.1e0 END END"""


def axis_sql(source: str, keys: str = "combo, kpi") -> str:
    return f"""
SELECT {keys}, step, y_max, y_min,
       CASE WHEN kpi IN ('spend', 'rext') THEN {compact_text('y_max')} || ' ' || currency_code
            WHEN kpi = 'events' THEN {compact_text('y_max')} ELSE {compact_text('(y_max * 100)')} || ' %' END AS y_max_label,
       CASE WHEN kpi IN ('spend', 'rext') THEN {compact_text('y_min')} || ' ' || currency_code
            WHEN kpi = 'events' THEN {compact_text('y_min')} ELSE {compact_text('(y_min * 100)')} || ' %' END AS y_min_label,
       CASE WHEN kpi = 'events' THEN {number_text('last_value', 0)}
            WHEN kpi IN ('spend', 'rext') THEN {currency_text('last_value', symbol='', code='currency_code')}
            ELSE {percent_text('last_value')} END AS last_label,
       first_day, last_day, CAST((last_day - first_day) // 14 + 1 AS INTEGER) AS n_ticks,
       last_day - CAST((last_day - first_day) // 14 * 14 AS INTEGER) AS first_tick
FROM (SELECT *, ceil(greatest(0.0e0, hi * CASE WHEN hi > 0 THEN 1.05e0 ELSE 0.95e0 END) / step) * step AS y_max,
             CASE WHEN kpi = 'events' THEN 0.0e0
                  ELSE floor(least(0.0e0, lo * CASE WHEN lo < 0 THEN 1.05e0 ELSE 0.95e0 END) / step) * step END AS y_min
      FROM (SELECT *, {_STEP} AS step
            FROM (SELECT {keys}, max(value) AS hi, min(value) AS lo, arg_max(value, day) AS last_value,
                         min(currency_code) AS currency_code, min(day) AS first_day, max(day) AS last_day
                  FROM {source} GROUP BY {keys})))"""


CTES["x_axis"] = axis_sql("x_chart_long", "combo, AS_name, AS_email, kpi")
CTES["x_ts_axis"] = axis_sql("""(SELECT combo, '' AS currency_code, 'events' AS kpi, day, events AS value
                                 FROM x_ts_filled SEMI JOIN x_ts_alerts USING (combo))""")

# ---- export -----------------------------------------------------------------

EXPORT_COLUMNS = (
    "series, client_name, client_id, global_account_name, RTC_vertical, vertical_name, partner_id, partner_name, campaign_id, "
    "campaign_name, campaign_scenario, campaign_type_name, campaign_revenue_type, campaign_funnel_id, cost_center, ranking, "
    "country, subregion, region, site_type, event_name, day, run_date, kpi, value")
EXPORT_CLIENT_ATTRS = (
    "client_name, client_id, global_account_name, RTC_vertical, vertical_name, cost_center, ranking, country, subregion, region")
EXPORT_KPIS = ["clicks", "displays", "conversions", "spend", "tac", "client_rext", "rext_euro", "order_value", "cos", "ctr",
               "cr", "margin"]

CTES["x_export_rows"] = """
SELECT * EXCLUDE (rext) REPLACE ({texts}, coalesce(margin, 0) AS margin), rext AS client_rext, {cos} AS cos, {ctr} AS ctr, {cr} AS cr
FROM ({union})""".format(
    texts=clean_texts([c for c in _TEXTS if c not in ("AS_name", "AS_email", "manager_name", "manager_email", "currency_code")]),
    cos=ratio("spend", "order_value"), ctr=ratio("clicks", "displays"), cr=ratio("conversions", "clicks"),
    union=union_sql(EXPORT_CLIENT_ATTRS, "series"))
CTES["x_export_filled"] = fill_sql("x_export_rows", "series", [k for k in EXPORT_KPIS if k != "rext_euro"], FIRST_ROW)
CTES["x_export_as"] = f"""
SELECT * FROM (UNPIVOT (SELECT * FROM x_export_filled) ON {", ".join(EXPORT_KPIS)} INTO NAME kpi VALUE value)"""

CTES["x_export_tag"] = """
SELECT DISTINCT partner_name, partner_id, day, ranking, ts_cost_center AS cost_center, ts_country AS country,
       ts_subregion AS subregion, ts_region AS region, RTC_vertical, vertical_name, global_account_name, site_type, event_name,
       events AS value FROM x_ts_clean"""
_EXPORT_TAG_ATTRS = ("partner_name, partner_id, day, ranking, cost_center, country, subregion, region, RTC_vertical, "
                     "vertical_name, global_account_name")
CTES["x_export_tag_rows"] = f"""
SELECT {_EXPORT_TAG_ATTRS}, site_type, event_name, value, partner_name || ' ' || event_name || ' on ' || site_type AS series,
       'tag_events' AS kpi FROM x_export_tag WHERE site_type NOT LIKE '%unknown%'
UNION ALL
SELECT {_EXPORT_TAG_ATTRS}, 'SITE LEVEL', 'SITE LEVEL', sum(value), partner_name, 'site_events'
FROM x_export_tag GROUP BY {_EXPORT_TAG_ATTRS}"""
CTES["x_export_ts"] = fill_sql(
    "x_export_tag_rows", "series", ["value"],
    "day, value, ranking, cost_center, country, subregion, region, RTC_vertical, vertical_name, global_account_name")
CTES["x_export_territory_rows"] = f"""
SELECT area AS series, area AS region, 'N/A' AS subregion, 'N/A' AS country, day, sum(RexT_USD_Constant) AS value
FROM {_TERRITORY} GROUP BY area, day
UNION ALL
SELECT region, area, region, 'N/A', day, sum(RexT_USD_Constant) FROM {_TERRITORY} GROUP BY area, region, day
UNION ALL
SELECT country, area, region, country, day, sum(RexT_USD_Constant) FROM {_TERRITORY} GROUP BY area, region, country, day"""
CTES["x_export_territory"] = fill_sql("x_export_territory_rows", "series", ["value"])


def statement(final: str, employees: str = "TRUE", clients: str = "TRUE") -> str:
    """``final`` preceded by the expressions it needs, in order of definition."""
    def used(text: str) -> set[str]:
        return set(re.findall(r"\bx_\w+", text)) & CTES.keys()

    needed, todo = set(), used(final)
    while todo:
        needed |= todo
        todo = {n for name in todo for n in used(CTES[name])} - needed
    parts = []
    for name, sql in CTES.items():
        if name in needed:
            if name in ("x_owner", "x_dim", "x_partner"):
                sql = sql.replace("{employees}", employees).replace("{clients}", clients)
            parts.append(f"{name} AS MATERIALIZED ({sql}\n)")
    body = f"SELECT * FROM ({final})" if final.lstrip().startswith("WITH") else final
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
