"""One DuckDB statement per registered query."""

from __future__ import annotations

from pulsewatch.catalog import CLIENT_FILTER, DELIVERY, EMPLOYEE_FILTER, POD_LEADERS, REQUIRED_TABLES
from pulsewatch.oracle.ctes import (
    EXPORT_COLUMNS, MEASURES, T, Y, compact_text, currency_text, fill_sql, flags_sql, names, number_text, percent_text,
    statement, title_text)


def rounded(columns: str, digits: int) -> str:
    return ", ".join(f"round({c}, {digits}) + 0.0e0 AS {c}" for c in names(columns))


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def encoded(x: str) -> str:
    return f"url_encode(CAST({x} AS VARCHAR))"


def link(base: str, params: dict[str, str]) -> str:
    return f"'{base}?' || " + " || '&' || ".join(f"'{k}=' || {encoded(v)}" for k, v in params.items())


RULE = "-" * 79
SENT = "Fri  1 Mar 2024 04:30AM EST"
DAY = "Fri  1 Mar 2024"


def messages(lines: str, groups: list[str], headline: str, noun: str) -> str:
    keys = ", ".join(groups)
    return f"""
SELECT {keys}, CAST((line_no - 1) // 25 + 1 AS INTEGER) AS message_no, '>>>' || string_agg(line, chr(10) ORDER BY line_no) AS text
FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY subject) AS line_no FROM ({lines})) GROUP BY {keys}, message_no
UNION ALL SELECT DISTINCT {keys}, 0, '{headline} at {SENT}' FROM ({lines})
UNION ALL
SELECT {keys}, CAST(ceil(count(*) / 25.0) AS INTEGER) + 1,
       '*Total accounts with {noun} alert(s): ' || count(*) || '*' || chr(10) || '{RULE}' FROM ({lines}) GROUP BY {keys}"""


BODY = """'Emails Sent: ' || emails_sent || chr(10) || 'Total Alerts Triggered: ' || total_alerts || chr(10) || chr(10)
  || 'Recap of triggered accounts/alerts attached.'"""
BETA = quoted(f"{s}.{i}@example.test" for s in ("building", "machinery", "household") for i in range(0, 40, 2))
LEADERS = quoted(POD_LEADERS)
FLAG_COLUMNS = ("combo, kpi, enough_rows, ends_yesterday, round(score, 6) + 0.0e0 AS score, is_outlier, below_fence, above_fence, "
                "fell, rose, is_material")

FINAL: dict[str, str] = {}

FINAL["owner_dim"] = "SELECT * FROM x_owner"
FINAL["fact_dedup"] = """
SELECT campaign_id, day, count(*) AS n_facts, sum(revenue_local) AS revenue FROM x_facts GROUP BY campaign_id, day"""
FINAL["campaign_daily"] = "SELECT * FROM x_campaign"
FINAL["campaign_daily_kept"] = "SELECT * FROM x_campaign"
FINAL["param_filter"] = "SELECT * FROM x_campaign"
FINAL["client_campaign_union"] = f"""
SELECT combo, campaign_name, campaign_id, campaign_scenario, campaign_revenue_type, campaign_funnel_id, AS_email, day,
       {rounded(", ".join([*MEASURES, "margin"]), 9)} FROM x_union"""
FINAL["beta_filter"] = f"SELECT combo, AS_email, day, spend, rext FROM x_union WHERE AS_email IN ({BETA})"
FINAL["live_partners"] = "SELECT * FROM x_live"
FINAL["tag_daily"] = "SELECT * FROM x_tag"
FINAL["territory_daily"] = "SELECT * FROM x_territory"
FINAL["account_daily"] = "SELECT * FROM x_account"
FINAL["kpi_ratios"] = """
SELECT combo, day, round(CASE WHEN order_value = 0 THEN 0 ELSE spend / order_value END, 9) + 0.0e0 AS cos,
       round(CASE WHEN displays = 0 THEN 0 ELSE clicks / displays END, 9) + 0.0e0 AS ctr,
       round(CASE WHEN clicks = 0 THEN 0 ELSE conversions / clicks END, 9) + 0.0e0 AS cr,
       round(margin, 9) + 0.0e0 AS margin FROM x_union"""
FINAL["clean_data"] = """
SELECT combo, day, coalesce(vertical_name, '0') AS vertical_name, coalesce(RTC_vertical, '0') AS RTC_vertical,
       campaign_revenue_type, round(coalesce(margin, 0), 9) + 0.0e0 AS margin,
       round(CASE WHEN order_value = 0 THEN 0 ELSE spend / order_value END, 9) + 0.0e0 AS cos FROM x_union"""
FINAL["disqualify"] = "SELECT * FROM x_disqualified"
FINAL["calendar_fill"] = f"""
SELECT combo, day, AS_name, {rounded("clicks, rext_euro, spend, cos, ctr, cr, rext", 9)} FROM x_filled"""
FINAL["kpi_long"] = """
SELECT combo, client_name, campaign_name, day, kpi, round(value, 9) + 0.0e0 AS value
FROM (UNPIVOT (SELECT combo, client_name, campaign_name, day, rext, spend, cos, ctr, cr, clicks, displays, tac, conversions,
                      order_value, rext_euro FROM x_filled)
      ON rext, spend, cos, ctr, cr, clicks, displays, tac, conversions, order_value, rext_euro INTO NAME kpi VALUE value)"""
FINAL["wide_to_long"] = """
SELECT day AS "Day", series AS "Series", RexT FROM x_territory_series"""
FINAL["last_n_rounded"] = """
SELECT series, day, round_even(RexT, 2) + 0.0e0 AS RexT FROM x_territory_series
QUALIFY row_number() OVER (PARTITION BY series ORDER BY day DESC) <= 15"""
FINAL["pad_7_days"] = f"""
WITH r AS (SELECT client_name, day, sum(clicks) AS total_events FROM x_campaign WHERE day >= {T} - 7 GROUP BY ALL),
     h AS (SELECT c.client_name, count(r.day) AS n, coalesce(max(r.day), {T} - 8) AS last
           FROM (SELECT DISTINCT client_name FROM x_client) c LEFT JOIN r USING (client_name) GROUP BY c.client_name)
SELECT * FROM r
UNION ALL
SELECT client_name, last + CAST(i AS INTEGER), NULL FROM h, generate_series(1, 7) AS g(i) WHERE i <= 7 - n"""
FINAL["detector_stats"] = f"""
SELECT combo, n_rows, last_day, n_yesterday, kpi, {rounded("mean, q1, median, q3, value, value_before", 6)},
       round(sqrt(variance) / (1 + abs(mean)), 6) + 0.0e0 AS spread FROM x_as_stats"""
FINAL["detector_flags"] = f"SELECT {FLAG_COLUMNS}, is_statistical AS is_alert FROM x_as_flags"
FINAL["detector_directions"] = """
SELECT combo, direction, is_material AND CASE direction WHEN 'neg' THEN neg WHEN 'pos' THEN pos ELSE neg OR pos END AS is_alert
FROM x_as_flags CROSS JOIN (VALUES ('neg'), ('pos'), ('both')) AS v(direction) WHERE kpi = 'spend'"""
FINAL["as_results"] = "SELECT * FROM x_as_results"
FINAL["ts_series"] = "SELECT combo, day, site_type, event_name, partner_id, events FROM x_ts_series"
FINAL["ts_results"] = "SELECT * FROM x_ts_results"
FINAL["ts_alerts"] = "SELECT * FROM x_ts_alerts"
FINAL["territory_series"] = "SELECT * FROM x_territory_series"
FINAL["territory_results"] = "SELECT series, is_alert FROM x_territory_flags"
FINAL["account_alerts"] = f"""
SELECT client_name, region, {rounded("expected, actual, magnitude, percent_diff", 6)} FROM x_account_alerts"""
FINAL["eligibility"] = f"""
SELECT combo, metric, count(*) AS n_rows, count(*) >= 25 AND max(day) = {Y} AS is_eligible
FROM x_filled CROSS JOIN (VALUES ('spend'), ('cos'), ('ctr'), ('cr'), ('site_events')) AS v(metric) GROUP BY combo, metric"""
FINAL["alert_review_series"] = """
SELECT combo, upper(kpi) AS alert, kpi, f.day, round(f.value, 9) + 0.0e0 AS value
FROM (UNPIVOT (SELECT combo, day, rext, spend, cos, ctr, cr FROM x_filled) ON rext, spend, cos, ctr, cr INTO NAME kpi VALUE value) f
JOIN (SELECT combo, kpi FROM x_as_flags WHERE is_statistical) a USING (combo, kpi)"""
FINAL["as_alerts"] = "SELECT * REPLACE (round(avg_rext_euro, 6) + 0.0e0 AS avg_rext_euro) FROM x_as_alerts"
FINAL["pod_alerts"] = f"""
WITH a AS (SELECT * FROM x_as_results WHERE is_alert AND campaign_name = 'NOT A CAMPAIGN'),
     h AS (SELECT * FROM x_filled WHERE campaign_name = 'NOT A CAMPAIGN'),
     pa AS (SELECT * FROM a UNION
            SELECT * REPLACE (CASE WHEN manager_name IN ({LEADERS}) THEN manager_email ELSE AS_email END AS AS_email,
                              CASE WHEN manager_name IN ({LEADERS}) THEN manager_name ELSE AS_name END AS AS_name)
            FROM a WHERE manager_name IN ({LEADERS}) OR AS_name IN ({LEADERS})),
     ph AS (SELECT * FROM h UNION
            SELECT * REPLACE (CASE WHEN manager_name IN ({LEADERS}) THEN manager_email ELSE AS_email END AS AS_email,
                              CASE WHEN manager_name IN ({LEADERS}) THEN manager_name ELSE AS_name END AS AS_name)
            FROM h WHERE manager_name IN ({LEADERS}) OR AS_name IN ({LEADERS})),
     m AS (SELECT combo, avg(rext_euro) AS avg_rext_euro FROM ph GROUP BY combo)
SELECT combo, kpi, AS_name, AS_email, manager_name, round(avg_rext_euro, 6) + 0.0e0 AS avg_rext_euro,
       CAST(kpi_rank AS INTEGER) AS kpi_rank
FROM pa LEFT JOIN m USING (combo) JOIN x_rank USING (kpi)"""
FINAL["as_owner_digest"] = """
WITH c AS (SELECT AS_email, combo, CAST(row_number() OVER (
             PARTITION BY AS_email ORDER BY max(avg_rext_euro) DESC, min(kpi_rank), combo) AS INTEGER) AS client_no
           FROM x_as_alerts GROUP BY AS_email, combo)
SELECT a.AS_email, a.combo, a.kpi, a.AS_name, a.client_id, a.kpi_rank, c.client_no, c.client_no % 3 AS color_slot,
       x.last_label, x.first_day, x.last_day
FROM x_as_alerts a JOIN c USING (AS_email, combo) LEFT JOIN x_axis x USING (AS_email, combo, kpi)"""
FINAL["as_summary"] = f"SELECT *, {BODY} AS body FROM x_as_summary"
FINAL["as_recap"] = "SELECT AS_name, combo, kpi, ranking FROM x_as_recap"
FINAL["ts_summary"] = f"""
SELECT *, {BODY} AS body FROM (SELECT count(DISTINCT TS_name) AS emails_sent, count(*) AS total_alerts FROM x_ts_alerts)"""
FINAL["chat_digest_as"] = messages("""
  SELECT ranking, CASE ranking WHEN 'TIER 1' THEN '#alerts_t1' ELSE '#alerts_t2' END AS channel, combo AS subject,
         combo || '   -   ' || string_agg('`' || upper(kpi) || '`', '  ' ORDER BY AS_name, kpi_rank) AS line
  FROM x_as_recap GROUP BY ranking, combo""", ["ranking", "channel"], "*Business alert(s)* sent to AS", "business")
FINAL["chat_digest_ts"] = messages("""
  SELECT '#tags' AS channel, partner_name AS subject, partner_name || '   -   ' || string_agg(
           '`' || upper(event_name[1]) || event_name[2:] || ' on ' || upper(site_type) || '`', '  ' ORDER BY event_name, site_type) AS line
  FROM (SELECT DISTINCT partner_name, event_name, site_type FROM x_ts_alerts) GROUP BY partner_name""",
  ["channel"], "*Technical alert(s)* sent to TS", "technical")
FINAL["alert_chart_series"] = """
SELECT combo, AS_name, AS_email, currency_code, day, kpi, round(value, 9) + 0.0e0 AS value FROM x_chart_long"""
FINAL["chart_axis_spec"] = "SELECT * REPLACE (round(step, 6) AS step, round(y_max, 6) + 0.0e0 AS y_max, round(y_min, 6) + 0.0e0 AS y_min) FROM x_axis"
FINAL["chart_axis_spec_ts"] = "SELECT * REPLACE (round(step, 6) AS step, round(y_max, 6) + 0.0e0 AS y_max, round(y_min, 6) + 0.0e0 AS y_min) FROM x_ts_axis"


def _account_feedback(answer: str) -> str:
    return link(DELIVERY.feedback_base, {
        "series": "combo", "username": "split_part(AS_email, '@', 1)", "client_id": "client_id", "run_date": "'2024-03-01'",
        "kpi": "CASE WHEN kpi = 'rext' THEN 'client_rext' ELSE kpi END", "is_alert": f"'{answer}'", "client_name": "combo",
        "cost_center": "cost_center", "ranking": "ranking", "country": "country", "subregion": "subregion", "region": "region"})


def _tag_feedback(answer: str) -> str:
    return link(DELIVERY.feedback_base, {
        "series": "partner_name || ' ' || event_name || ' on ' || site_type", "partner_name": "partner_name",
        "partner_id": "partner_id", "site_type": "site_type", "event_name": "event_name", "kpi": "'tag_events'",
        "run_date": "'2024-03-01'", "username": "split_part(ts_engineer_email, '@', 1)", "cost_center": "ts_cost_center",
        "ranking": "ranking", "country": "ts_country", "subregion": "ts_subregion", "region": "ts_region",
        "is_alert": f"'{answer}'"})


FINAL["feedback_links"] = f"""
SELECT AS_email, combo, kpi, {_account_feedback("true")} AS true_link, {_account_feedback("false")} AS false_link,
       {link(DELIVERY.investigation_base, {"kpi": "kpi", "start_date": "'2024-02-14'", "end_date": "'2024-02-29'", "client_id": "client_id"})}
       AS explore_link, '{DELIVERY.account_url_prefix}' || client_id || '{DELIVERY.account_url_suffix}' AS dashboard_link
FROM x_as_alerts"""
FINAL["feedback_links_ts"] = f"""
SELECT ts_engineer_email, combo, CASE site_type WHEN 'd' THEN 'Desktop' WHEN 'm' THEN 'Mobile' ELSE 'Unknown' END AS site_name,
       {_tag_feedback("True")} AS true_link, {_tag_feedback("False")} AS false_link,
       {link(DELIVERY.investigation_base, {"partner_id": "partner_id", "start_date": "'2024-02-14'", "end_date": "'2024-02-29'", "kpi": "'site_events'"})}
       AS explore_link,
       {link(DELIVERY.dashboard_base, {"partner_name": "partner_name", "event_name": "CASE event_name WHEN 'homepage' THEN 'page' ELSE event_name END"})}
       AS dashboard_link
FROM x_ts_alerts"""
FINAL["format_report"] = f"""
SELECT combo, {title_text("AS_name")} AS owner, {number_text("clicks", 0)} AS clicks,
       {currency_text("rext", "'+'", "", "currency_code")} AS margin, {currency_text("spend")} AS spend,
       {percent_text("cos")} AS cos, {percent_text("ctr", True, 1)} AS ctr, {compact_text("order_value")} AS order_value,
       'Thu 29 Feb 2024' AS day_text
FROM (SELECT *, CASE WHEN order_value = 0 THEN 0 ELSE spend / order_value END AS cos,
             CASE WHEN displays = 0 THEN 0 ELSE clicks / displays END AS ctr FROM x_union WHERE day = {Y})"""
FINAL["bps_change"] = f"""
SELECT combo, round(change, 4) AS change, CASE WHEN round_even(change, 0) > 0 THEN '+' ELSE '' END || {number_text("round_even(change, 0)", 0)} || ' bps' AS change_text
FROM (SELECT combo, (max(cos) FILTER (day = {Y}) - max(cos) FILTER (day = {Y} - 1)) * 10000 AS change FROM x_eligible GROUP BY combo)
WHERE change IS NOT NULL"""
_RANKINGS = """(SELECT TS_name, partner_id, string_agg(ranking, ', ' ORDER BY ranking) AS ranking
      FROM (SELECT DISTINCT TS_name, partner_id, ranking FROM x_ts_alerts) GROUP BY TS_name, partner_id)"""
FINAL["ts_alert_doc"] = f"""
WITH e AS (SELECT TS_name, ts_engineer_email, manager_name, ts_cost_center, ts_subregion, partner_name, partner_id, site_type,
                  list({{'event_name': event_name, 'graph': partner_id || '_' || site_type || '_' || event_name || '.png'}} ORDER BY event_name) AS event
           FROM (SELECT DISTINCT TS_name, ts_engineer_email, manager_name, ts_cost_center, ts_subregion, partner_name, partner_id,
                        site_type, event_name FROM x_ts_alerts) GROUP BY ALL)
SELECT TS_name AS name, ts_engineer_email AS email, manager_name, ts_cost_center AS cost_center, ts_subregion AS subregion, ranking,
       partner_name, partner_id, CAST(count(*) AS INTEGER) AS n_sites, CAST(sum(len(event)) AS INTEGER) AS n_events,
       CAST(to_json(list({{'site': site_type, 'event': event}} ORDER BY site_type)) AS VARCHAR) AS alerts
FROM e JOIN {_RANKINGS} r USING (TS_name, partner_id) GROUP BY ALL"""
FINAL["ts_alert_flatten"] = f"""
SELECT DISTINCT TS_name AS name, ts_engineer_email AS email, manager_name, manager_email, ts_cost_center AS cost_center,
       ts_country AS country, ts_subregion AS subregion, ts_region AS region, r.ranking, {T} AS run_date, partner_name, partner_id,
       site_type AS site, event_name, partner_id || '_' || site_type || '_' || event_name || '.png' AS graph
FROM x_ts_alerts a JOIN {_RANKINGS} r USING (TS_name, partner_id)"""
FINAL["as_owner_doc"] = f"""
SELECT AS_email, AS_name, client_no, combo, client_id, color_slot, CAST(count(*) AS INTEGER) AS n_alerts,
       CAST(to_json(list({{'kpi_rank': kpi_rank, 'kpi': kpi, 'last_label': last_label}} ORDER BY kpi_rank)) AS VARCHAR) AS alerts
FROM ({FINAL["as_owner_digest"].replace("WITH c AS", "WITH c AS", 1)}) GROUP BY ALL"""
FINAL["ts_recap"] = "SELECT * FROM x_ts_alerts"
FINAL["territory_alert_text"] = "SELECT * FROM x_territory_text"
FINAL["territory_report"] = f"""
SELECT series, {currency_text("expected")} AS "avg_last_7D", {currency_text("actual")} AS "yesterday_RexT",
       {percent_text("(actual - expected) / expected", True)} AS differences
FROM (SELECT e.series, expected, RexT AS actual
      FROM (SELECT series, avg(RexT) AS expected FROM x_territory_filled WHERE day < {Y} AND day >= {Y} - 7 GROUP BY series) e
      JOIN (SELECT series, RexT FROM x_territory_filled WHERE day = {Y}) a USING (series))"""
FINAL["territory_chart"] = f"""
SELECT CASE WHEN series IN ('AMERICAS', 'NORTH AMERICA', 'LATAM') THEN 'americas' WHEN series IN ('US', 'CANADA') THEN 'na'
            ELSE 'latam' END AS chart, series, day, round_even(RexT, 2) + 0.0e0 AS RexT,
       CASE WHEN day IN ({Y}, {Y} - 1) THEN {currency_text("round_even(RexT, 2)")} END AS label
FROM x_territory_filled
WHERE day > {Y} - 15 AND series IN ('AMERICAS', 'NORTH AMERICA', 'LATAM', 'US', 'CANADA', 'ARGENTINA', 'BRAZIL', 'CHILE',
                                    'COLOMBIA', 'MEXICO', 'SAM OTHER')"""
FINAL["territory_highlight"] = """
SELECT region, locale, contains(alerts, locale) AS is_highlighted
FROM x_territory_text CROSS JOIN (VALUES ('americas', 'AMERICAS'), ('na', 'NORTH AMERICA'), ('latam', 'LATAM'), ('us', 'US'),
  ('canada', 'CANADA'), ('brazil', 'BRAZIL'), ('sam', 'SAM'), ('argentina', 'ARGENTINA'), ('chile', 'CHILE'),
  ('colombia', 'COLOMBIA'), ('mexico', 'MEXICO')) AS v(region, locale)"""
FINAL["gainers_losers"] = f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY region, side ORDER BY magnitude DESC, client_name) AS position
           FROM (SELECT *, CASE WHEN percent_diff > 0 THEN 'gainers' ELSE 'losers' END AS side FROM x_account_alerts)),
     late AS (SELECT count(*) = 0 AS is_late FROM x_account)
SELECT s.region, s.side, CAST(s.position AS INTEGER) AS position,
       coalesce(client_name, CASE WHEN is_late THEN 'DATA IS LATE' ELSE '' END) AS client,
       coalesce({currency_text("r.actual")}, '') AS actual, coalesce({currency_text("r.expected")}, '') AS expected,
       coalesce({percent_text("r.percent_diff", True)}, '') AS percent_diff,
       coalesce(CASE s.side WHEN 'gainers' THEN '+' ELSE '-' END || {currency_text("r.magnitude")}, '') AS deviation
FROM (SELECT region, side, position FROM (VALUES ('NORTH AMERICA'), ('LATAM')) AS a(region)
      CROSS JOIN (VALUES ('gainers'), ('losers')) AS b(side) CROSS JOIN generate_series(1, 5) AS c(position)) s
CROSS JOIN late
LEFT JOIN r ON r.region = s.region AND r.side = s.side AND r.position = s.position"""

_EXPORT_AS = f"""
SELECT * FROM (SELECT * REPLACE (round(value, 9) + 0.0e0 AS value), 'N/A' AS event_name, 'N/A' AS site_type,
       CAST(-1 AS BIGINT) AS partner_id, 'N/A' AS partner_name, {T} AS run_date FROM x_export_as)"""
FINAL["export_as"] = f"SELECT {EXPORT_COLUMNS} FROM ({_EXPORT_AS})"
FINAL["export_ts"] = f"""
SELECT {EXPORT_COLUMNS} FROM (SELECT *, 'N/A' AS client_name, CAST(-11 AS BIGINT) AS client_id, CAST(-1 AS BIGINT) AS campaign_id,
  'N/A' AS campaign_name, 'N/A' AS campaign_scenario, 'N/A' AS campaign_type_name, -11 AS campaign_revenue_type,
  -11 AS campaign_funnel_id, {T} AS run_date FROM x_export_ts)"""
FINAL["export_territory"] = f"""
SELECT {EXPORT_COLUMNS} FROM (SELECT *, 'territory_rext' AS kpi, 'N/A' AS client_name, CAST(-11 AS BIGINT) AS client_id,
  'N/A' AS global_account_name, 'N/A' AS RTC_vertical, 'N/A' AS vertical_name, CAST(-1 AS BIGINT) AS partner_id,
  'N/A' AS partner_name, CAST(-1 AS BIGINT) AS campaign_id, 'N/A' AS campaign_name, 'N/A' AS campaign_scenario,
  'N/A' AS campaign_type_name, -11 AS campaign_revenue_type, -11 AS campaign_funnel_id, 'N/A' AS cost_center,
  'TIER 1' AS ranking, 'N/A' AS event_name, 'N/A' AS site_type, {T} AS run_date FROM x_export_territory)"""
FINAL["export_filter"] = f"""
WITH e AS ({FINAL["export_as"]}),
     y AS (SELECT * FROM e SEMI JOIN (SELECT series, kpi FROM e WHERE day = run_date - 1) USING (series, kpi))
SELECT * FROM y SEMI JOIN (SELECT series, run_date, kpi FROM y GROUP BY ALL HAVING count(*) >= 3) USING (series, kpi)"""
FINAL["freshness_gate"] = f"""
SELECT table_name, table_name NOT IN (SELECT table_name FROM x_import_reports
         WHERE update_time >= TIMESTAMP '2024-03-01' AND table_schema IN ('schema_1', 'schema_2')) AS is_late
FROM (SELECT unnest([{quoted(REQUIRED_TABLES)}]) AS table_name)"""
FINAL["run_history_gate"] = f"""
SELECT DISTINCT script, geo FROM x_run_history ANTI JOIN (SELECT * FROM x_run_history WHERE run_date = {T}) USING (script, geo)"""

_OUTBOX = 'product, kind, "to", cc, bcc, subject, body, run_date'
FINAL["notification_outbox"] = f"""
SELECT {_OUTBOX} FROM (
  SELECT DISTINCT 'AS' AS product, 'alert' AS kind, AS_email AS "to", CAST(NULL AS VARCHAR) AS cc, '{DELIVERY.maintainers}' AS bcc,
         'KPI AS Alert for ' || {title_text("AS_name")} AS subject, CAST(NULL AS VARCHAR) AS body, {T} AS run_date FROM x_as_alerts
  UNION ALL
  SELECT 'AS', 'summary', '{DELIVERY.maintainers}', CASE ranking WHEN 'TIER 1' THEN 'leads@example.test' END, NULL,
         'KPI Alerts {DELIVERY.geo} ' || ranking || ' Daily Stats {DAY}', {BODY}, {T} FROM x_as_summary)
ANTI JOIN x_sent_history USING (run_date, "to", subject)"""
FINAL["notification_outbox_ts"] = f"""
SELECT {_OUTBOX} FROM (
  SELECT DISTINCT 'TS' AS product, 'alert' AS kind, ts_engineer_email AS "to", CAST(NULL AS VARCHAR) AS cc,
         '{DELIVERY.maintainers}' AS bcc, 'TS Alert for ' || replace({title_text("TS_name")}, '-ann ', '-Ann ') AS subject, CAST(NULL AS VARCHAR) AS body,
         {T} AS run_date FROM x_ts_alerts
  UNION ALL
  SELECT 'TS', 'summary', '{DELIVERY.maintainers}', NULL, NULL, 'KPI TS Alerts {DELIVERY.geo} Daily Stats {DAY}', {BODY}, {T}
  FROM (SELECT count(DISTINCT TS_name) AS emails_sent, count(*) AS total_alerts FROM x_ts_alerts))
ANTI JOIN x_sent_history USING (run_date, "to", subject)"""

FINAL["notification_outbox_exec"] = f"""
SELECT 'EXEC' AS product, 'alert' AS kind, '{DELIVERY.recipients}' AS "to", CAST(NULL AS VARCHAR) AS cc, CAST(NULL AS VARCHAR) AS bcc,
       '{DELIVERY.geo} KPI Alert' AS subject, alerts AS body, {T} AS run_date FROM x_territory_text"""
FINAL["trouble_notices"] = f"""
WITH e AS (SELECT geo, CASE script WHEN 'job_f' THEN 'AS' WHEN 'job_o' THEN 'TS' ELSE 'EXEC' END AS product,
                  ['no_alerts', 'late', 'error'][CAST(substr(geo, 5) AS INTEGER) % 3 + 1] AS kind
           FROM ({FINAL["run_history_gate"]})),
     s AS (SELECT *, mode, 'KPI ' || product || ' ' || geo AS scope,
                  CASE product WHEN 'AS' THEN 'business' WHEN 'TS' THEN 'technical' ELSE 'executive' END AS tone
           FROM e CROSS JOIN (VALUES ('usual'), ('test')) AS m(mode))
SELECT product, kind, geo, mode,
       CASE WHEN mode = 'test' THEN '{DELIVERY.test_email}' WHEN kind = 'no_alerts' THEN '{DELIVERY.maintainers}' ELSE '{DELIVERY.alias}' END AS "to",
       CASE WHEN mode = 'usual' AND kind <> 'no_alerts' THEN '{DELIVERY.maintainers}' END AS bcc,
       CASE mode WHEN 'test' THEN '[TEST] ' ELSE '' END || CASE kind WHEN 'no_alerts' THEN 'No Alerts to Send for ' || scope
         WHEN 'late' THEN 'Data Delayed -- No ' || scope || ' Alerts' ELSE scope || ' Alerts Unable to Run Today' END AS subject,
       CASE kind WHEN 'no_alerts' THEN 'No _' || tone || '_ alerts to send for today :grinning:'
         WHEN 'late' THEN '_' || tone || '_ alerts can''t be sent today because data is late :cry:'
         ELSE product || ' can''t run today due to issues querying the warehouse :disappointed:' END AS chat,
       CASE mode WHEN 'test' THEN '{DELIVERY.test_channel}' ELSE '#alerts_t1 #alerts_t2' END AS channels
FROM s"""


FINAL["committed_mails"] = FINAL["notification_outbox"]
#: Quantiles of the chi-square distribution with one degree of freedom, from tables.
_CRITICAL = {0.5: 0.454936423119572, 0.9: 2.705543454095404, 0.99: 6.634896601021213, 0.999: 10.827566170662733}
FINAL["detector_levels"] = f"""
SELECT combo, confidence, coalesce(score > critical, false) AS is_outlier,
       is_material AND enough_rows AND ends_yesterday AND coalesce(score > critical, false) AND ((below_fence AND fell) OR (above_fence AND rose)) AS is_alert
FROM x_as_flags CROSS JOIN (VALUES {", ".join(f"({c!r}e0, {q!r}e0)" for c, q in _CRITICAL.items())}) AS v(confidence, critical) WHERE kpi = 'spend'"""
FINAL["quarantine"] = """
SELECT employee_id, CASE WHEN NOT bad THEN full_name END AS full_name, CASE WHEN NOT bad THEN email END AS email, bad AS is_rejected
FROM (SELECT *, employee_id % 10 = 3 AS bad FROM x_employee)"""


def oracle_sql() -> dict[str, str]:
    filtered = {"param_filter": {"employees": EMPLOYEE_FILTER, "clients": CLIENT_FILTER}}
    return {name: statement(final, **filtered.get(name, {})) for name, final in FINAL.items()}
