"""The star schema derived from the benchmark tables.

All amounts are whole numbers and all rates are binary fractions, so sums are
exact in double precision and do not depend on the order of addition.

What happens to a client depends on the last digit of its id:
1 four times the usual on the last day, 2 a sixteenth of it, 3 cost of media up
by half on the last day, 4 nothing on the last day, 5 odd days only, 6 a gap of
two days, 7 cost always above revenue, 8 no vertical, 9 an excluded vertical.
20 January is missing everywhere. Half of the clients with digit 1 have a second owner for campaign 1, without facts on
the last day; with digit 8 one campaign has only the one vertical and the other only the other; names with digit 5 hold
quotes, commas, blanks and a line break.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from pulsewatch.sources.warehouse import Star

TODAY = date(2024, 3, 1)
YESTERDAY = date(2024, 2, 29)

_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_nationkey INT, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING",
}

_LAST = "day = DATE '2024-02-29'"
_GAPS = f"""NOT (digit = 4 AND {_LAST})
  AND NOT (digit = 5 AND dayofyear(day) % 2 = 0 AND day < DATE '2024-02-28')
  AND NOT (digit = 6 AND day IN (DATE '2024-02-15', DATE '2024-02-16'))"""
_LAST_DAY_FACTOR = f"CASE WHEN {_LAST} AND digit = 1 THEN 4D WHEN {_LAST} AND digit = 2 THEN 0.0625D ELSE 1D END"
_TAC_FACTOR = f"CASE WHEN {_LAST} AND digit = 3 THEN 1.5D WHEN digit = 7 THEN 1.25D ELSE 1D END"
_PRICE = "CAST(floor(l_extendedprice) AS DOUBLE)"
_COST = f"CAST(floor({_PRICE} * (1 - l_discount)) AS DOUBLE)"
_ALL_DAYS = "explode(sequence(DATE '2024-01-01', DATE '2024-02-29')) AS day"


def _employee(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "c_custkey AS employee_id", "concat(c_mktsegment, if(c_custkey % 7 = 3, '-ANN', ''), ' C', c_custkey) AS full_name",
        "lower(concat(c_mktsegment, '.', c_custkey, '@example.test')) AS email", "CAST(c_nationkey AS STRING) AS country",
        "if(c_nationkey % 5 = 1, 'LM', 'US') AS cost_center_country",
        "elt(c_custkey % 3 + 1, 'FIELD', 'OFFICE', 'OTHER') AS cost_center_activity",
        "if(c_custkey % 2 = 0, 'T1 STRATEGIST', 'T2 STRATEGIST') AS job_name",
        "if(c_custkey % 25 <> 24, c_custkey div 10, NULL) AS direct_reports_id")


def _client(supplier: DataFrame) -> DataFrame:
    rows = supplier.selectExpr("*", "s_suppkey % 10 AS digit", "s_nationkey % 8 AS place", "explode(array(0, 1)) AS c")
    return rows.selectExpr(
        "s_suppkey AS client_id", "concat('client ', s_suppkey) AS client_name", "s_suppkey * 10 + c AS campaign_id",
        "if(digit = 5, concat(' ', char(34), 'camp, aign', char(34), char(10), c, ' '), concat('campaign ', c)) AS campaign_name",
        "s_suppkey div 3 + if(s_suppkey % 20 = 1, c, 0) AS account_strategist_employee_id",
        "s_suppkey div 4 AS ts_engineer_employee_id", "CAST(1 + s_suppkey % 5 AS INT) AS client_currency_id",
        "s_suppkey AS partner_id", "concat('partner ', s_suppkey) AS partner_name",
        "if(s_suppkey % 3 = 0, 'TIER 2', 'TIER 1') AS ranking",
        "if(c = 0, 'WEB', 'APP') AS campaign_scenario_product_level_1_name",
        "if(s_suppkey % 2 = 0, 'CONVERSION', 'TRAFFIC') AS campaign_type_name",
        "CAST(s_suppkey % 4 AS INT) AS campaign_revenue_type", "1 + c AS campaign_funnel_id",
        "if(digit = 8, if(c = 1, 'either', NULL), concat('vertical ', s_suppkey % 6)) AS vertical_name",
        "if(digit = 8, if(c = 0, 'either', NULL), concat('group ', s_suppkey % 2)) AS vertical_level_2_name",
        "CASE digit WHEN 8 THEN NULL WHEN 9 THEN 'FILLER' ELSE 'RETAIL' END AS vertical_level_3_name",
        "concat('global ', s_suppkey % 7) AS global_account_name",
        "elt(place + 1, 'US', 'CANADA', 'BRAZIL', 'ARGENTINA', 'MEXICO', 'PERU', 'CHILE', 'FRANCE') AS client_country_name",
        "elt(place + 1, 'US', 'CANADA', 'BRAZIL', 'SOUTH AMERICA', 'SOUTH AMERICA', 'SOUTH AMERICA', 'SOUTH AMERICA', "
        "'FRANCE') AS client_country_level_1_name",
        "CASE WHEN place < 2 THEN 'NORTH AMERICA' WHEN place = 7 THEN 'SEMEA' ELSE 'LATAM' END "
        "AS client_country_level_2_name",
        "if(place = 7, 'EMEA', 'AMERICAS') AS client_country_level_3_name")


def _stats(lineitem: DataFrame) -> DataFrame:
    rows = lineitem.selectExpr(
        "date_sub(DATE '2024-03-01', CAST(1 + l_orderkey % 60 AS INT)) AS day", "l_suppkey AS client_id",
        "l_suppkey % 10 AS digit", "l_suppkey * 10 + l_linenumber % 2 AS campaign_id",
        "CAST(1 + l_partkey % 5 AS INT) AS affiliate_currency_id", "l_quantity AS q", f"{_PRICE} AS p", f"{_COST} AS cost",
        f"CAST(floor({_PRICE} * 5 * (1 + l_tax)) AS DOUBLE) AS ov")
    rows = rows.where("day <> DATE '2024-01-20'").where(_GAPS).where(f"NOT (client_id % 20 = 1 AND campaign_id % 10 = 1 AND {_LAST})")
    rows = rows.selectExpr("*", f"p * {_LAST_DAY_FACTOR} AS revenue", f"cost * {_LAST_DAY_FACTOR} * {_TAC_FACTOR} AS media")
    return rows.selectExpr(
        "day", "campaign_id", "client_id", "q * 20 AS displays", "q AS clicks",
        "CAST(floor(q / 5) AS DOUBLE) AS sales_all_post_click", "ov AS order_value_all_post_click_local",
        "revenue AS revenue_local", "media AS tac_local", "revenue * 0.875D AS revenue_euro", "media * 0.875D AS tac_euro",
        "affiliate_currency_id",
        # some facts were loaded twice
        "explode(if(q >= 45, array(0, 1), array(0))) AS copy").drop("copy")


def _stats_2(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    rows = lineitem.join(supplier.withColumnRenamed("s_suppkey", "l_suppkey"), "l_suppkey").selectExpr(
        "date_sub(DATE '2024-03-01', CAST(1 + l_orderkey % 30 AS INT)) AS day", "l_suppkey % 10 AS digit",
        "s_nationkey % 8 AS place", "l_suppkey * 10 + l_linenumber % 2 AS campaign_id",
        "CAST(1 + l_partkey % 5 AS INT) AS affiliate_currency_id", f"{_PRICE} AS p", f"{_COST} AS cost")
    return rows.where(_GAPS).selectExpr(
        "day", "campaign_id", f"cost * {_LAST_DAY_FACTOR} * {_TAC_FACTOR} AS tac_local",
        f"p * {_LAST_DAY_FACTOR} * if({_LAST} AND place = 2, 8D, 1D) AS revenue_local", "affiliate_currency_id")


def _pairs(region: DataFrame) -> DataFrame:
    """Currency pairs: every region stands for a currency."""
    return region.selectExpr("r_regionkey + 1 AS source_currency_id", "explode(array(1, 2, 3, 4, 5)) AS destination_currency_id")


def _fx_daily(region: DataFrame) -> DataFrame:
    rows = _pairs(region).selectExpr("*", _ALL_DAYS)
    return rows.where("NOT (source_currency_id = 3 AND destination_currency_id = 1 AND dayofyear(day) % 7 = 0)").selectExpr(
        "source_currency_id", "destination_currency_id", "day",
        "if(source_currency_id = destination_currency_id, 1D, 1D + 0.125D * (source_currency_id - destination_currency_id) "
        "+ (dayofyear(day) % 5) / 1024D) AS rate")


def _fx_year(region: DataFrame) -> DataFrame:
    return _pairs(region).where("source_currency_id <> 3").selectExpr("*", "2024 AS year_code", "explode(array(0, 1)) AS forecast_type_id").selectExpr(
        "*", "1D + 0.125D * (source_currency_id - destination_currency_id) + forecast_type_id * 8 AS rate")


def _events(events: DataFrame) -> DataFrame:
    tags = events.selectExpr(
        "user_id AS partner_id",
        "CASE WHEN event_id % 3 = 0 THEN 'm' WHEN event_id % 3 = 1 AND user_id % 10 = 3 THEN 'unknown' ELSE 'd' END AS site_type",
        "CASE event_type WHEN 'view' THEN 'page' WHEN 'click' THEN 'itempageview' WHEN 'purchase' THEN 'sales' "
        "WHEN 'signup' THEN 'basket' ELSE 'homepage' END AS event_name")
    rows = tags.groupBy("partner_id", "site_type", "event_name").count().selectExpr(
        "*", "partner_id % 10 AS digit", _ALL_DAYS)
    rows = rows.where("day <> DATE '2024-01-20' AND NOT (digit = 6 AND day = DATE '2024-02-15')").selectExpr(
        "*", "400 + (dayofyear(day) * 37 + partner_id * 11 + count) % 60 AS usual")
    return rows.selectExpr(
        "partner_id", "day", "site_type", "event_name",
        f"CASE WHEN {_LAST} AND digit = 1 AND site_type = 'm' THEN usual div 5 "
        f"WHEN {_LAST} AND digit = 2 AND event_name = 'sales' THEN 0 ELSE usual END AS events")


def _import_reports(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg({"ts": "max"}).selectExpr(
        "'schema_1' AS table_schema", "concat(event_type, '_table') AS table_name",
        "timestampadd(DAY, if(event_type = 'error', 29, 31), date_trunc('day', `max(ts)`)) AS update_time")


def _run_history(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "date_sub(DATE '2024-03-01', CAST(o_orderkey % 40 AS INT)) AS run_date",
        "concat('job_', lower(o_orderstatus)) AS script", "concat('geo ', o_custkey) AS geo").distinct()


def _sent_history(employee: DataFrame) -> DataFrame:
    return employee.where("employee_id % 5 = 2").selectExpr(
        "DATE '2024-03-01' AS run_date", "email AS to", "concat('KPI AS Alert for ', initcap(full_name)) AS subject")


def sample_star(spark: SparkSession, sf_dir: str) -> Star:
    def table(name: str) -> DataFrame:
        return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")

    return Star(
        employee=lambda: _employee(table("customer")),
        client=lambda: _client(table("supplier")),
        currency=lambda: table("region").selectExpr(
            "r_regionkey + 1 AS currency_id", "elt(r_regionkey + 1, 'EUR', 'USD', 'BRL', 'JPY', 'GBP') AS currency_code"),
        country=lambda: table("nation").join(table("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
        .selectExpr("CAST(n_nationkey AS STRING) AS country_code", "n_name AS country_level_1_name",
                    "concat(r_name, ' AREA') AS country_level_2_name", "r_name AS country_level_3_name"),
        stats=lambda: _stats(table("lineitem")),
        stats_2=lambda: _stats_2(table("lineitem"), table("supplier")),
        fx_daily=lambda: _fx_daily(table("region")),
        fx_year=lambda: _fx_year(table("region")),
        events=lambda: _events(table("events")),
        import_reports=lambda: _import_reports(table("events")),
        run_history=lambda: _run_history(table("orders")),
        sent_history=lambda: _sent_history(_employee(table("customer"))))
