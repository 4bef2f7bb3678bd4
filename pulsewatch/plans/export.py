"""Long export of all series for the labelling tool."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsewatch import params as P
from pulsewatch.functions.cleaning import clean_data, with_kpi_ratios
from pulsewatch.operators.calendar import calendar_fill
from pulsewatch.operators.quantiles import oversized_keys
from pulsewatch.operators.reshape import unpivot_kpis
from pulsewatch.operators.series_state import calendar_of, filled, oversized_series, series_rows
from pulsewatch.plans.features import account_series, reported_partners, row_id, tag_counts, territory_daily, with_attributes
from pulsewatch.plans.territory import territory_paths
from pulsewatch.sources.stage import stage
from pulsewatch.sources.warehouse import Star

# ---- fixed values: export columns and the KPIs of the account export --------
EXPORT_SCHEMA = T.StructType([
    T.StructField("series", T.StringType()), T.StructField("client_name", T.StringType()),
    T.StructField("client_id", T.LongType()), T.StructField("global_account_name", T.StringType()),
    T.StructField("RTC_vertical", T.StringType()), T.StructField("vertical_name", T.StringType()),
    T.StructField("partner_id", T.LongType()), T.StructField("partner_name", T.StringType()),
    T.StructField("campaign_id", T.LongType()), T.StructField("campaign_name", T.StringType()),
    T.StructField("campaign_scenario", T.StringType()), T.StructField("campaign_type_name", T.StringType()),
    T.StructField("campaign_revenue_type", T.IntegerType()), T.StructField("campaign_funnel_id", T.IntegerType()),
    T.StructField("cost_center", T.StringType()), T.StructField("ranking", T.StringType()),
    T.StructField("country", T.StringType()), T.StructField("subregion", T.StringType()),
    T.StructField("region", T.StringType()), T.StructField("site_type", T.StringType()),
    T.StructField("event_name", T.StringType()), T.StructField("day", T.DateType()),
    T.StructField("run_date", T.DateType()), T.StructField("kpi", T.StringType()),
    T.StructField("value", T.DoubleType())])
ACCOUNT_EXPORT_KPIS = ["clicks", "displays", "conversions", "spend", "tac", "client_rext", "rext_euro",
                       "order_value", "cos", "ctr", "cr", "margin"]
#: A series with more attribute rows is joined row by row.
MOST_ATTRIBUTES = 50
OWNER_COLUMNS = ("AS_name", "AS_email", "manager_name", "manager_email", "currency_code")
# -----------------------------------------------------------------------------


def export_rows(df: DataFrame, p: P.RunParams, constants: dict) -> DataFrame:
    """Bring a long frame to the export columns; ``constants`` fill the others."""
    constants = {**constants, "run_date": p.today}
    return df.select(*[
        (F.lit(constants[f.name]) if f.name in constants else F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in EXPORT_SCHEMA.fields])


def export_accounts(star: Star, p: P.RunParams) -> DataFrame:
    """Client totals and campaigns with filled calendars.

    A series is one row from the exchange of its daily rows to the output: fill and attributes are met there. Only series in too
    many rows, or of too many attribute rows, take the way of ``calendar_fill`` and a join of every daily row.
    """
    series = account_series(star, replace(p, beta_emails=None), without=OWNER_COLUMNS)
    daily = stage(series.daily, "account-daily")
    rows = clean_data(with_kpi_ratios(daily)).withColumnRenamed("rext", "client_rext")
    metrics = [k for k in ACCOUNT_EXPORT_KPIS if k != "rext_euro"]
    attributes = clean_data(series.attributes).distinct()
    large = _large_series(rows, attributes, p.oversized_rows)
    calendar = calendar_of(rows.select("day"))
    usual = rows if large is None else rows.join(large, "combo", "left_anti")
    shown = [c for c in attributes.columns if c != "combo"]
    named = attributes.groupBy("combo").agg(F.collect_list(F.struct(*shown)).alias("attributes"))
    state = filled(series_rows(usual, "combo").join(named, "combo"), "combo", metrics, calendar, beside=("attributes",))
    alone = F.size("attributes") == 1
    each = state.select("combo", "rows", alone.alias("alone"), F.explode("attributes").alias("a"))
    own = F.when(F.col("alone"), F.col("rows")).otherwise(F.filter("rows", lambda r: r["attributes_id"] == F.col("a.attributes_id")))
    texts = [c for c in shown if c != "attributes_id"]
    each = each.select("combo", *[f"a.{c}" for c in texts], F.inline(own))
    wide = each.select(*rows.columns, *texts)
    if large is not None:
        big = calendar_fill(rows.join(large, "combo", "left_semi"), "combo", metrics, large, calendar)
        wide = wide.unionByName(with_attributes(big, attributes))
    wide = wide.withColumnRenamed("combo", "series")
    ids = [f.name for f in EXPORT_SCHEMA.fields if f.name in wide.columns]
    return export_rows(unpivot_kpis(wide, ids, ACCOUNT_EXPORT_KPIS), p, {
        "event_name": P.NOT_APPLICABLE, "site_type": P.NOT_APPLICABLE,
        "partner_id": -1, "partner_name": P.NOT_APPLICABLE})


def _large_series(rows: DataFrame, attributes: DataFrame, limit: int) -> DataFrame | None:
    """Series with more than ``limit`` rows or ``MOST_ATTRIBUTES`` attribute rows, or None."""
    many = attributes.groupBy("combo").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MOST_ATTRIBUTES).select("combo")
    long = oversized_series(rows.select("combo"), "combo", limit)
    large = stage(many if long is None else many.unionByName(long).distinct(), "large-series")
    return None if large.isEmpty() else large


def export_tags(star: Star, p: P.RunParams) -> DataFrame:
    """Tags and sites of the live partners; the texts of a partner are joined to the filled rows."""
    live = clean_data(reported_partners(star, p)).select(
        "partner_name", "partner_id", "ranking", F.col("ts_cost_center").alias("cost_center"),
        F.col("ts_country").alias("country"), F.col("ts_subregion").alias("subregion"),
        F.col("ts_region").alias("region"), "RTC_vertical", "vertical_name", "global_account_name").distinct()
    # of several rows of a partner the fill copies the first in this order
    order = Window.partitionBy("partner_id").orderBy(*live.columns)
    live = stage(live.withColumn("attributes_id", row_id(*live.columns)).withColumn("attributes_no", F.row_number().over(order)), "export-partners")
    tags = (tag_counts(star, p, live).join(live.select("partner_id", "partner_name", "attributes_id", "attributes_no"), "partner_id")
            .select("attributes_id", "attributes_no", "partner_name", "day", F.coalesce("site_type", F.lit("0")).alias("site_type"),
                    F.coalesce("event_name", F.lit("0")).alias("event_name"), F.coalesce("events", F.lit(0)).alias("value")))
    tags = stage(tags.distinct(), "export-tags")
    sites = tags.groupBy("attributes_id", "attributes_no", F.col("partner_name").alias("series"), "day").agg(F.sum("value").alias("value")).withColumns({
        "site_type": F.lit(P.SITE_LEVEL), "event_name": F.lit(P.SITE_LEVEL), "kpi": F.lit("site_events")})
    named = tags.where(~F.col("site_type").contains("unknown")).withColumns({
        "series": F.concat_ws(" ", "partner_name", "event_name", F.lit("on"), "site_type"),
        "kpi": F.lit("tag_events")}).drop("partner_name")
    rows = stage(named.unionByName(sites), "export-series")
    filled = calendar_fill(rows, "series", ["value"], oversized_keys(rows, "series", p.oversized_rows))
    return export_rows(filled.drop("attributes_no").join(live, "attributes_id"), p, {
        "client_name": P.NOT_APPLICABLE, "client_id": -11, "campaign_id": -1, "campaign_name": P.NOT_APPLICABLE,
        "campaign_scenario": P.NOT_APPLICABLE, "campaign_type_name": P.NOT_APPLICABLE,
        "campaign_revenue_type": -11, "campaign_funnel_id": -11})


def export_territories(star: Star, p: P.RunParams) -> DataFrame:
    rows = territory_paths(stage(territory_daily(star, p), "territory-daily")).withColumnRenamed("RexT", "value")
    rows = stage(rows, "export-series")
    filled = calendar_fill(rows, "series", ["value"], oversized_keys(rows, "series", p.oversized_rows))
    return export_rows(filled, p, {
        "kpi": "territory_rext", "client_name": P.NOT_APPLICABLE, "client_id": -11,
        "global_account_name": P.NOT_APPLICABLE, "RTC_vertical": P.NOT_APPLICABLE,
        "vertical_name": P.NOT_APPLICABLE, "partner_id": -1, "partner_name": P.NOT_APPLICABLE,
        "campaign_id": -1, "campaign_name": P.NOT_APPLICABLE, "campaign_scenario": P.NOT_APPLICABLE,
        "campaign_type_name": P.NOT_APPLICABLE, "campaign_revenue_type": -11, "campaign_funnel_id": -11,
        "cost_center": P.NOT_APPLICABLE, "ranking": P.EXEC_RANKING, "event_name": P.NOT_APPLICABLE,
        "site_type": P.NOT_APPLICABLE})


def export_filter(rows: DataFrame, rows_threshold: int = 3, limit: int = P.BROADCAST_KEYS) -> DataFrame:
    """Keep series that reach the day before their run and have enough points; rows without series or kpi go.

    The counts of one pass decide; the rows are read again, so pass a staged frame. The wide rows are not shuffled: hashes of the
    dropped series go to all tasks, and only rows with such a hash meet the names. With more than ``limit`` dropped ones all rows do.
    """
    runs = rows.groupBy("series", "kpi", "run_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("day") == F.date_sub("run_date", 1)).alias("n_last"))
    gone = runs.groupBy("series", "kpi").agg(
        F.max("n").alias("most"), F.sum("n_last").alias("n_last")
    ).where((F.col("n_last") == 0) | (F.col("most") < rows_threshold)).select("series", "kpi")
    gone = stage(gone.where("series IS NOT NULL AND kpi IS NOT NULL").withColumn("__hash", F.xxhash64("series", "kpi")), "export-dropped")
    named = rows.where("series IS NOT NULL AND kpi IS NOT NULL")
    n = gone.count()
    if n == 0:
        return named
    if n > limit:
        return named.join(gone.drop("__hash"), ["series", "kpi"], "left_anti").select(*rows.columns)
    marked, sent = named.withColumn("__hash", F.xxhash64("series", "kpi")), F.broadcast(gone.select("__hash").distinct())
    doubtful = marked.join(sent, "__hash", "left_semi").join(gone.drop("__hash"), ["series", "kpi"], "left_anti")
    return marked.join(sent, "__hash", "left_anti").select(*rows.columns).unionByName(doubtful.select(*rows.columns))
