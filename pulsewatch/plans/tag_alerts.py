"""Site and tag event counts: from daily features to alerts and owner documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewatch import params as P
from pulsewatch.operators.calendar import calendar_fill
from pulsewatch.operators.detector import detector_flags, detector_stats
from pulsewatch.operators.series_state import calendar_of, filled, long_rows, oversized_series, series_rows, state_stats
from pulsewatch.plans.account_alerts import Detection
from pulsewatch.plans.features import TAG_ATTRIBUTES, SeriesFrame, tag_series
from pulsewatch.sources.stage import stage
from pulsewatch.sources.warehouse import Star, require_rows

RESULT_COLUMNS = [*TAG_ATTRIBUTES, "site_type", "event_name", "combo"]


def tag_rows(star: Star, p: P.RunParams) -> SeriesFrame:
    """Tag and site series; the daily rows are staged, the partners already are."""
    series = tag_series(star, p)
    daily = require_rows(stage(series.daily, "tag-daily"), "tag features")
    names = daily.select("combo", "attributes_id", "site_type", "event_name").distinct()
    return SeriesFrame(daily, names.join(series.attributes, "attributes_id"))


def detect_tags(series: SeriesFrame, p: P.RunParams, keep_history: bool = False) -> Detection:
    """Fill the calendar and test every tag and site. A series is one row from the exchange of its daily rows to the outcome; only
    series in too many rows take the way of ``calendar_fill``."""
    daily = series.daily.withColumn("events", F.col("events").cast("double"))
    large = oversized_series(daily.select("combo"), "combo", p.oversized_rows)
    calendar = calendar_of(daily.select("day"))
    usual = daily if large is None else daily.join(large, "combo", "left_anti")
    whole = filled(series_rows(usual, "combo"), "combo", ["events"], calendar)
    if keep_history:
        whole = stage(whole, "filled")
    cleaned = long_rows(whole, "combo", daily.columns)
    stats = state_stats(whole, "combo", ["events"], p.yesterday, [])
    if large is not None:
        more = stage(calendar_fill(daily.join(large, "combo", "left_semi"), "combo", ["events"], large, calendar), "cleaned")
        cleaned = cleaned.unionByName(more)
        stats = stats.unionByName(detector_stats(more, "combo", ["events"], p.yesterday, large))
    flags = detector_flags(stats, {"events": P.rule_for("events")}, p.yesterday)
    results = (series.attributes.select(*RESULT_COLUMNS).distinct()
               .join(flags.select("combo", "is_alert"), "combo")
               .select(*RESULT_COLUMNS, F.lit(p.today).alias("run_date"), "is_alert"))
    return Detection(results, cleaned, flags, series.attributes)


def tag_level(df: DataFrame) -> DataFrame:
    return df.where((F.col("site_type") != P.SITE_LEVEL) & (F.col("event_name") != P.SITE_LEVEL))


def site_level(df: DataFrame) -> DataFrame:
    return df.where((F.col("site_type") == P.SITE_LEVEL) & (F.col("event_name") == P.SITE_LEVEL))


def tag_alerts(results: DataFrame) -> DataFrame:
    """Tag alerts to report, one row per owner and tag."""
    return tag_level(results.where("is_alert").drop("global_account_name").distinct())


def owner_documents(alerts: DataFrame) -> DataFrame:
    """Nested alerts, one document per owner and partner: sites and tags by code.

    A document is bounded by the sites and tags of one partner, whatever an
    owner has to look after; the owner's columns stand beside it.
    """
    owner = ["TS_name", "ts_engineer_email", "manager_name", "manager_email", "ts_cost_center", "ts_country",
             "ts_subregion", "ts_region", "run_date"]
    partner = [*owner, "partner_name", "partner_id"]
    rows = alerts.select(*partner, "ranking", "site_type", "event_name").distinct()
    chart = F.concat(F.concat_ws("_", "partner_id", "site_type", "event_name"), F.lit(".png"))
    sites = rows.groupBy(*partner, "site_type").agg(
        F.collect_set("ranking").alias("rankings"),
        F.sort_array(F.collect_set(F.struct("event_name", chart.alias("graph")))).alias("event"))
    documents = sites.groupBy(*partner).agg(
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("rankings")))), ", ").alias("ranking"),
        F.sort_array(F.collect_list(F.struct(F.col("site_type").alias("site"), "event"))).alias("alerts"))
    return documents.select(
        F.col("TS_name").alias("name"), F.col("ts_engineer_email").alias("email"), "manager_name", "manager_email",
        F.col("ts_cost_center").alias("cost_center"), F.col("ts_country").alias("country"),
        F.col("ts_subregion").alias("subregion"), F.col("ts_region").alias("region"), "ranking", "run_date",
        "partner_name", "partner_id", "alerts")


def flatten_documents(documents: DataFrame) -> DataFrame:
    """One row per alert of the nested documents; alerts without a site are skipped."""
    owner = [c for c in documents.columns if c != "alerts"]
    return (documents.select(*owner, F.explode("alerts").alias("a"))
            .where(F.col("a.site").isNotNull() & (F.col("a.site") != ""))
            .select(*owner, F.col("a.site").alias("site"), F.explode("a.event").alias("e"))
            .select(*owner, "site", "e.event_name", "e.graph"))
