"""Every operator as a named query over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsewatch import params as P
from pulsewatch.functions.cleaning import clean_data, with_kpi_ratios
from pulsewatch.operators.calendar import calendar_fill, last_entries, pad_days
from pulsewatch.operators.detector import detector_flags, detector_stats
from pulsewatch.operators.quantiles import oversized_keys
from pulsewatch.operators.reshape import wide_to_long
from pulsewatch.operators.screening import disqualify, eligibility
from pulsewatch.plans import account_alerts as AS
from pulsewatch.plans import export as E
from pulsewatch.plans import features as X
from pulsewatch.plans import gates as G
from pulsewatch.plans import jobs as J
from pulsewatch.plans import reports as R
from pulsewatch.plans import runs as N
from pulsewatch.plans import tag_alerts as TS
from pulsewatch.plans import territory as EX
from pulsewatch.sources.sample import TODAY, sample_star
from pulsewatch.sources.sinks import read_checked, read_csv, read_documents, write_csv, write_documents
from pulsewatch.sources.stage import stage, stage_path, staging_scope
from pulsewatch.sources.warehouse import SCHEMAS, Star

RUN = P.RunParams(today=TODAY)
DELIVERY = P.DeliveryParams(
    sent_at=datetime(2024, 3, 1, 9, 30), timezone="America/New_York", channels={"tier1": "#alerts_t1", "tier2": "#alerts_t2"}, summary_cc={"tier1": "leads@example.test"},
    alias="team@example.test", recipients="leads@example.test")

# parameters of the filtered queries; the same texts are used in the check statements
EMPLOYEE_FILTER = "length(em.country) = 1 AND em.cost_center_activity <> 'OTHER'"
CLIENT_FILTER = "campaign_type_name = 'CONVERSION'"
LEVELS = (0.5, 0.9, 0.99, 0.999)
REQUIRED_TABLES = ("signup_table", "view_table", "error_table", "refund_table")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles cut to ``digits`` for comparison between engines."""
    return df.select(*[
        (F.round(f.name, digits) + F.lit(0.0)).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name)
        for f in df.schema.fields])


# ---- shared steps -----------------------------------------------------------

def _series(spark: SparkSession, d: str) -> X.SeriesFrame:
    return AS.account_rows(sample_star(spark, d), RUN)


def _eligible(spark: SparkSession, d: str) -> X.SeriesFrame:
    series = _series(spark, d)
    return replace(series, daily=stage(AS.eligible_rows(series.daily, RUN), "eligible"))


def _accounts(spark: SparkSession, d: str) -> AS.Detection:
    return AS.detect_accounts(_series(spark, d), RUN)


def _account_alerts(spark: SparkSession, d: str, leaders: tuple[str, ...] = ()) -> tuple[DataFrame, AS.Detection]:
    """Staged alerts, and what was found with a staged history."""
    p = replace(RUN, pod_leaders=leaders)
    found = AS.detect_accounts(AS.account_rows(sample_star(spark, d), p), p, keep_history=True)
    return stage(AS.account_alerts(found, p), "alerts"), found


def _tags(spark: SparkSession, d: str, keep_history: bool = False) -> TS.Detection:
    return TS.detect_tags(TS.tag_rows(sample_star(spark, d), RUN), RUN, keep_history)


def _tag_alerts(spark: SparkSession, d: str) -> DataFrame:
    return stage(TS.tag_alerts(_tags(spark, d).results), "tag-alerts")


def _territories(spark: SparkSession, d: str) -> EX.Detection:
    return EX.detect_territories(EX.territory_rows(sample_star(spark, d), RUN), RUN)


def _accounts_margin(spark: SparkSession, d: str) -> DataFrame:
    return stage(X.account_daily(sample_star(spark, d), RUN), "account-daily")


# ---- features ---------------------------------------------------------------

@query
def owner_dim(spark, d):
    return X.owner_dim(sample_star(spark, d), RUN)


@query
def fact_dedup(spark, d):
    """Facts per campaign and day before and after removing repeated rows."""
    star = sample_star(spark, d)
    return X.deduplicated_facts(star, RUN).groupBy("campaign_id", "day").agg(
        F.count(F.lit(1)).alias("n_facts"), F.sum("revenue_local").alias("revenue"))


@query
def campaign_daily(spark, d):
    return X.campaign_daily(sample_star(spark, d), RUN)


@query
def campaign_daily_kept(spark, d):
    """From kept daily sums: the day before's run fills the store, today's sums one more day."""
    root, star = stage_path(spark, "store"), sample_star(spark, d)
    star.stats.write.partitionBy("day").parquet(f"{root}/stats")
    stats = spark.read.schema(star.stats.schema).parquet(f"{root}/stats")
    p = replace(RUN, daily_store=f"{root}/kept")
    X.kept_sums(stats.where(F.col("day") < F.lit(RUN.yesterday)), f"{root}/kept/stats", p.days_ago(p.account_window_days + 1),
                lambda rows: X.fact_sums(X.without_repeats(X.campaign_facts(rows), p.broadcast_keys)))
    tables = {name: getattr(star, name) for name in SCHEMAS if name != "stats"}
    return X.campaign_daily(Star(**tables, stats=stats), p)


@query
def param_filter(spark, d):
    p = replace(RUN, employee_filter=EMPLOYEE_FILTER, client_filter=CLIENT_FILTER)
    return X.campaign_daily(sample_star(spark, d), p)


@query
def client_campaign_union(spark, d):
    return rounded(X.account_series(sample_star(spark, d), RUN).wide().select(
        "combo", "campaign_name", "campaign_id", "campaign_scenario", "campaign_revenue_type", "campaign_funnel_id",
        "AS_email", "day", *X.MEASURES, "margin"), 9)


@query
def beta_filter(spark, d):
    emails = tuple(f"{segment}.{i}@example.test" for segment in ("building", "machinery", "household")
                   for i in range(0, 40, 2))
    p = replace(RUN, beta_emails=emails)
    return X.account_series(sample_star(spark, d), p).wide("AS_email").select("combo", "AS_email", "day", "spend", "rext")


@query
def live_partners(spark, d):
    return X.live_partners(sample_star(spark, d), RUN)


@query
def tag_daily(spark, d):
    return X.tag_daily(sample_star(spark, d), RUN)


@query
def territory_daily(spark, d):
    return X.territory_daily(sample_star(spark, d), RUN)


@query
def account_daily(spark, d):
    return X.account_daily(sample_star(spark, d), RUN)


@query
def kpi_ratios(spark, d):
    daily = X.account_series(sample_star(spark, d), RUN).daily
    return rounded(with_kpi_ratios(daily).select("combo", "day", "cos", "ctr", "cr", "margin"), 9)


# ---- cleaning, fill, reshape ------------------------------------------------

@query
def clean_data_query(spark, d):
    wide = X.account_series(sample_star(spark, d), RUN).wide()
    return rounded(clean_data(with_kpi_ratios(wide)).select(
        "combo", "day", "vertical_name", "RTC_vertical", "campaign_revenue_type", "margin", "cos"), 9)


@query
def disqualify_query(spark, d):
    daily = X.account_series(sample_star(spark, d), RUN).daily
    return disqualify(daily, "combo", RUN.yesterday, RUN.required_days)


@query
def calendar_fill_query(spark, d):
    series = _eligible(spark, d)
    filled = calendar_fill(series.daily, "combo", list(P.ACCOUNT_FILL_METRICS), oversized_keys(series.daily, "combo", RUN.oversized_rows))
    return rounded(X.with_attributes(filled, clean_data(series.attributes), "AS_name").select("combo", "day", "AS_name", "clicks", "rext_euro", *P.ACCOUNT_FILL_METRICS), 9)


@query
def kpi_long(spark, d):
    found = _accounts(spark, d)
    named = X.with_attributes(AS.kpi_long(found.cleaned), found.attributes, "client_name", "campaign_name")
    return rounded(named.drop("attributes_id"), 9)


@query
def wide_to_long_query(spark, d):
    """Every territory as a column of its own, and back to rows."""
    series = stage(EX.territory_series(X.territory_daily(sample_star(spark, d), RUN)), "territories")
    names = sorted({name for group in EX.CHART_GROUPS.values() for name in group} | {"0"})
    wide = series.groupBy("day").pivot("series", names).agg(F.sum("RexT"))
    return wide_to_long(wide, "day", {name: name for name in names}).where("RexT IS NOT NULL")


@query
def last_n_rounded(spark, d):
    series = EX.territory_series(X.territory_daily(sample_star(spark, d), RUN))
    return last_entries(series, "series", "RexT", EX.CHART_DAYS)


@query
def pad_7_days(spark, d):
    star = sample_star(spark, d)
    recent = X.campaign_daily(star, RUN).where(F.col("day") >= F.lit(RUN.days_ago(7)))
    rows = stage(recent.groupBy("client_name", "day").agg(F.sum("clicks").alias("total_events")), "recent")
    return pad_days(rows, "client_name", "total_events", RUN.today, 7, star.client)


# ---- detection --------------------------------------------------------------

def _stats(spark, d, kpis=P.ALERT_KPIS):
    daily = _eligible(spark, d).daily
    large = oversized_keys(daily, "combo", RUN.oversized_rows)
    filled = calendar_fill(daily, "combo", list(P.ACCOUNT_FILL_METRICS), large)
    return detector_stats(filled, "combo", list(kpis), RUN.yesterday, large)


@query
def detector_stats_query(spark, d):
    spread = F.sqrt("variance") / (1 + F.abs("mean"))
    return rounded(_stats(spark, d).withColumn("spread", spread).drop("variance"))


@query
def detector_flags_query(spark, d):
    flags = detector_flags(_stats(spark, d), {k: P.rule_for(k) for k in P.ALERT_KPIS}, RUN.yesterday)
    return rounded(flags.select("combo", "kpi", "enough_rows", "ends_yesterday", "score", "is_outlier", "below_fence",
                                "above_fence", "fell", "rose", "is_material", "is_alert"))


@query
def detector_directions(spark, d):
    """The same series tested for drops only, rises only and both."""
    stats = stage(_stats(spark, d, ("spend",)), "stats")
    out = None
    for direction in ("neg", "pos", "both"):
        rule = P.KpiRule(0.9975, direction, 1.0)
        flags = detector_flags(stats, {"spend": rule}, RUN.yesterday)
        part = flags.select("combo", F.lit(direction).alias("direction"), "is_alert")
        out = part if out is None else out.unionByName(part)
    return out


@query
def as_results(spark, d):
    return _accounts(spark, d).results


@query
def ts_series(spark, d):
    return TS.tag_rows(sample_star(spark, d), RUN).wide("partner_id").select(
        "combo", "day", "site_type", "event_name", "partner_id", "events")


@query
def ts_results(spark, d):
    return _tags(spark, d).results


@query
def ts_alerts(spark, d):
    return TS.tag_alerts(_tags(spark, d).results)


@query
def territory_series(spark, d):
    return EX.territory_series(X.territory_daily(sample_star(spark, d), RUN))


@query
def territory_results(spark, d):
    return _territories(spark, d).results


@query
def account_alerts(spark, d):
    return rounded(EX.account_alerts(_accounts_margin(spark, d), RUN))


@query
def eligibility_query(spark, d):
    cleaned = _accounts(spark, d).cleaned
    return eligibility(cleaned, "combo", ["spend", "cos", "ctr", "cr", "site_events"], RUN.yesterday)


@query
def alert_review_series(spark, d):
    found = AS.detect_accounts(_series(spark, d), RUN, keep_history=True)
    review = AS.alert_review_series(AS.alert_texts(found.flags), AS.kpi_long(found.cleaned))
    return rounded(review.select("combo", "alert", "kpi", "day", "value"), 9)


# ---- reports ----------------------------------------------------------------

@query
def as_alerts(spark, d):
    alerts, _ = _account_alerts(spark, d)
    return rounded(alerts.orderBy(*AS.report_order()))


@query
def pod_alerts(spark, d):
    alerts, _ = _account_alerts(spark, d, POD_LEADERS)
    return rounded(alerts.select("combo", "kpi", "AS_name", "AS_email", "manager_name", "avg_rext_euro", "kpi_rank"))


# managers with these ids lead pods, whatever their business segment is called
POD_LEADERS = tuple(f"{segment} C{i}" for segment in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
                    for i in (0, 1, 5))


@query
def as_owner_digest(spark, d):
    alerts, found = _account_alerts(spark, d)
    axis = R.chart_axis(R.account_chart_input(found.cleaned, found.attributes, alerts))
    digest = R.owner_digest(alerts, axis.select("AS_email", "combo", "kpi", "last_label", "first_day", "last_day"))
    return digest


@query
def as_owner_doc(spark, d):
    """Nested documents of owners and clients, shown as counts and the nested text."""
    doc = R.owner_documents(as_owner_digest(spark, d))
    return doc.withColumn("n_alerts", F.size("alerts")).withColumn("alerts", F.to_json("alerts"))


@query
def as_summary(spark, d):
    return R.account_summary(_account_alerts(spark, d)[0])


@query
def as_recap(spark, d):
    """Recap rows written as CSV per ranking and read back."""
    alerts, _ = _account_alerts(spark, d)
    recap = R.account_recap(alerts).sort(*R.recap_order()).select("ranking", "AS_name", "combo", "kpi")
    path = write_csv(recap, stage_path(spark, "recap"), ("ranking",))
    return read_csv(spark, path, T.StructType.fromDDL("AS_name string, combo string, kpi string, ranking string"))


@query
def ts_recap(spark, d):
    """Tag alerts written as CSV and read back."""
    alerts = _tag_alerts(spark, d)
    return read_csv(spark, write_csv(alerts, stage_path(spark, "recap")), alerts.schema)


@query
def ts_summary(spark, d):
    return R.tag_summary(_tag_alerts(spark, d))


@query
def chat_digest_as(spark, d):
    return R.account_digest(_account_alerts(spark, d)[0], DELIVERY)


@query
def chat_digest_ts(spark, d):
    return R.tag_digest(_tag_alerts(spark, d), DELIVERY)


@query
def alert_chart_series(spark, d):
    alerts, found = _account_alerts(spark, d)
    return rounded(R.account_chart_input(found.cleaned, found.attributes, alerts), 9)


@query
def chart_axis_spec(spark, d):
    alerts, found = _account_alerts(spark, d)
    return rounded(R.chart_axis(R.account_chart_input(found.cleaned, found.attributes, alerts)))


@query
def chart_axis_spec_ts(spark, d):
    found = _tags(spark, d, keep_history=True)
    return rounded(R.chart_axis(R.tag_chart_input(found.cleaned, TS.tag_alerts(found.results))))


@query
def feedback_links(spark, d):
    return R.account_links(_account_alerts(spark, d)[0], RUN, DELIVERY)


@query
def feedback_links_ts(spark, d):
    return R.tag_links(_tag_alerts(spark, d), RUN, DELIVERY)


@query
def format_report(spark, d):
    wide = X.account_series(sample_star(spark, d), RUN).wide("AS_name", "currency_code")
    return R.formatted_figures(with_kpi_ratios(wide), RUN)


@query
def bps_change(spark, d):
    return R.daily_bps_change(_eligible(spark, d).daily, RUN)


@query
def ts_alert_doc(spark, d):
    """Nested documents of owners and partners, shown as counts and the nested text."""
    doc = TS.owner_documents(_tag_alerts(spark, d))
    return doc.select(
        "name", "email", "manager_name", "cost_center", "subregion", "ranking", "partner_name", "partner_id",
        F.size("alerts").alias("n_sites"), F.aggregate("alerts", F.lit(0), lambda n, s: n + F.size(s["event"])).alias("n_events"),
        F.to_json("alerts").alias("alerts"))


@query
def ts_alert_flatten(spark, d):
    """Documents written as JSON, read back and flattened."""
    doc = TS.owner_documents(_tag_alerts(spark, d))
    path = write_documents(doc, stage_path(spark, "documents"))
    return TS.flatten_documents(read_documents(spark, path, doc.schema))


# ---- executive report -------------------------------------------------------

@query
def territory_alert_text(spark, d):
    return EX.alert_text(_territories(spark, d).results)


@query
def territory_report(spark, d):
    return EX.territory_report(_territories(spark, d).cleaned, RUN)


@query
def territory_chart(spark, d):
    return EX.territory_chart(_territories(spark, d).cleaned, RUN)


@query
def territory_highlight(spark, d):
    return EX.territory_highlight(EX.alert_text(_territories(spark, d).results))


@query
def gainers_losers(spark, d):
    daily = _accounts_margin(spark, d)
    return EX.gainers_losers(EX.account_alerts(daily, RUN), daily)


# ---- export -----------------------------------------------------------------

@query
def export_as(spark, d):
    return rounded(E.export_accounts(sample_star(spark, d), RUN), 9)


@query
def export_ts(spark, d):
    return E.export_tags(sample_star(spark, d), RUN)


@query
def export_territory(spark, d):
    return E.export_territories(sample_star(spark, d), RUN)


@query
def export_filter(spark, d):
    """The account export filtered, written as CSV and read back with all its columns. What led to the files is deleted."""
    path = stage_path(spark, "export")
    with staging_scope(spark):
        rows = stage(E.export_accounts(sample_star(spark, d), RUN), "export")
        write_csv(E.export_filter(rows), path, compression="gzip")
    return rounded(read_csv(spark, path, E.EXPORT_SCHEMA), 9)


# ---- gates and outbox -------------------------------------------------------

@query
def freshness_gate(spark, d):
    star = sample_star(spark, d)
    loaded = G.loaded_today(star.import_reports, RUN.today, ["schema_1", "schema_2"], list(REQUIRED_TABLES))
    required = spark.createDataFrame([(t,) for t in REQUIRED_TABLES], "table_name string")
    return G.freshness(required, loaded)


@query
def run_history_gate(spark, d):
    history = sample_star(spark, d).run_history
    jobs = history.select("script", "geo").distinct()
    return G.jobs_to_run(jobs, history, RUN.today)


@query
def notification_outbox(spark, d):
    alerts, _ = _account_alerts(spark, d)
    outbox = G.owner_notices(alerts, DELIVERY, RUN).unionByName(
        G.summary_notices(R.account_summary(alerts), DELIVERY, RUN))
    return G.unsent(outbox, sample_star(spark, d).sent_history)


@query
def notification_outbox_ts(spark, d):
    alerts = _tag_alerts(spark, d)
    outbox = G.tag_owner_notices(alerts, DELIVERY, RUN).unionByName(
        G.summary_notices(R.tag_summary(alerts), DELIVERY, RUN, "TS"))
    return G.unsent(outbox, sample_star(spark, d).sent_history)


@query
def notification_outbox_exec(spark, d):
    text = EX.alert_text(_territories(spark, d).results)
    return G.unsent(G.executive_notice(text, DELIVERY, RUN), sample_star(spark, d).sent_history)


@query
def trouble_notices(spark, d):
    """Mail and chat of every job that did not run today: no alerts, late or failed, as usual and in test mode."""
    product = F.when(F.col("script") == "job_f", "AS").when(F.col("script") == "job_o", "TS").otherwise("EXEC")
    kind = F.element_at(F.array(*map(F.lit, ("no_alerts", "late", "error"))), F.substring("geo", 5, 12).cast("int") % 3 + 1)
    jobs = stage(run_history_gate(spark, d).select(product.alias("product"), kind.alias("kind"), "geo"), "stopped")

    def told(mode: str) -> DataFrame:
        own = replace(DELIVERY, test_mode=mode == "test")
        return G.trouble_notices(jobs, own, RUN).select("product", "kind", "geo", "to", "bcc", "subject", "chat").withColumns(
            {"mode": F.lit(mode), "channels": F.lit(" ".join(G.chat_channels(own)))})

    return told("usual").unionByName(told("test"))


@query
def committed_mails(spark, d):
    """The mails of a day's account job from the log of committed runs; the job is run again after it was done."""
    root = stage_path(spark, "runs")
    files = N.JobFiles(f"{root}/out", f"{root}/log")
    star = sample_star(spark, d)
    gate = J.Gate(("schema_1",), ("view_table", "click_table"))
    for _ in range(2):
        J.run_account_job(spark, star, gate, RUN, DELIVERY, files)
    return N.sent_mails(spark, files.log, RUN.today)


@query
def detector_levels(spark, d):
    """The same series tested at other levels of confidence."""
    stats = stage(_stats(spark, d, ("spend",)), "stats")

    def tested(confidence: float) -> DataFrame:
        flags = detector_flags(stats, {"spend": P.KpiRule(confidence, "both", 1.0)}, RUN.yesterday)
        return flags.select("combo", F.lit(confidence).alias("confidence"), "is_outlier", "is_alert")

    return reduce(DataFrame.unionByName, map(tested, LEVELS))


@query
def quarantine(spark, d):
    """Employees written as CSV, the id of every tenth damaged; what cannot be read is listed, not lost."""
    damaged = F.when(F.col("employee_id") % 10 == 3, F.concat(F.col("employee_id"), F.lit("x"))).otherwise(F.col("employee_id").cast("string"))
    path = write_csv(sample_star(spark, d).employee.select(damaged.alias("employee_id"), "full_name", "email"), stage_path(spark, "damaged"))
    good, bad = read_checked(spark, path, "csv", T.StructType.fromDDL("employee_id long, full_name string, email string"), 0.2)
    return good.withColumn("is_rejected", F.lit(False)).unionByName(bad.select(
        F.regexp_extract("record", "^([0-9]+)x,", 1).cast("long").alias("employee_id"), F.lit(None).cast("string").alias("full_name"),
        F.lit(None).cast("string").alias("email"), F.lit(True).alias("is_rejected")))


def queries() -> dict[str, Query]:
    return {name.removesuffix("_query"): build for name, build in QUERIES.items()}
