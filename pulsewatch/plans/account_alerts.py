"""Account and campaign KPIs: from daily features to alerts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsewatch import params as P
from pulsewatch.functions.cleaning import clean_data, with_kpi_ratios
from pulsewatch.operators.calendar import calendar_fill
from pulsewatch.operators.detector import detector_flags, detector_stats
from pulsewatch.operators.reshape import kpi_order, unpivot_kpis
from pulsewatch.operators.screening import disqualify, drop_series
from pulsewatch.operators.series_state import calendar_of, filled, long_rows, oversized_series, series_state, state_stats
from pulsewatch.plans.features import SeriesFrame, account_series, with_attributes
from pulsewatch.sources.stage import stage
from pulsewatch.sources.warehouse import Star, require_rows

SERIES_ATTRIBUTES = [
    "combo", "client_name", "client_id", "campaign_name", "campaign_id", "AS_name", "AS_email", "manager_name",
    "manager_email", "cost_center", "currency_code", "ranking", "country", "subregion", "region"]


@dataclass(frozen=True)
class Detection:
    """What was tested (``results``) and the series it was tested on (``cleaned``).

    ``flags`` has the outcome of every test per (series, kpi); ``attributes``
    the text columns of the series (None where a series is just a name).
    """

    results: DataFrame
    cleaned: DataFrame
    flags: DataFrame
    attributes: DataFrame | None = None


def account_rows(star: Star, p: P.RunParams, without: tuple[str, ...] = ()) -> SeriesFrame:
    """Client and campaign series; the daily rows are staged, the dimension already is."""
    series = account_series(star, p, without)
    return SeriesFrame(require_rows(stage(series.daily, "account-daily"), "account features"), series.attributes)


def eligible_rows(daily: DataFrame, p: P.RunParams) -> DataFrame:
    """Series fit to be tested, with the ratio KPIs, cleaned. Not yet staged."""
    dropped = disqualify(daily, "combo", p.yesterday, p.required_days)
    return clean_data(with_kpi_ratios(drop_series(daily, "combo", dropped)))


def detect_accounts(series: SeriesFrame, p: P.RunParams, alert_kpis: tuple[str, ...] = P.ALERT_KPIS,
                    keep_history: bool = False) -> Detection:
    """Clean, fill the calendar and test every (series, KPI).

    The daily rows are shuffled once, into one row per series. ``keep_history`` stages the filled series, for callers that report them too.
    """
    metrics, kpis = list(P.ACCOUNT_FILL_METRICS), list(alert_kpis)
    named = F.coalesce("combo", F.lit("0"))         # as clean_data names it
    large = oversized_series(series.daily.select(named.alias("combo")), "combo", p.oversized_rows)
    usual = series.daily if large is None else series.daily.join(large.withColumnRenamed("combo", "__large"), named == F.col("__large"), "left_anti")
    rows = clean_data(with_kpi_ratios(usual.withColumns({"__tac": F.col("tac"), "__unnamed": F.col("combo").isNull()})), keep=("day", "__tac", "__unnamed"))
    columns = [c for c in rows.columns if c not in ("__tac", "__unnamed")]
    state = stage(series_state(rows, "combo", rows.select(*columns), p.yesterday, p.required_days), "series-state")
    days = state.select(F.explode("rows.day").alias("day"))
    if large is not None:
        big = series.daily.join(large.withColumnRenamed("combo", "__large"), named == F.col("__large"), "left_semi")
        eligible = stage(eligible_rows(big, p).select(*columns), "eligible")
        days = days.unionByName(eligible.select("day"))
    calendar = calendar_of(days)
    whole = filled(state, "combo", metrics, calendar)
    if keep_history:
        whole = stage(whole, "filled")
    cleaned = long_rows(whole, "combo", columns)
    stats = state_stats(whole, "combo", kpis, p.yesterday, ["rext_euro"])
    seen = state.select("combo", F.explode(F.array_distinct("rows.attributes_id")).alias("attributes_id"))
    if large is not None:
        # rows of one series in too great number for an array
        keys = eligible.select("combo").distinct()
        more = calendar_fill(eligible, "combo", metrics, keys, calendar)
        cleaned = cleaned.unionByName(more)
        on_yesterday = F.col("day") == F.lit(p.yesterday)
        stats = stats.unionByName(detector_stats(more, "combo", kpis, p.yesterday, keys, extra=[
            F.max(F.when(on_yesterday, F.col("rext_euro"))).alias("rext_euro_yesterday")]))
        seen = seen.unionByName(eligible.select("combo", "attributes_id").distinct())
        cleaned = stage(cleaned, "cleaned") if keep_history else cleaned
    tested = detector_flags(stats, {k: P.rule_for(k) for k in alert_kpis}, p.yesterday)
    deep_loss = ((F.col("kpi") == "rext") & (F.col("n_yesterday") == 1)
                 & (F.col("rext_euro_yesterday") <= P.NEGATIVE_MARGIN_FLOOR_EURO))
    flags = (tested.withColumnRenamed("is_alert", "is_statistical")
             .withColumn("is_override", F.coalesce(deep_loss, F.lit(False)))
             .withColumn("is_alert", F.col("is_statistical") | F.col("is_override")))

    # every tested KPI plus rext_euro, which is listed but never tested
    listed = F.when(F.col("kpi") == alert_kpis[0], F.array(
        F.struct("kpi", "is_alert"), F.struct(F.lit("rext_euro").alias("kpi"), F.lit(False).alias("is_alert"))
    )).otherwise(F.array(F.struct("kpi", "is_alert")))
    per_kpi = flags.select("combo", F.explode(listed).alias("t")).select("combo", "t.*")
    attributes = clean_data(series.attributes).join(seen, ["combo", "attributes_id"], "left_semi")
    results = attributes.select(*SERIES_ATTRIBUTES).distinct().join(per_kpi, "combo").select(
        *SERIES_ATTRIBUTES, "kpi", F.lit(p.today).alias("run_date"), "is_alert")
    return Detection(results, cleaned, flags, attributes)


def kpi_long(cleaned: DataFrame) -> DataFrame:
    return unpivot_kpis(cleaned, ["combo", "attributes_id", "day"], list(P.TRACKED_KPIS))


def client_level(df: DataFrame) -> DataFrame:
    """Only clients are reported; campaigns are tested for the dashboards."""
    return df.where(F.col("campaign_name") == P.NOT_A_CAMPAIGN)


def _is_leader(column: str, leaders: tuple[str, ...]) -> Column:
    return F.col(column).isin(*[name.upper() for name in leaders])


def with_pod_leaders(df: DataFrame, leaders: tuple[str, ...]) -> DataFrame:
    """Adds a copy for pod leaders: addressed to the manager if that is a leader."""
    if not leaders:
        return df
    managed = _is_leader("manager_name", leaders)
    pod = df.where(managed | _is_leader("AS_name", leaders)).withColumns({
        "AS_email": F.when(managed, F.col("manager_email")).otherwise(F.col("AS_email")),
        "AS_name": F.when(managed, F.col("manager_name")).otherwise(F.col("AS_name"))})
    return df.unionByName(pod).distinct()


def account_alerts(found: Detection, p: P.RunParams) -> DataFrame:
    """Client alerts with their owner, ranked by average margin in euro.

    The tests are worked out once, into a staged table of the alerts, and only series that alert are looked up in the history.
    Not sorted here; ``kpi_rank`` and ``avg_rext_euro`` carry the report order.
    """
    alerts = with_pod_leaders(stage(client_level(found.results.where("is_alert")), "client-alerts"), p.pod_leaders)
    history = found.cleaned.where("is_client").join(alerts.select("combo").distinct(), "combo", "left_semi")
    if p.pod_leaders:
        history = with_pod_leaders(with_attributes(
            history, found.attributes, "AS_name", "AS_email", "manager_name", "manager_email"), p.pod_leaders)
    margin = history.groupBy("combo").agg(F.avg("rext_euro").alias("avg_rext_euro"))
    return alerts.join(margin, "combo", "left").withColumn("kpi_rank", kpi_order("kpi", P.ALERT_KPIS))


def report_order() -> list[Column]:
    return [F.col("avg_rext_euro").desc(), F.col("kpi_rank")]


def alert_history(cleaned: DataFrame, alerts: DataFrame) -> DataFrame:
    """Daily rows of the series that alert."""
    return cleaned.join(alerts.select("combo").distinct(), "combo", "left_semi")


def alert_texts(flags: DataFrame) -> DataFrame:
    """Alerts of a series in one text, e.g. "SPEND, COS"; a pure override reads "Negative RexT"."""
    label = F.when(F.col("is_statistical"), F.upper("kpi")).otherwise("Negative RexT")
    rows = flags.where("is_alert").select(
        "combo", F.struct(kpi_order("kpi", P.ALERT_KPIS).alias("rank"), label.alias("text")).alias("a"))
    return rows.groupBy("combo").agg(F.array_join(
        F.transform(F.array_sort(F.collect_list("a")), lambda a: a["text"]), ", ").alias("alerts"))


def alert_review_series(texts: DataFrame, long: DataFrame) -> DataFrame:
    """History of every alert named in the texts, for a visual check of the model."""
    named = (texts.where(F.col("alerts") != "Negative RexT")
             .select("combo", F.explode(F.split("alerts", ", ")).alias("alert"))
             .where(F.col("alert") != "Negative RexT")
             .withColumn("kpi", F.when(F.col("alert") == "Drop in Site Events", "site_events")
                         .otherwise(F.lower("alert"))))
    return long.select("combo", "kpi", "day", "value").join(named, ["combo", "kpi"])
