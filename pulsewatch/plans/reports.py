"""Report tables, ready to be delivered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsewatch import params as P
from pulsewatch.functions import links as L
from pulsewatch.functions import texts as X
from pulsewatch.operators.numbering import number_rows
from pulsewatch.operators.reshape import kpi_order
from pulsewatch.plans.account_alerts import with_pod_leaders
from pulsewatch.plans.features import with_attributes

# ---- fixed values: chart axes and chat texts --------------------------------
MONEY_KPIS = ("spend", "rext")
COUNT_KPIS = ("events",)
TICK_DAYS = 14
HEADROOM = 1.05
SHRINK = 0.95
MESSAGE_RULE = "-" * 79
ACCOUNT_HEADLINE = "*Business alert(s)* sent to AS"
TAG_HEADLINE = "*Technical alert(s)* sent to TS"
MESSAGE_START = ">>>"
NO_TAG_LABEL = "site-level"
RECAP_NOTE = "Recap of triggered accounts/alerts attached."
COLOR_SLOTS = 3
SUMMARY_OWNERS, SUMMARY_ALERTS = "Emails Sent: ", "\nTotal Alerts Triggered: "
DIGEST_START, DIGEST_TOTAL = "{headline} at ", "*Total accounts with {noun} alert(s): "
# -----------------------------------------------------------------------------


# ---- summaries --------------------------------------------------------------

def summary_body(owners: Column, alerts: Column) -> Column:
    return F.concat(F.lit(SUMMARY_OWNERS), owners.cast("string"), F.lit(SUMMARY_ALERTS),
                    alerts.cast("string"), F.lit(f"\n\n{RECAP_NOTE}"))


def _summary(rows: DataFrame, owner: str, keys: list[str]) -> DataFrame:
    """Owners are counted over de-duplicated pairs, so a large tier combines early."""
    counted = rows.groupBy(*keys, owner).agg(F.count(F.lit(1)).alias("n")).groupBy(*keys).agg(
        F.count(owner).alias("emails_sent"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_alerts"))
    return counted.withColumn("body", summary_body(F.col("emails_sent"), F.col("total_alerts")))


def account_recap(alerts: DataFrame) -> DataFrame:
    """Triggered accounts; owners who are their own manager are left out."""
    return alerts.where(F.col("AS_name") != F.col("manager_name")).select(
        "ranking", "AS_name", "combo", "kpi", "avg_rext_euro", "kpi_rank")


def account_summary(alerts: DataFrame) -> DataFrame:
    """Owners reached and alerts triggered per ranking."""
    return _summary(account_recap(alerts), "AS_name", ["ranking"])


def tag_summary(alerts: DataFrame) -> DataFrame:
    return _summary(alerts, "TS_name", [])


# ---- chat digests -----------------------------------------------------------

def _messages(lines: DataFrame, groups: list[str], headline: str, noun: str, d: P.DeliveryParams) -> DataFrame:
    """Header, blocks of lines and a total, numbered per group.

    ``lines`` has one row (groups, subject, line) per subject.
    """
    size = d.max_lines_per_message
    numbered = number_rows(lines, groups, [F.col("subject")], "line_no")
    block = F.floor((F.col("line_no") - 1) / size).cast("int") + 1
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    blocks = numbered.groupBy(*groups, block.alias("message_no")).agg(
        F.concat(F.lit(MESSAGE_START), F.array_join(F.transform(ordered, lambda x: x["line"]), "\n")).alias("text"))
    counts = lines.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"))
    last = F.ceil(F.col("n") / size).cast("int") + 1
    frame = counts.select(*groups, F.explode(F.array(
        F.struct(F.lit(0).alias("message_no"), F.concat(
            F.lit(DIGEST_START.format(headline=headline)), X.moment_text(d.sent_at, d.timezone)).alias("text")),
        F.struct(last.alias("message_no"), F.concat(
            F.lit(DIGEST_TOTAL.format(noun=noun)), F.col("n").cast("string"),
            F.lit("*\n" + MESSAGE_RULE)).alias("text")))).alias("m")).select(*groups, "m.*")
    return blocks.unionByName(frame)


def _quoted(text: Column) -> Column:
    return F.concat(F.lit("`"), text, F.lit("`"))


def account_digest(alerts: DataFrame, d: P.DeliveryParams) -> DataFrame:
    """Chat messages per ranking tier that has a channel."""
    tier = F.lower(F.replace("ranking", F.lit(" "), F.lit("")))
    channel = F.lit(None).cast("string")
    for name, target in d.channels.items():
        channel = F.when(tier == name, d.test_channel if d.test_mode else target).otherwise(channel)
    rows = account_recap(alerts).withColumn("channel", channel).where(F.col("channel").isNotNull())
    parts = F.array_sort(F.collect_list(F.struct("AS_name", "kpi_rank", _quoted(F.upper("kpi")).alias("text"))))
    lines = rows.groupBy("ranking", "channel", F.col("combo").alias("subject")).agg(
        F.array_join(F.transform(parts, lambda x: x["text"]), "  ").alias("alerts"))
    lines = lines.select("ranking", "channel", "subject", F.concat_ws(
        " ", "subject", F.lit(d.separator), "alerts").alias("line"))
    return _messages(lines, ["ranking", "channel"], ACCOUNT_HEADLINE, "business", d)


def tag_digest(alerts: DataFrame, d: P.DeliveryParams, channel: str = "#tags") -> DataFrame:
    """Chat messages with the tags that alert, one line per partner."""
    event, site = F.col("event_name"), F.col("site_type")
    label = F.concat(X.capitalize_first(event), F.when((event != "") & (site != ""), " on ").otherwise(""),
                     F.upper(F.coalesce(site, F.lit(""))))
    rows = alerts.select("partner_name", "event_name", "site_type").distinct().withColumn(
        "label", _quoted(F.when(label == "", NO_TAG_LABEL).otherwise(label)))
    parts = F.array_sort(F.collect_list(F.struct("event_name", "site_type", "label")))
    lines = rows.groupBy(F.col("partner_name").alias("subject")).agg(
        F.array_join(F.transform(parts, lambda x: x["label"]), "  ").alias("alerts"))
    target = d.test_channel if d.test_mode else channel
    lines = lines.select(F.lit(target).alias("channel"), "subject", F.concat_ws(
        " ", "subject", F.lit(d.separator), "alerts").alias("line"))
    return _messages(lines, ["channel"], TAG_HEADLINE, "technical", d)


# ---- owner digest -----------------------------------------------------------

def owner_clients(alerts: DataFrame) -> DataFrame:
    """Clients of each owner, numbered in report order, with their colour slot."""
    clients = alerts.groupBy("AS_email", "combo").agg(
        F.max("avg_rext_euro").alias("avg_rext_euro"), F.min("kpi_rank").alias("first_kpi"))
    numbered = number_rows(clients, ["AS_email"], [
        F.col("avg_rext_euro").desc(), F.col("first_kpi"), F.col("combo")], "client_no")
    return numbered.select("AS_email", "combo", "client_no",
                           (F.col("client_no") % COLOR_SLOTS).alias("color_slot"))


def owner_digest(alerts: DataFrame, chart: DataFrame) -> DataFrame:
    """One row per owner, client and KPI with its place in the mail and its chart."""
    one = alerts.select("AS_email", "AS_name", "combo", "client_id", "kpi", "kpi_rank").distinct()
    return (one.join(owner_clients(alerts), ["AS_email", "combo"])
            .join(chart, ["AS_email", "combo", "kpi"], "left"))


def owner_documents(digest: DataFrame) -> DataFrame:
    """The digest as one row per owner and client, with its KPIs nested in order."""
    return digest.groupBy("AS_email", "AS_name", "client_no", "combo", "client_id", "color_slot").agg(
        F.array_sort(F.collect_list(F.struct("kpi_rank", "kpi", "last_label"))).alias("alerts"))


# ---- charts -----------------------------------------------------------------

def _axis_step(kpi: Column, highest: Column) -> Column:
    plain = (F.when(highest < 100, 5.0).when(highest < 1_000, 10.0)
             .when(highest < 10_000, 100.0).otherwise(1_000.0))
    share = F.when(highest < 0.30, 0.01).otherwise(0.1)
    return F.when(kpi.isin(*MONEY_KPIS, *COUNT_KPIS), plain).otherwise(share)


def chart_axis(long: DataFrame) -> DataFrame:
    """Axis limits, last value label and date ticks per owner (if there is one), combo and kpi.

    ``long`` holds combo, currency_code, kpi, day, value and, for accounts, AS_name and AS_email.
    """
    keys = [c for c in ("AS_name", "AS_email", "combo", "kpi") if c in long.columns]
    spec = long.groupBy(*keys).agg(
        F.max("value").alias("hi"), F.min("value").alias("lo"), F.max_by("value", "day").alias("last_value"),
        F.min("currency_code").alias("currency_code"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    kpi, hi, lo = F.col("kpi"), F.col("hi"), F.col("lo")
    step = _axis_step(kpi, hi)
    top = F.greatest(F.lit(0.0), hi * F.when(hi > 0, HEADROOM).otherwise(SHRINK))
    bottom = F.least(F.lit(0.0), lo * F.when(lo < 0, HEADROOM).otherwise(SHRINK))
    money, count = kpi.isin(*MONEY_KPIS), kpi.isin(*COUNT_KPIS)
    y_max = F.ceil(top / step) * step
    y_min = F.when(count, 0.0).otherwise(F.floor(bottom / step) * step)

    def axis_label(y: Column) -> Column:
        return (F.when(money, F.concat_ws(" ", X.compact_text(y), "currency_code"))
                .when(count, X.compact_text(y))
                .otherwise(F.concat(X.compact_text(y * 100), F.lit(" %"))))

    last = F.col("last_value")
    label = (F.when(count, X.number_text(last, 0))
             .when(money, X.currency_text(last, symbol="", code=F.col("currency_code")))
             .otherwise(X.percent_text(last)))
    ticks = F.floor(F.datediff("last_day", "first_day") / TICK_DAYS).cast("int")
    spec = spec.withColumns({"step": step, "y_max": y_max, "y_min": y_min, "last_label": label,
                             "n_ticks": ticks + 1, "first_tick": F.date_sub("last_day", ticks * TICK_DAYS)})
    return spec.select(*keys, "step", "y_max", "y_min", axis_label(F.col("y_max")).alias("y_max_label"),
                       axis_label(F.col("y_min")).alias("y_min_label"), "last_label", "first_day", "last_day",
                       "n_ticks", "first_tick")


def account_chart_input(cleaned: DataFrame, attributes: DataFrame, alerts: DataFrame,
                        leaders: tuple[str, ...] = ()) -> DataFrame:
    """Alerted KPIs with their history, long: of each client the rows of the owner who is told."""
    pairs = alerts.select("combo", "kpi", "AS_name", "AS_email").distinct()
    rows = cleaned.where("is_client").join(pairs.select("combo").distinct(), "combo", "left_semi")
    rows = with_attributes(rows, attributes, "currency_code", "AS_name", "AS_email", "manager_name", "manager_email")
    ids = ["combo", "AS_name", "AS_email", "currency_code", "day"]
    rows = with_pod_leaders(rows.select(*ids, "manager_name", "manager_email", "attributes_id", *P.ALERT_KPIS), leaders)
    return rows.select(*ids, *P.ALERT_KPIS).unpivot(ids, list(P.ALERT_KPIS), "kpi", "value").join(
        pairs, ["combo", "kpi", "AS_name", "AS_email"], "left_semi")


def tag_chart_input(cleaned: DataFrame, alerts: DataFrame) -> DataFrame:
    return cleaned.join(alerts.select("combo").distinct(), "combo", "left_semi").select(
        "combo", F.lit("").alias("currency_code"), "day", F.lit("events").alias("kpi"), F.col("events").alias("value"))


# ---- links ------------------------------------------------------------------

def account_links(alerts: DataFrame, p: P.RunParams, d: P.DeliveryParams) -> DataFrame:
    """Feedback (true and false), investigation and dashboard links per alert."""
    kpi = F.when(F.col("kpi") == "rext", "client_rext").otherwise(F.col("kpi"))

    def feedback(answer: str) -> Column:
        return L.query_link(d.feedback_base, {
            "series": F.col("combo"), "username": X.user_name(F.col("AS_email")), "client_id": F.col("client_id"),
            "run_date": F.lit(p.today.isoformat()), "kpi": kpi, "is_alert": F.lit(answer),
            "client_name": F.col("combo"), "cost_center": F.col("cost_center"), "ranking": F.col("ranking"),
            "country": F.col("country"), "subregion": F.col("subregion"), "region": F.col("region")})

    explore = L.query_link(d.investigation_base, {
        "kpi": F.col("kpi"), "start_date": F.lit(p.days_ago(16).isoformat()),
        "end_date": F.lit(p.yesterday.isoformat()), "client_id": F.col("client_id")})
    dashboard = F.concat(F.lit(d.account_url_prefix), F.col("client_id").cast("string"), F.lit(d.account_url_suffix))
    return alerts.select("AS_email", "combo", "kpi", feedback("true").alias("true_link"),
                         feedback("false").alias("false_link"), explore.alias("explore_link"),
                         dashboard.alias("dashboard_link"))


def tag_links(alerts: DataFrame, p: P.RunParams, d: P.DeliveryParams) -> DataFrame:
    series = F.concat_ws(" ", "partner_name", "event_name", F.lit("on"), "site_type")

    def feedback(answer: str) -> Column:
        return L.query_link(d.feedback_base, {
            "series": series, "partner_name": F.col("partner_name"), "partner_id": F.col("partner_id"),
            "site_type": F.col("site_type"), "event_name": F.col("event_name"), "kpi": F.lit("tag_events"),
            "run_date": F.lit(p.today.isoformat()), "username": X.user_name(F.col("ts_engineer_email")),
            "cost_center": F.col("ts_cost_center"), "ranking": F.col("ranking"), "country": F.col("ts_country"),
            "subregion": F.col("ts_subregion"), "region": F.col("ts_region"), "is_alert": F.lit(answer)})

    explore = L.query_link(d.investigation_base, {
        "partner_id": F.col("partner_id"), "start_date": F.lit(p.days_ago(16).isoformat()),
        "end_date": F.lit(p.yesterday.isoformat()), "kpi": F.lit("site_events")})
    dashboard = L.query_link(d.dashboard_base, {
        "partner_name": F.col("partner_name"), "event_name": L.dashboard_event(F.col("event_name"))})
    return alerts.select(
        "ts_engineer_email", "combo", X.site_name(F.col("site_type")).alias("site_name"),
        feedback("True").alias("true_link"), feedback("False").alias("false_link"),
        explore.alias("explore_link"), dashboard.alias("dashboard_link"))


# ---- formatted figures ------------------------------------------------------

def formatted_figures(rows: DataFrame, p: P.RunParams) -> DataFrame:
    """Yesterday's figures of every series as report text."""
    return rows.where(F.col("day") == F.lit(p.yesterday)).select(
        "combo", X.title_name(F.col("AS_name")).alias("owner"),
        X.number_text(F.col("clicks"), 0).alias("clicks"),
        X.currency_text(F.col("rext"), prefix="+", symbol="", code=F.col("currency_code")).alias("margin"),
        X.currency_text(F.col("spend")).alias("spend"),
        X.percent_text(F.col("cos")).alias("cos"),
        X.percent_text(F.col("ctr"), plus=True, digits=1).alias("ctr"),
        X.compact_text(F.col("order_value")).alias("order_value"),
        X.day_text(F.col("day")).alias("day_text"))


def daily_bps_change(rows: DataFrame, p: P.RunParams) -> DataFrame:
    """Change of the cost of sale from the day before to yesterday, in basis points."""
    def on(day) -> Column:
        return F.max(F.when(F.col("day") == F.lit(day), F.col("cos")))

    both = rows.where(F.col("day").isin(p.yesterday, p.days_ago(2))).groupBy("combo").agg(
        on(p.days_ago(2)).alias("before"), on(p.yesterday).alias("after"))
    change = X.bps_change(F.col("before"), F.col("after"), 10_000)
    return both.where(F.col("before").isNotNull() & F.col("after").isNotNull()).select(
        "combo", F.round(change, 4).alias("change"), X.bps_text(change, plus=True).alias("change_text"))


def recap_order() -> list[Column]:
    return [F.col("AS_name"), F.col("combo"), F.col("avg_rext_euro").desc(), kpi_order("kpi", P.ALERT_KPIS)]
