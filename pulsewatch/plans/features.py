"""Daily metrics per series, straight from the star schema.

Facts out of scope are dropped first, by a broadcast of the campaign ids if
these are few enough (counted), otherwise by the later join. The rest is
de-duplicated and summed per campaign, currency and day *before* it meets the
dimensions, both behind one exchange by campaign and day, so one campaign holding
a large part of the facts is spread over its days. The joins
after that see one row per campaign, currency and day, and the many text
attributes come last. Those joins carry no hint: Spark broadcasts what its size
statistics allow and sorts the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsewatch import params as P
from pulsewatch.functions.cleaning import clean_data
from pulsewatch.operators.screening import live_keys
from pulsewatch.plans.daily_store import kept_sums
from pulsewatch.sources.stage import stage
from pulsewatch.sources.warehouse import Star

# ---- fixed values: measures and attribute columns of the daily frames -------
MEASURES = ["clicks", "displays", "conversions", "spend", "tac", "rext", "rext_euro", "order_value"]
CAMPAIGN_ATTRIBUTES = [
    "client_name", "client_id", "global_account_name", "RTC_vertical", "vertical_name", "campaign_name",
    "campaign_id", "AS_name", "AS_email", "manager_name", "manager_email", "cost_center", "currency_code",
    "ranking", "country", "subregion", "region", "campaign_scenario", "campaign_type_name",
    "campaign_revenue_type", "campaign_funnel_id"]
# what the attributes of a single campaign read in the row of its client
CAMPAIGN_ONLY = {
    "campaign_name": P.NOT_A_CAMPAIGN, "campaign_id": P.NO_CAMPAIGN_ID,
    "campaign_scenario": P.NOT_A_CAMPAIGN, "campaign_type_name": P.NOT_A_CAMPAIGN,
    "campaign_revenue_type": P.NO_CAMPAIGN_ATTRIBUTE, "campaign_funnel_id": P.NO_CAMPAIGN_ATTRIBUTE}
TAG_ATTRIBUTES = [
    "partner_name", "partner_id", "TS_name", "ts_engineer_email", "manager_name", "manager_email", "ranking",
    "ts_cost_center", "ts_country", "ts_subregion", "ts_region", "RTC_vertical", "vertical_name",
    "global_account_name"]
# -----------------------------------------------------------------------------


def row_id(*columns: str) -> Column:
    """Hash of a row. Spark's hash skips nulls, so the null flags are hashed too: (null, x) is not (x, null)."""
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def predicate(condition: str | Column) -> Column:
    """A filter parameter: SQL text or a Column."""
    return F.expr(condition) if isinstance(condition, str) else condition


def owner_dim(star: Star, p: P.RunParams) -> DataFrame:
    """Employees in scope with their manager; no manager, no row."""
    staff = (star.employee.alias("em").where(predicate(p.employee_filter))
             .select("employee_id", "full_name", "email", "cost_center_country", "country", "direct_reports_id")
             .distinct())
    managers = star.employee.select(
        F.col("employee_id").alias("direct_reports_id"), F.col("full_name").alias("manager_name"),
        F.col("email").alias("manager_email")).distinct()
    return staff.join(managers, "direct_reports_id").select(
        "employee_id", F.col("full_name").alias("owner_name"), F.col("email").alias("owner_email"),
        "manager_name", "manager_email", F.col("cost_center_country").alias("cost_center"),
        F.col("country").alias("country_code"))


def _located(owners: DataFrame, star: Star) -> DataFrame:
    places = star.country.select(
        "country_code", F.col("country_level_1_name").alias("country"),
        F.col("country_level_2_name").alias("subregion"),
        F.col("country_level_3_name").alias("region")).distinct()
    return owners.join(places, "country_code").drop("country_code")


def in_scope(facts: DataFrame, dims: DataFrame, key: str, limit: int) -> DataFrame:
    """Drop facts whose key is not in ``dims`` early, if the keys can be broadcast.

    Up to ``limit`` distinct ids (8 bytes each) go to all tasks; with more of
    them the facts are left as they are, and the join with the dimension filters
    them.
    """
    keys = dims.select(key).distinct()
    if keys.count() > limit:
        return facts
    return facts.join(F.broadcast(keys), key, "left_semi")


def campaign_facts(stats: DataFrame) -> DataFrame:
    return stats.select("day", "displays", "clicks", F.col("sales_all_post_click").alias("conversions"),
                        F.col("order_value_all_post_click_local").alias("order_value"), "revenue_local",
                        "tac_local", "revenue_euro", "tac_euro", "campaign_id", "affiliate_currency_id")


def without_repeats(rows: DataFrame, limit: int) -> DataFrame:
    """The distinct rows, without shuffling all of them.

    A first pass shuffles a hash per row and finds those that occur twice; only rows with such a hash go through the exact
    ``distinct``, all others stay where they are. With more than ``limit`` repeated hashes, which would have to be sent to all
    tasks, all rows go through it.
    """
    marked = rows.withColumn("__hash", row_id(*rows.columns))
    twice = stage(marked.groupBy("__hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__hash"), "repeated")
    n = twice.count()
    if n > limit:
        return rows.distinct()
    if n == 0:
        return rows
    sent = F.broadcast(twice)
    return marked.join(sent, "__hash", "left_anti").drop("__hash").unionByName(
        marked.join(sent, "__hash", "left_semi").drop("__hash").distinct())


def deduplicated_facts(star: Star, p: P.RunParams) -> DataFrame:
    """Fact rows of the window; rows equal in all columns used count once."""
    window = star.stats.where(F.col("day") >= F.lit(p.days_ago(p.account_window_days)))
    return without_repeats(campaign_facts(window), p.broadcast_keys)


def campaign_dims(star: Star, p: P.RunParams) -> DataFrame:
    """Clients in scope with currency, owner, manager and place."""
    clients = star.client.where(predicate(p.client_filter)).select(
        "campaign_id", "account_strategist_employee_id", "client_currency_id", "client_name", "client_id",
        "campaign_name", "ranking", F.col("campaign_scenario_product_level_1_name").alias("campaign_scenario"),
        F.col("vertical_level_2_name").alias("RTC_vertical"), "vertical_name", "global_account_name",
        "campaign_type_name", "campaign_revenue_type", "campaign_funnel_id").distinct()
    owners = _located(owner_dim(star, p), star).withColumnsRenamed(
        {"owner_name": "AS_name", "owner_email": "AS_email"})
    currencies = star.currency.select(
        F.col("currency_id").alias("client_currency_id"), "currency_code").distinct()
    return (clients.join(owners, F.col("account_strategist_employee_id") == F.col("employee_id"))
            .join(currencies, "client_currency_id")
            .select("client_currency_id", *CAMPAIGN_ATTRIBUTES).distinct())


def campaign_sums(star: Star, p: P.RunParams, dims: DataFrame) -> DataFrame:
    """Measures per (campaign_id, client_currency_id, day); no text columns."""
    if p.daily_store:
        facts = kept_sums(star.stats, f"{p.daily_store}/stats", p.days_ago(p.account_window_days), lambda rows: distinct_sums(campaign_facts(rows)))
    else:
        rows = campaign_facts(star.stats.where(F.col("day") >= F.lit(p.days_ago(p.account_window_days))))
        # facts without a campaign meet no dimension
        facts = distinct_sums(in_scope(rows, dims, "campaign_id", p.broadcast_keys).where("campaign_id IS NOT NULL"))
    return priced_sums(star, p, dims, facts)


def distinct_sums(rows: DataFrame) -> DataFrame:
    """Sums of the distinct facts, in one exchange: equal rows share campaign and day, and so do the rows of one sum."""
    return fact_sums(rows.repartition("campaign_id", "day").distinct())


def fact_sums(facts: DataFrame) -> DataFrame:
    """Facts per campaign, currency and day."""
    both = F.col("revenue_local").isNotNull() & F.col("tac_local").isNotNull()
    return facts.groupBy("campaign_id", "affiliate_currency_id", "day").agg(
        F.sum("clicks").alias("clicks"), F.sum("displays").alias("displays"),
        F.sum("conversions").alias("conversions"), F.sum("order_value").alias("order_value"),
        F.sum("revenue_local").alias("revenue"), F.sum("tac_local").alias("media"),
        F.sum(F.when(both, F.col("revenue_local"))).alias("paired_revenue"),
        F.sum(F.when(both, F.col("tac_local"))).alias("paired_media"),
        F.sum(F.col("revenue_euro") - F.col("tac_euro")).alias("rext_euro"))


def priced_sums(star: Star, p: P.RunParams, dims: DataFrame, facts: DataFrame) -> DataFrame:
    """The sums of campaigns in scope, media cost in client currency."""
    rates = star.fx_daily.where(F.col("day") >= F.lit(p.days_ago(p.account_window_days))).select(
        F.col("source_currency_id").alias("affiliate_currency_id"),
        F.col("destination_currency_id").alias("client_currency_id"), "day", "rate").distinct()
    priced = (facts.join(dims.select("campaign_id", "client_currency_id").distinct(), "campaign_id")
              .join(rates, ["affiliate_currency_id", "client_currency_id", "day"]))

    def total(name: str, value: Column | str) -> Column:
        return F.coalesce(F.sum(value), F.lit(0.0)).alias(name)

    return priced.groupBy("campaign_id", "client_currency_id", "day").agg(
        total("clicks", "clicks"), total("displays", "displays"), total("conversions", "conversions"),
        total("spend", "revenue"), total("tac", F.col("media") * F.col("rate")),
        total("rext", F.col("paired_revenue") - F.col("paired_media") * F.col("rate")),
        total("rext_euro", "rext_euro"), total("order_value", "order_value"))


def campaign_daily(star: Star, p: P.RunParams) -> DataFrame:
    """One row per campaign, owner attributes and day; amounts in client currency."""
    dims = stage(campaign_dims(star, p), "campaign-dims")
    rows = campaign_sums(star, p, dims).join(dims, ["campaign_id", "client_currency_id"]).drop("client_currency_id")
    if star.currency.select("currency_id", "currency_code").distinct().groupBy(
            "currency_code").count().where("count > 1").isEmpty():
        return rows
    # currencies that share a code make one series
    return rows.groupBy(*CAMPAIGN_ATTRIBUTES, "day").agg(*[F.sum(m).alias(m) for m in MEASURES])


@dataclass(frozen=True)
class SeriesFrame:
    """Daily rows without text, and the attributes of every series once.

    Both hold the series key ``combo`` and ``attributes_id``, a hash that tells
    apart the attribute rows of one series.
    """

    daily: DataFrame
    attributes: DataFrame

    def wide(self, *columns: str) -> DataFrame:
        return with_attributes(self.daily, self.attributes, *columns)


def with_attributes(df: DataFrame, attributes: DataFrame, *columns: str) -> DataFrame:
    """Attach attribute columns (all by default); a missing name joins itself."""
    shown = attributes if not columns else attributes.select("combo", "attributes_id", *columns)
    shown = shown.distinct().withColumnsRenamed({"combo": "__combo", "attributes_id": "__id"})
    return df.join(shown, F.col("combo").eqNullSafe(F.col("__combo")) & (F.col("attributes_id") == F.col("__id"))).drop(
        "__combo", "__id")


def account_series(star: Star, p: P.RunParams, without: tuple[str, ...] = ()) -> SeriesFrame:
    """Client totals and campaigns as daily series, in one aggregation.

    ``without`` names attributes that neither split the client totals nor show
    up in the attributes; campaigns keep one row per owner.
    """
    dims = stage(beta_filter(campaign_dims(star, p), "AS_email", p.beta_emails), "campaign-dims")
    shown = [c for c in CAMPAIGN_ATTRIBUTES if c not in without]
    client_columns = [c for c in shown if c not in CAMPAIGN_ONLY]
    client = F.struct(F.col("client_name").alias("combo"), row_id(*client_columns).alias("attributes_id"),
                      F.lit(True).alias("is_client"))
    campaign = F.struct(
        F.concat(F.coalesce("client_name", F.lit("NA")), F.lit(": "),
                 F.coalesce("campaign_name", F.lit("NA"))).alias("combo"),
        row_id(*CAMPAIGN_ATTRIBUTES).alias("attributes_id"), F.lit(False).alias("is_client"))
    levels = dims.select("campaign_id", "client_currency_id", F.explode(F.array(client, campaign)).alias("s"))
    daily = (campaign_sums(star, p, dims).join(levels, ["campaign_id", "client_currency_id"])
             .groupBy("s.combo", "s.attributes_id", "s.is_client", "day")
             .agg(*[F.sum(m).alias(m) for m in MEASURES])
             .withColumn("margin", F.try_divide("rext", "spend")))

    types = dict(dims.dtypes)
    marked = [F.lit(CAMPAIGN_ONLY[c]).cast(types[c]).alias(c) if c in CAMPAIGN_ONLY else F.col(c) for c in shown]
    attributes = dims.select(F.explode(F.array(
        F.struct(client.alias("key"), F.struct(*marked).alias("shown")),
        F.struct(campaign.alias("key"), F.struct(*shown).alias("shown")))).alias("s"))
    attributes = attributes.select("s.key.combo", "s.key.attributes_id", "s.shown.*")
    return SeriesFrame(daily, attributes.distinct())


def beta_filter(df: DataFrame, email_column: str, emails: tuple[str, ...] | None) -> DataFrame:
    """Keep the rows of the listed owners; None switches the filter off."""
    return df if emails is None else df.where(F.col(email_column).isin(*emails))


# ---- fixed values: countries reported by name -------------------------------
NAMED_TOP_LEVEL = ("US", "CANADA", "BRAZIL")
NAMED_SOUTH_AMERICA = ("ARGENTINA", "MEXICO", "CHILE", "COLOMBIA")
# -----------------------------------------------------------------------------


def territory_country() -> Column:
    level_1, name = F.col("client_country_level_1_name"), F.col("client_country_name")
    south = level_1 == "SOUTH AMERICA"
    return (F.when(level_1.isin(*NAMED_TOP_LEVEL), level_1)
            .when(south & name.isin(*NAMED_SOUTH_AMERICA), name)
            .when(south, "SAM OTHER"))


def _margin_usd(star: Star, p: P.RunParams, clients: DataFrame, keys: list[str]) -> DataFrame:
    """Revenue margin in constant US dollars per ``keys`` and day.

    Yearly constant rates first, daily rates where there is none.
    """
    since = F.lit(p.days_ago(p.live_window_days))
    raw = star.stats_2.where(F.col("day") >= since).select(
        "day", "campaign_id", "tac_local", "revenue_local", "affiliate_currency_id")
    facts = (in_scope(raw, clients, "campaign_id", p.broadcast_keys).distinct()
             .groupBy("campaign_id", "affiliate_currency_id", "day")
             .agg(F.coalesce(F.sum("revenue_local"), F.lit(0.0)).alias("revenue"),
                  F.coalesce(F.sum("tac_local"), F.lit(0.0)).alias("media"))
             .withColumn("year_code", F.year("day")))
    years = sorted({p.yesterday.year, p.days_ago(p.live_window_days).year})
    daily = star.fx_daily.where(F.col("day") >= since)
    yearly = star.fx_year.where(F.col("year_code").isin(*years) & (F.col("forecast_type_id") == 0))
    publisher = ["affiliate_currency_id", "client_currency_id"]

    def publisher_rates(df: DataFrame, when: str, name: str) -> DataFrame:
        return df.select(F.col("source_currency_id").alias("affiliate_currency_id"),
                         F.col("destination_currency_id").alias("client_currency_id"),
                         when, F.col("rate").alias(name)).distinct()

    def usd_rates(df: DataFrame, when: str, name: str) -> DataFrame:
        return (df.where(F.col("destination_currency_id") == P.USD_CURRENCY_ID)
                .select(F.col("source_currency_id").alias("client_currency_id"),
                        when, F.col("rate").alias(name)).distinct())

    priced = (facts.join(clients, "campaign_id")
              .join(publisher_rates(daily, "day", "pub_daily"), [*publisher, "day"], "left")
              .join(publisher_rates(yearly, "year_code", "pub_year"), [*publisher, "year_code"], "left")
              .join(usd_rates(daily, "day", "usd_daily"), ["client_currency_id", "day"], "left")
              .join(usd_rates(yearly, "year_code", "usd_year"), ["client_currency_id", "year_code"], "left"))
    usd = F.coalesce("usd_year", "usd_daily")
    earned = F.col("revenue") * F.coalesce(usd, F.lit(0.0))
    paid = F.col("media") * F.coalesce("pub_year", "pub_daily", F.lit(0.0)) * F.coalesce(usd, F.lit(1.0))
    return priced.groupBy("day", *keys).agg(F.sum(earned - paid).alias("RexT_USD_Constant"))


def _exec_clients(star: Star, columns: list[str]) -> DataFrame:
    """Clients of the executive report that have an owner on file."""
    clients = star.client.where(
        (F.col("client_country_level_3_name") == P.EXEC_AREA) & (F.col("ranking") == P.EXEC_RANKING)
        & ~F.col("vertical_level_3_name").isin(*P.EXEC_EXCLUDED_VERTICALS))
    clients = clients.select(
        "campaign_id", "account_strategist_employee_id", "client_currency_id", "client_country_name",
        "client_country_level_1_name", "client_country_level_2_name", "client_country_level_3_name",
        *columns).distinct()
    staff = star.employee.select(F.col("employee_id").alias("account_strategist_employee_id"))
    return clients.join(staff, "account_strategist_employee_id", "left_semi").select(
        "campaign_id", "client_currency_id", F.col("client_country_level_3_name").alias("area"),
        F.col("client_country_level_2_name").alias("region"), territory_country().alias("country"), *columns)


def territory_daily(star: Star, p: P.RunParams) -> DataFrame:
    clients = stage(_exec_clients(star, []), "exec-clients")
    return _margin_usd(star, p, clients, ["area", "region", "country"])


def account_daily(star: Star, p: P.RunParams) -> DataFrame:
    """Territory margin per client; only clients with facts on each of the last days."""
    clients = stage(_exec_clients(star, ["client_id", "client_name"]), "exec-clients")
    seen = in_scope(star.stats, clients, "client_id", p.broadcast_keys)
    live = live_keys(seen, "client_id", p.days_ago(p.required_days), p.yesterday, p.required_days)
    clients = stage(clients.join(live, "client_id", "left_semi"), "live-clients")
    return _margin_usd(star, p, clients, ["area", "region", "country", "client_name"])


def live_partners(star: Star, p: P.RunParams) -> DataFrame:
    """Partners active on enough days, with media cost in the last two days."""
    owners = _located(owner_dim(star, p), star)
    partners = star.client.where(predicate(p.client_filter)).select(
        "partner_id", "ts_engineer_employee_id", "ranking", "partner_name", "campaign_id",
        F.col("vertical_level_2_name").alias("RTC_vertical"), "vertical_name", "global_account_name").distinct()
    named = owners.withColumnsRenamed({
        "owner_name": "TS_name", "owner_email": "ts_engineer_email", "cost_center": "ts_cost_center",
        "country": "ts_country", "subregion": "ts_subregion", "region": "ts_region"})
    dims = stage(partners.join(named, F.col("ts_engineer_employee_id") == F.col("employee_id"))
                 .select("campaign_id", *TAG_ATTRIBUTES).withColumn("row_id", row_id(*TAG_ATTRIBUTES)), "partner-dims")
    raw = star.stats_2.where(
        F.col("day").between(F.lit(p.days_ago(p.live_window_days)), F.lit(p.yesterday))).select(
        "day", "campaign_id", F.col("tac_local").alias("tac"))
    media = (in_scope(raw, dims, "campaign_id", p.broadcast_keys).distinct()
             .groupBy("campaign_id", "day").agg(F.sum("tac").alias("tac")))
    rows = media.join(dims.select("campaign_id", "row_id"), "campaign_id")
    recent = F.col("day").isin(p.yesterday, p.days_ago(2))
    live = rows.groupBy("row_id").agg(
        F.size(F.collect_set("day")).cast("bigint").alias("days_live"),
        F.sum(F.when(recent, F.col("tac")).otherwise(0.0)).alias("recent_tac"))
    live = live.where((F.col("days_live") >= p.required_days) & (F.col("recent_tac") > 0))
    return dims.drop("campaign_id").distinct().join(live, "row_id").drop("row_id")


def tag_event_name() -> Column:
    name = F.col("event_name")
    return F.when(name == "page", "homepage").when(name == "itempageview", "product").otherwise(name)


def tag_counts(star: Star, p: P.RunParams, live: DataFrame) -> DataFrame:
    since = p.days_ago(p.account_window_days)
    if p.daily_store:
        return in_scope(kept_sums(star.events, f"{p.daily_store}/events", since, event_sums), live, "partner_id", p.broadcast_keys)
    return event_sums(in_scope(star.events.where(F.col("day") >= F.lit(since)), live, "partner_id", p.broadcast_keys))


def event_sums(events: DataFrame) -> DataFrame:
    return events.groupBy("partner_id", "day", "site_type", tag_event_name().alias("event_name")).agg(F.sum("events").alias("events"))


def reported_partners(star: Star, p: P.RunParams) -> DataFrame:
    live = live_partners(star, p).select(*TAG_ATTRIBUTES).withColumn(
        "ts_subregion", F.when(F.col("ts_cost_center") == "LM", "LATAM").otherwise(F.col("ts_subregion")))
    return beta_filter(live, "ts_engineer_email", p.beta_emails)


def tag_daily(star: Star, p: P.RunParams) -> DataFrame:
    """Daily events per tag of every live partner."""
    live = stage(reported_partners(star, p).distinct(), "live-partners")
    return tag_counts(star, p, live).join(live, "partner_id").select(*TAG_ATTRIBUTES, "day", "site_type", "event_name", "events")


def tag_series(star: Star, p: P.RunParams) -> SeriesFrame:
    """Tags and their site totals as daily series, cleaned, in one aggregation.

    ``row_id`` keeps tag rows apart that only look alike after cleaning; site
    totals are formed over the cleaned attributes. The attributes returned are
    those of the partners (no ``combo`` yet).
    """
    live = reported_partners(star, p).withColumn("raw_id", row_id(*TAG_ATTRIBUTES))
    live = clean_data(live).withColumn("attributes_id", row_id(*TAG_ATTRIBUTES))
    live = stage(live, "live-partners")
    site, event = F.coalesce("site_type", F.lit("0")), F.coalesce("event_name", F.lit("0"))

    def level(site: Column, event: Column, row_id: Column) -> Column:
        combo = F.concat_ws(" ", "partner_name", event, F.lit("on"), site, F.lit("managed by"), "TS_name")
        return F.struct(combo.alias("combo"), site.alias("site_type"), event.alias("event_name"), row_id.alias("row_id"))

    total = F.lit(P.SITE_LEVEL)
    rows = tag_counts(star, p, live).join(
        live.select("partner_id", "partner_name", "TS_name", "raw_id", "attributes_id"), "partner_id")
    rows = rows.select("attributes_id", "day", "events", F.explode(F.array(
        level(site, event, row_id("raw_id", "site_type", "event_name")),
        level(total, total, F.lit(0).cast("bigint")))).alias("s"))
    daily = rows.groupBy("s.combo", "attributes_id", "s.site_type", "s.event_name", "s.row_id", "day").agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("events")).drop("row_id")
    return SeriesFrame(daily, live.select("attributes_id", *TAG_ATTRIBUTES).distinct())
