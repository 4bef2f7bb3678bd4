"""Executive report: margin by territory and by client."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsewatch import params as P
from pulsewatch.functions import texts as X
from pulsewatch.functions.cleaning import clean_data
from pulsewatch.operators.calendar import calendar_fill
from pulsewatch.operators.detector import detector_flags, detector_stats
from pulsewatch.operators.quantiles import oversized_keys
from pulsewatch.plans.account_alerts import Detection
from pulsewatch.plans.features import territory_daily
from pulsewatch.sources.stage import stage
from pulsewatch.sources.warehouse import Star, require_rows

# ---- fixed values: regions of the executive report --------------------------
CHART_GROUPS = {
    "americas": ("AMERICAS", "NORTH AMERICA", "LATAM"),
    "na": ("US", "CANADA"),
    "latam": ("ARGENTINA", "BRAZIL", "CHILE", "COLOMBIA", "MEXICO", "SAM OTHER"),
}
HIGHLIGHT_REGIONS = {
    "americas": "AMERICAS", "na": "NORTH AMERICA", "latam": "LATAM", "us": "US", "canada": "CANADA",
    "brazil": "BRAZIL", "sam": "SAM", "argentina": "ARGENTINA", "chile": "CHILE", "colombia": "COLOMBIA",
    "mexico": "MEXICO",
}
ACCOUNT_REGIONS = ("NORTH AMERICA", "LATAM")
LIST_LENGTH = 5
CHART_DAYS = 15
# -----------------------------------------------------------------------------


def _level(depth: int, name: str, region: Column, subregion: Column, country: Column) -> Column:
    return F.struct(F.lit(depth).alias("depth"), F.col(name).alias("series"), region.alias("region"),
                    subregion.alias("subregion"), country.alias("country"))


def _rolled_up(daily: DataFrame, with_path: bool) -> DataFrame:
    """Margin at the three levels of the territory tree, in one aggregation.

    With path, equal names under two parents stay apart; without, they merge.
    """
    rows = clean_data(daily).select("day", F.col("area").alias("region"), F.col("region").alias("subregion"),
                                    "country", "RexT_USD_Constant")
    region, subregion, country = F.col("region"), F.col("subregion"), F.col("country")
    none = F.lit(P.NOT_APPLICABLE)
    if with_path:
        levels = [_level(1, "region", region, none, none), _level(2, "subregion", region, subregion, none),
                  _level(3, "country", region, subregion, country)]
    else:
        levels = [_level(d, n, none, none, none) for d, n in enumerate(("region", "subregion", "country"), 1)]
    return (rows.select("day", "RexT_USD_Constant", F.explode(F.array(*levels)).alias("l"))
            .groupBy("l", "day").agg(F.sum("RexT_USD_Constant").alias("RexT"))
            .select("l.*", "day", "RexT"))


def territory_series(daily: DataFrame) -> DataFrame:
    """(series, day, RexT) for regions, subregions and countries."""
    return _rolled_up(daily, with_path=False).select("series", "day", "RexT")


def territory_paths(daily: DataFrame) -> DataFrame:
    """Like ``territory_series``, keeping the parents ("N/A" below the level)."""
    return _rolled_up(daily, with_path=True).drop("depth")


def territory_rows(star: Star, p: P.RunParams) -> DataFrame:
    return require_rows(stage(territory_daily(star, p), "territory-daily"), "territory features")


def detect_territories(daily: DataFrame, p: P.RunParams, keep_history: bool = False) -> Detection:
    series = stage(territory_series(daily), "territory-series")
    large = oversized_keys(series, "series", p.oversized_rows)
    cleaned = calendar_fill(series, "series", ["RexT"], large)
    if keep_history:
        cleaned = stage(cleaned, "cleaned")
    stats = detector_stats(cleaned, "series", ["RexT"], p.yesterday, large)
    flags = detector_flags(stats, {"RexT": P.rule_for("exec")}, p.yesterday)
    return Detection(flags.select("series", "is_alert"), cleaned, flags)


def alert_text(results: DataFrame) -> DataFrame:
    """Names of the alerting territories in one text, or NONE. One row."""
    names = results.where("is_alert").select("series")
    joined = F.expr("listagg(series, ', ') WITHIN GROUP (ORDER BY series)")
    return names.agg(F.coalesce(joined, F.lit("NONE")).alias("alerts"))


def territory_report(cleaned: DataFrame, p: P.RunParams) -> DataFrame:
    """Expected (mean of the seven days before) against actual, as text."""
    day, y = F.col("day"), F.lit(p.yesterday)
    week = (day < y) & (day >= F.date_sub(y, 7))
    rows = cleaned.where(day.between(F.date_sub(y, 7), y)).groupBy("series").agg(
        F.avg(F.when(week, F.col("RexT"))).alias("expected"),
        F.collect_list(F.when(day == y, F.col("RexT"))).alias("actuals"))
    rows = rows.where(F.col("expected").isNotNull()).select(
        "series", "expected", F.explode("actuals").alias("actual"))
    return rows.select(
        "series", X.currency_text(F.col("expected")).alias("avg_last_7D"),
        X.currency_text(F.col("actual")).alias("yesterday_RexT"),
        X.percent_text(X.percent_difference(F.col("expected"), F.col("actual")), plus=True).alias("differences"))


def territory_chart(cleaned: DataFrame, p: P.RunParams) -> DataFrame:
    """The last days of each charted series; labels on the last two days."""
    chart = None
    for group, names in CHART_GROUPS.items():
        chart = (F.when if chart is None else chart.when)(F.col("series").isin(*names), group)
    value = X.round_even(F.col("RexT"), 2)
    labelled = F.col("day").isin(p.yesterday, p.days_ago(2))
    return (cleaned.where(F.col("day") > F.date_sub(F.lit(p.yesterday), CHART_DAYS))
            .select(chart.alias("chart"), "series", "day", value.alias("RexT"),
                    F.when(labelled, X.currency_text(value)).alias("label"))
            .where(F.col("chart").isNotNull()))


def territory_highlight(text: DataFrame) -> DataFrame:
    """One row per region of the report: is its name part of the alert text?"""
    regions = F.explode(F.array(*[
        F.struct(F.lit(key).alias("region"), F.lit(name).alias("locale"))
        for key, name in HIGHLIGHT_REGIONS.items()]))
    return text.select("alerts", regions.alias("r")).select(
        "r.region", "r.locale", F.contains(F.col("alerts"), F.col("r.locale")).alias("is_highlighted"))


def account_alerts(daily: DataFrame, p: P.RunParams) -> DataFrame:
    """Clients whose margin moved abnormally, with expected and actual values.

    Rows are summed to one per client, region and day first. No calendar fill
    and no smallest deviation, as opposed to the territory series.
    """
    per_day = clean_data(daily).groupBy("client_name", "region", "day").agg(
        F.sum("RexT_USD_Constant").alias("exec"))
    series = stage(per_day.withColumn("series", F.struct("client_name", "region")), "account-series")
    y = F.lit(p.yesterday)
    week = (F.col("day") >= F.date_sub(F.lit(p.today), 8)) & (F.col("day") < y)
    stats = detector_stats(series, "series", ["exec"], p.yesterday, None, extra=[
        F.avg(F.when(week, F.col("exec"))).alias("expected"),
        F.max_by("exec", "day").alias("actual")])
    rule = P.KpiRule(P.rule_for("exec").confidence, "both", None)
    flags = detector_flags(stats, {"exec": rule}, p.yesterday)
    return (flags.where(F.col("is_alert") & (F.col("expected") > 0))
            .select("series.client_name", "series.region", "expected", "actual",
                    F.abs(F.col("actual") - F.col("expected")).alias("magnitude"),
                    X.percent_difference(F.col("expected"), F.col("actual")).alias("percent_diff")))


def gainers_losers(alerts: DataFrame, daily: DataFrame) -> DataFrame:
    """Five largest gains and losses per region, padded to five lines each.

    A change of exactly 0 % counts as a loss. Without any account data the lines
    say so. Spark keeps five rows per side and task before the final ranking.
    """
    side = F.when(F.col("percent_diff") > 0, "gainers").otherwise("losers")
    largest = Window.partitionBy("region", "side").orderBy(F.col("magnitude").desc(), F.col("client_name"))
    top = (alerts.where(F.col("region").isin(*ACCOUNT_REGIONS)).withColumn("side", side)
           .withColumn("position", F.row_number().over(largest))
           .where(F.col("position") <= LIST_LENGTH))
    sign = F.when(F.col("side") == "gainers", "+").otherwise("-")
    shown = top.select(
        "region", "side", "position", F.col("client_name").alias("client"),
        X.currency_text(F.col("actual")).alias("actual"), X.currency_text(F.col("expected")).alias("expected"),
        X.percent_text(F.col("percent_diff"), plus=True).alias("percent_diff"),
        F.concat(sign, X.currency_text(F.col("magnitude"))).alias("deviation"))
    is_late = daily.limit(1).agg(F.count(F.lit(1)).alias("n")).select(F.col("n") == 0).scalar()
    spine = alerts.sparkSession.createDataFrame(
        [(r, s, i) for r in ACCOUNT_REGIONS for s in ("gainers", "losers") for i in range(1, LIST_LENGTH + 1)],
        T.StructType([T.StructField("region", T.StringType()), T.StructField("side", T.StringType()),
                      T.StructField("position", T.IntegerType())]))
    blank = F.when(is_late, "DATA IS LATE").otherwise("")
    return spine.join(shown, ["region", "side", "position"], "left").select(
        "region", "side", "position", F.coalesce("client", blank).alias("client"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("actual", "expected", "percent_diff", "deviation")])
