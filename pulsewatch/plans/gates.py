"""Checks before a run, and the outbox after it."""

from __future__ import annotations

from datetime import date
from string import Formatter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewatch import params as P
from pulsewatch.functions import texts as X

# ---- fixed values: product names and notice texts ---------------------------
PRODUCTS = ("AS", "TS", "EXEC")
CHAT_KINDS = {"AS": "business", "TS": "technical", "EXEC": "executive"}
CHAT_LATE = "_{kind}_ alerts can't be sent today because data is late :cry:"
CHAT_NO_ALERTS = "No _{kind}_ alerts to send for today :grinning:"
CHAT_ERROR = "{product} can't run today due to issues querying the warehouse :disappointed:"
SUBJECTS = {
    "no_alerts": "No Alerts to Send for {scope}",
    "late": "Data Delayed -- No {scope} Alerts",
    "error": "{scope} Alerts Unable to Run Today",
}
NO_ALERTS_BODY = "There are no alerts for today."
# -----------------------------------------------------------------------------


def _known(product: str) -> str:
    if product.upper() not in PRODUCTS:
        raise ValueError(f"unknown product {product!r}; known: {', '.join(PRODUCTS)}")
    return product.upper()


# ---- freshness --------------------------------------------------------------

def loaded_today(reports: DataFrame, today: date, schemas: list[str], tables: list[str]) -> DataFrame:
    """Tables of interest that were loaded today."""
    return reports.where(
        (F.col("update_time") >= F.lit(today).cast("timestamp")) & F.col("table_schema").isin(schemas)
        & F.col("table_name").isin(tables)).select("table_name", "update_time")


def freshness(required: DataFrame, loaded: DataFrame) -> DataFrame:
    """Every required table with ``is_late``."""
    seen = loaded.select("table_name").distinct().withColumn("is_loaded", F.lit(True))
    return required.select("table_name").distinct().join(seen, "table_name", "left").select(
        "table_name", F.col("is_loaded").isNull().alias("is_late"))


def data_late(checked: DataFrame) -> bool:
    return not checked.where("is_late").isEmpty()


# ---- run history ------------------------------------------------------------

def jobs_to_run(jobs: DataFrame, history: DataFrame, today: date) -> DataFrame:
    """Jobs (script, geo) that did not run successfully today."""
    done = history.where(F.col("run_date") == F.lit(today)).select("script", "geo").distinct()
    return jobs.join(done, ["script", "geo"], "left_anti")


# ---- outbox -----------------------------------------------------------------

OUTBOX_COLUMNS = ("product", "kind", "to", "cc", "bcc", "subject", "body", "run_date")


def _row(product: str, kind: str, to: Column, cc: Column, bcc: Column, subject: Column, body: Column,
         run_date: date) -> list[Column]:
    values = (F.lit(product), F.lit(kind), to, cc, bcc, subject, body, F.lit(run_date))
    return [v.alias(c) for v, c in zip(values, OUTBOX_COLUMNS)]


def _text(value: str | None) -> Column:
    return F.lit(value).cast("string")


def _test(d: P.DeliveryParams, usual: Column, value: Column) -> Column:
    return value if d.test_mode else usual


def _subject(d: P.DeliveryParams, *parts: Column) -> Column:
    prefix = "[TEST] " if d.test_mode else ""
    return F.concat(F.lit(prefix), *parts)


def owner_notices(alerts: DataFrame, d: P.DeliveryParams, p: P.RunParams) -> DataFrame:
    """One mail per account owner with alerts."""
    owners = alerts.select("AS_email", "AS_name").distinct()
    return owners.select(*_row(
        "AS", "alert", _test(d, F.col("AS_email"), _text(d.test_email)), _test(d, _text(d.cc), _text(None)),
        _test(d, _text(d.maintainers), _text(None)),
        _subject(d, F.lit(f"{d.product_label} AS Alert for "), X.title_name(F.col("AS_name"))), _text(None), p.today))


def tag_owner_notices(alerts: DataFrame, d: P.DeliveryParams, p: P.RunParams) -> DataFrame:
    owners = alerts.select("ts_engineer_email", "TS_name").distinct()
    return owners.select(*_row(
        "TS", "alert", _test(d, F.col("ts_engineer_email"), _text(d.test_email)), _text(None), _text(d.maintainers),
        _subject(d, F.lit("TS Alert for "), X.every_part_capitalized(F.col("TS_name"))), _text(None), p.today))


def summary_notices(summary: DataFrame, d: P.DeliveryParams, p: P.RunParams, product: str = "AS") -> DataFrame:
    """Daily statistics: per ranking for accounts, one mail for tags."""
    day = X.day_text(F.lit(p.today))
    if _known(product) == "AS":
        tier = F.lower(F.replace("ranking", F.lit(" "), F.lit("")))
        cc = _text(None)
        for name, address in d.summary_cc.items():
            cc = F.when(tier == name, address).otherwise(cc)
        when = X.moment_text(d.sent_at, d.timezone) if d.test_mode else day
        subject = _subject(d, F.lit(f"{d.product_label} Alerts {d.geo} "), F.col("ranking"), F.lit(" Daily Stats "), when)
    else:
        cc = _text(d.summary_cc.get("all"))
        subject = _subject(d, F.lit(f"{d.product_label} TS Alerts {d.geo} Daily Stats "), day)
    return summary.select(*_row(
        product, "summary", _text(d.test_email if d.test_mode else d.maintainers), _test(d, cc, _text(None)),
        _text(None), subject, F.col("body"), p.today))


def executive_notice(text: DataFrame, d: P.DeliveryParams, p: P.RunParams) -> DataFrame:
    return text.select(*_row(
        "EXEC", "alert", _text(d.test_email if d.test_mode else d.recipients),
        _test(d, _text(d.cc), _text(None)), _text(None),
        _subject(d, F.lit(f"{d.geo} {d.product_label} Alert")), F.col("alerts"), p.today))


def trouble_notices(jobs: DataFrame, d: P.DeliveryParams, p: P.RunParams) -> DataFrame:
    """Notices that runs have no alerts, cannot run for late data, or failed: one for each row (product, kind, geo) of ``jobs``.

    To the beta testers if the beta is on, else the alias, else the recipients; "no alerts" goes to the maintainers. The outbox
    columns, and geo and the chat text beside them.
    """
    product, calm = F.col("product"), F.col("kind") == "no_alerts"
    scope = F.concat_ws(" ", F.lit(d.product_label), product, "geo")

    def filled(template: str, **parts: Column) -> Column:
        """A text with columns in the place of its named fields."""
        pieces = [(F.lit(text), parts.get(name)) for text, name, *_ in Formatter().parse(template)]
        return F.concat(*[x for pair in pieces for x in pair if x is not None])

    def by_kind(texts: dict[str, Column]) -> Column:
        out = F.lit(None).cast("string")
        for kind, text in texts.items():
            out = F.when(F.col("kind") == kind, text).otherwise(out)
        return out

    readers = d.beta_testers if d.beta_active else d.alias if d.alias is not None else d.recipients

    def usually(value: str | None, calm_value: str | None, in_test: str | None) -> Column:
        return _test(d, F.when(calm, _text(calm_value)).otherwise(_text(value)), _text(in_test))

    tone = F.element_at(F.create_map(*[F.lit(x) for pair in CHAT_KINDS.items() for x in pair]), product)
    chat = by_kind({k: filled(t, kind=tone, product=product) for k, t in (("late", CHAT_LATE), ("no_alerts", CHAT_NO_ALERTS), ("error", CHAT_ERROR))})
    subject = by_kind({k: filled(t, scope=scope) for k, t in SUBJECTS.items()})
    return jobs.select(
        product, F.col("kind"), usually(readers, d.maintainers, d.test_email).alias("to"), usually(d.cc, None, None).alias("cc"),
        usually(d.maintainers, None, None).alias("bcc"), _subject(d, subject).alias("subject"), F.when(calm, NO_ALERTS_BODY).alias("body"),
        F.lit(p.today).alias("run_date"), "geo", chat.alias("chat"))


def _job(spark: SparkSession, product: str, kind: str, d: P.DeliveryParams) -> DataFrame:
    if kind not in SUBJECTS:
        raise ValueError(f"unknown notice {kind!r}")
    return spark.range(1).select(F.lit(_known(product)).alias("product"), F.lit(kind).alias("kind"), F.lit(d.geo).alias("geo"))


def trouble_notice(spark: SparkSession, product: str, kind: str, d: P.DeliveryParams, p: P.RunParams) -> DataFrame:
    """The notice of one job, as outbox row."""
    return trouble_notices(_job(spark, product, kind, d), d, p).select(*OUTBOX_COLUMNS)


def chat_channels(d: P.DeliveryParams) -> list[str]:
    return [d.test_channel] if d.test_mode else sorted(set(d.channels.values()))


def chat_notices(spark: SparkSession, product: str, kind: str, d: P.DeliveryParams) -> DataFrame:
    """(channel, text): the chat text of a late, empty or failed run once for every channel."""
    channels = F.array(*map(F.lit, chat_channels(d))).cast("array<string>")
    told = trouble_notices(_job(spark, product, kind, d), d, P.RunParams(today=d.sent_at.date()))
    return told.select(F.explode(channels).alias("channel"), F.col("chat").alias("text"))


def unsent(outbox: DataFrame, sent: DataFrame) -> DataFrame:
    """Mails not yet sent today, each (to, subject) once."""
    fresh = outbox.join(sent.select("run_date", "to", "subject").distinct(), ["run_date", "to", "subject"], "left_anti")
    return fresh.dropDuplicates(["run_date", "to", "subject"]).select(*OUTBOX_COLUMNS)
