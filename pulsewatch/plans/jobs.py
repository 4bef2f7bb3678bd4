"""The daily jobs: gate, pull, detect, report, commit.

Every job writes its tables into an attempt folder and commits them, its run and its mails in one step (``runs``); it can be
repeated after breaking off anywhere. It returns what happened: "done", "no_alerts", "late" or "already_ran". A pull that fails
or returns nothing raises; the last try of the day tells the readers first. Delivery itself (mail, chat, scheduling) is left to
the caller, who reads the outbox and chat tables of the committed folder. What a job stages is deleted when it ends.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from pulsewatch import params as P
from pulsewatch.plans import account_alerts as AS
from pulsewatch.plans import export as E
from pulsewatch.plans import features as X
from pulsewatch.plans import gates as G
from pulsewatch.plans import reports as R
from pulsewatch.plans import tag_alerts as TS
from pulsewatch.plans import territory as EX
from pulsewatch.plans.runs import OUTBOX, Attempt, JobFiles, logged_runs, sent_history
from pulsewatch.sources.sinks import write_csv, write_documents
from pulsewatch.sources.stage import stage, staging_scope
from pulsewatch.sources.warehouse import Star, require_rows


@dataclass(frozen=True)
class Gate:
    """Source tables that must have been loaded today."""

    schemas: tuple[str, ...]
    tables: tuple[str, ...]
    last_try: bool = False


@dataclass(frozen=True)
class Job:
    """One run of a product: what it reads, its parameters and where it writes."""

    spark: SparkSession
    star: Star
    product: str
    gate: Gate
    p: P.RunParams
    d: P.DeliveryParams
    files: JobFiles

    def attempt(self) -> Attempt:
        return Attempt(self.spark, self.files, self.product, self.d.geo, self.p.today)

    def send(self, attempt: Attempt, outbox: DataFrame) -> None:
        """Store the mails that are not sent yet; the commit makes them sent."""
        sent = self.star.sent_history.unionByName(sent_history(self.spark, self.files.log, self.p.today))
        attempt.write(G.unsent(outbox, sent), OUTBOX)

    def tell(self, kind: str) -> None:
        """Mail and chat of a run with late data or a failed pull, once a day. Such a run does not count."""
        with self.attempt() as attempt:
            self.write_notices(attempt, kind)
            attempt.commit(kind, counts=False)

    def write_notices(self, attempt: Attempt, kind: str) -> None:
        attempt.write(G.chat_notices(self.spark, self.product, kind, self.d), "chat")
        self.send(attempt, G.trouble_notice(self.spark, self.product, kind, self.d, self.p))

    def pulled(self, pull: Callable[[], X.SeriesFrame | DataFrame]) -> X.SeriesFrame | DataFrame:
        """What a pull returns; if it fails or has no rows on the last try, the readers are told before the error goes on."""
        try:
            return pull()
        except Exception:
            if self.gate.last_try:
                self.tell("error")
            raise

    def blocked(self) -> str | None:
        """"already_ran" or "late" if the job must not start; the last try tells the readers."""
        job = self.spark.createDataFrame([(self.product, self.d.geo)], "script string, geo string")
        runs = self.star.run_history.unionByName(logged_runs(self.spark, self.files.log, self.p.today))
        if G.jobs_to_run(job, runs, self.p.today).isEmpty():
            return "already_ran"
        required = self.spark.createDataFrame([(t,) for t in self.gate.tables], "table_name string")
        loaded = G.loaded_today(self.star.import_reports, self.p.today, list(self.gate.schemas), list(self.gate.tables))
        if not G.data_late(G.freshness(required, loaded)):
            return None
        if self.gate.last_try:
            self.tell("late")
        return "late"


def _daily(product: str):
    """A job with a gate, a staging folder and an attempt of its own; what it returns is what the attempt is committed as."""
    def decorate(report: Callable[[Job, Attempt], str]):
        @wraps(report)
        def run(spark: SparkSession, star: Star, gate: Gate, p: P.RunParams, d: P.DeliveryParams, files: JobFiles) -> str:
            job = Job(spark, star, product, gate, p, d, files)
            with staging_scope(spark):
                reason = job.blocked()
                if reason:
                    return reason
                with job.attempt() as attempt:
                    kind = report(job, attempt)
                    return kind if attempt.commit(kind) else "already_ran"
        return run
    return decorate


@_daily("AS")
def run_account_job(job: Job, attempt: Attempt) -> str:
    p, d = job.p, job.d
    rows = job.pulled(lambda: AS.account_rows(job.star, p))
    found = AS.detect_accounts(rows, p, keep_history=True)
    attempt.write(found.results, "results")
    found = replace(found, results=attempt.read("results"))
    alerts = stage(AS.account_alerts(found, p), "alerts")
    if alerts.isEmpty():
        job.write_notices(attempt, "no_alerts")
        return "no_alerts"
    charts = stage(R.account_chart_input(found.cleaned, found.attributes, alerts, p.pod_leaders), "charts")
    axis = R.chart_axis(charts)
    digest = R.owner_digest(alerts, axis.select("AS_email", "combo", "kpi", "last_label"))
    summary = R.account_summary(alerts)
    attempt.write(alerts.orderBy(*AS.report_order()), "alerts")
    attempt.write(charts, "chart_series")
    attempt.write(axis, "chart_axis")
    attempt.write(R.account_links(alerts, p, d), "links")
    attempt.write(R.owner_documents(digest), "owner_documents")
    attempt.write(summary, "summary")
    attempt.write(R.account_digest(alerts, d), "chat")
    recap = R.account_recap(alerts).sort(*R.recap_order()).select("ranking", "AS_name", "combo", "kpi")
    attempt.write_with(write_csv, recap, "recap", ("ranking",))
    job.send(attempt, G.owner_notices(alerts, d, p).unionByName(G.summary_notices(summary, d, p)))
    return "done"


@_daily("TS")
def run_tag_job(job: Job, attempt: Attempt) -> str:
    p, d = job.p, job.d
    rows = job.pulled(lambda: TS.tag_rows(job.star, p))
    found = TS.detect_tags(rows, p, keep_history=True)
    alerts = stage(TS.tag_alerts(found.results), "tag-alerts")
    # without alerts the documents are an empty folder, never those of the last run
    attempt.write_with(write_documents, TS.owner_documents(alerts), "documents")
    if alerts.isEmpty():
        job.write_notices(attempt, "no_alerts")
        return "no_alerts"
    summary = R.tag_summary(alerts)
    attempt.write(R.chart_axis(R.tag_chart_input(found.cleaned, alerts)), "chart_axis")
    attempt.write(R.tag_links(alerts, p, d), "links")
    attempt.write(summary, "summary")
    attempt.write(R.tag_digest(alerts, d, d.channels.get("all", "#tags")), "chat")
    attempt.write_with(write_csv, alerts.sort("TS_name", "partner_name", "event_name", "site_type"), "recap")
    job.send(attempt, G.tag_owner_notices(alerts, d, p).unionByName(G.summary_notices(summary, d, p, "TS")))
    return "done"


@_daily("EXEC")
def run_territory_job(job: Job, attempt: Attempt) -> str:
    """Both pulls come first, so a failure of either tells the readers and leaves nothing behind."""
    p, d = job.p, job.d
    rows = job.pulled(lambda: EX.territory_rows(job.star, p))
    daily = job.pulled(lambda: require_rows(stage(X.account_daily(job.star, p), "account-daily"), "account margin"))
    found = EX.detect_territories(rows, p, keep_history=True)
    found = replace(found, results=stage(found.results, "results"))
    text = stage(EX.alert_text(found.results), "alert-text")
    attempt.write(EX.territory_report(found.cleaned, p), "report")
    attempt.write(EX.territory_chart(found.cleaned, p), "chart")
    attempt.write(EX.territory_highlight(text), "highlight")
    attempt.write(EX.gainers_losers(EX.account_alerts(daily, p), daily), "gainers_losers")
    job.send(attempt, G.executive_notice(text, d, p))
    return "done"


def run_export_job(spark: SparkSession, star: Star, p: P.RunParams, out: str) -> list[str]:
    """The three labelling exports as CSV folders; no gate, no detection. Each call writes to a folder of its own."""
    with staging_scope(spark):
        attempt = Attempt(spark, JobFiles(out, ""), "EXPORT", "all", p.today)
        for name, build in (("accounts", E.export_accounts), ("tags", E.export_tags), ("territories", E.export_territories)):
            attempt.write_with(write_csv, build(star, p), name)
        return [f"{attempt.folder}/{name}" for name in attempt.tables]
