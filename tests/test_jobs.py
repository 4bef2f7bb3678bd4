"""The daily jobs end to end on the smallest data set."""

from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest

from pulsewatch import params as P
from pulsewatch.catalog import DELIVERY, RUN
from pulsewatch.plans import jobs as J
from pulsewatch.plans import runs as N
from pulsewatch.sources.sample import sample_star
from pulsewatch.sources.stage import staging_root
from pulsewatch.sources.warehouse import SCHEMAS, EmptySourceError, Star, load_star, read_table

GATE = J.Gate(("schema_1",), ("view_table", "click_table"))


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """The sample warehouse written as parquet files; nothing was run or sent before."""
    root = tmp_path_factory.mktemp("warehouse")
    star = sample_star(spark, sf_dir)
    for name in SCHEMAS:
        table = spark.createDataFrame([], SCHEMAS[name]) if name in ("run_history", "sent_history") else getattr(star, name)
        table.write.parquet(f"{root}/{name}")
    return load_star(spark, {name: f"{root}/{name}" for name in SCHEMAS})


def files_in(folder):
    return J.JobFiles(f"{folder}/out", f"{folder}/log")


def output(spark, files, script, name, kind=None, p=RUN):
    folder = N.committed(spark, files.log, p.today, script, DELIVERY.geo, kind)
    return spark.read.parquet(f"{folder}/{name}")


def sent(spark, files, p=RUN):
    return sorted((r.to, r.subject) for r in N.sent_history(spark, files.log, p.today).collect())


def attempts(files):
    return sorted(x.name for x in Path(files.out).glob("*/*/*"))


def test_account_job_runs_once(spark, stored, tmp_path):
    files = files_in(tmp_path)
    assert J.run_account_job(spark, stored, GATE, RUN, DELIVERY, files) == "done"
    alerts = output(spark, files, "AS", "alerts")
    assert {(r.client_id % 10, r.kpi) for r in alerts.collect()} >= {(1, "cos"), (2, "cos"), (3, "rext"), (7, "rext")}
    outbox = output(spark, files, "AS", "outbox")
    assert outbox.where("kind = 'alert'").count() == alerts.select("AS_email").distinct().count()
    folder = N.committed(spark, files.log, RUN.today, "AS", DELIVERY.geo)
    recap = spark.read.option("header", True).csv(f"{folder}/recap")
    assert recap.count() == alerts.where("AS_name <> manager_name").count()
    assert output(spark, files, "AS", "chart_series").select("combo", "kpi").distinct().count() == alerts.select("combo", "kpi").distinct().count()
    assert [tuple(r) for r in N.logged_runs(spark, files.log, RUN.today).collect()] == [(RUN.today, "AS", DELIVERY.geo)]
    before = sent(spark, files)
    assert J.run_account_job(spark, stored, GATE, RUN, DELIVERY, files) == "already_ran"
    assert sent(spark, files) == before and len(before) == outbox.count() and len(attempts(files)) == 1


class Broken(RuntimeError):
    pass


def breaking(monkeypatch, step, left):
    """The job's process dies at the given step, after ``left`` of them: nothing is tidied up."""
    real, count = getattr(N.Attempt, step), [left]

    def run(self, *args, **kwargs):
        count[0] -= 1
        if count[0] < 0:
            raise Broken
        return real(self, *args, **kwargs)

    monkeypatch.setattr(N.Attempt, step, run)
    monkeypatch.setattr(N.Attempt, "__exit__", lambda *a: None)


WRITES = 5      # tables of the executive job


@pytest.mark.parametrize("left", range(WRITES + 1))
def test_a_job_that_broke_off_is_repeated_into_one_output(spark, stored, tmp_path, left):
    """Broken off after each write, and between the last one and the commit."""
    files = files_in(tmp_path)
    with pytest.MonkeyPatch.context() as patch:
        breaking(patch, "write" if left < WRITES else "commit", left if left < WRITES else 0)
        with pytest.raises(Broken):
            J.run_territory_job(spark, stored, GATE, RUN, DELIVERY, files)
    assert len(attempts(files)) == min(left, 1) and not sent(spark, files) and N.committed(spark, files.log, RUN.today, "EXEC", DELIVERY.geo) is None
    assert N.logged_runs(spark, files.log, RUN.today).isEmpty()
    assert J.run_territory_job(spark, stored, GATE, RUN, DELIVERY, files) == "done"
    assert len(attempts(files)) == 1
    folder = Path(N.committed(spark, files.log, RUN.today, "EXEC", DELIVERY.geo))
    assert sorted(x.name for x in folder.iterdir()) == ["chart", "gainers_losers", "highlight", "outbox", "report"]
    assert [s for _, s in sent(spark, files)] == ["Americas KPI Alert"]
    assert J.run_territory_job(spark, stored, GATE, RUN, DELIVERY, files) == "already_ran"
    assert [s for _, s in sent(spark, files)] == ["Americas KPI Alert"]


def test_a_job_that_dies_after_the_commit_is_done(spark, stored, tmp_path, monkeypatch):
    files = files_in(tmp_path)
    monkeypatch.setattr(N.Attempt, "_sweep", lambda self: (_ for _ in ()).throw(Broken))
    with pytest.raises(Broken):
        J.run_territory_job(spark, stored, GATE, RUN, DELIVERY, files)
    assert J.run_territory_job(spark, stored, GATE, RUN, DELIVERY, files) == "already_ran"
    assert len(sent(spark, files)) == 1 and output(spark, files, "EXEC", "gainers_losers").count() == 20


def test_of_two_runs_at_a_time_one_counts(spark, tmp_path):
    files = files_in(tmp_path)
    first, second = (N.Attempt(spark, files, "AS/x", "US & CA", RUN.today) for _ in range(2))
    mails = spark.createDataFrame([("a@e", "s", RUN.today)], "to string, subject string, run_date date")
    with first, second:
        for one in (first, second):
            one.write(mails, "outbox")
        assert second.commit("done") and not first.commit("done")
    assert attempts(files) == [Path(second.folder).name]
    assert [tuple(r) for r in N.logged_runs(spark, files.log, RUN.today).collect()] == [(RUN.today, "AS/x", "US & CA")]
    assert N.sent_mails(spark, files.log, RUN.today).count() == 1
    assert N.manifests(spark, files.log, date(2024, 3, 2)).isEmpty() and N.sent_history(spark, files.log, date(2024, 3, 2)).isEmpty()


def test_histories_of_the_warehouse_count_too(spark, stored, tmp_path):
    files = files_in(tmp_path)
    ran = spark.createDataFrame([(RUN.today, "EXEC", DELIVERY.geo)], SCHEMAS["run_history"])
    tables = {name: getattr(stored, name) for name in SCHEMAS}
    assert J.run_territory_job(spark, Star(**{**tables, "run_history": ran}), GATE, RUN, DELIVERY, files) == "already_ran"
    mailed = spark.createDataFrame([(RUN.today, DELIVERY.recipients, "Americas KPI Alert")], SCHEMAS["sent_history"])
    assert J.run_territory_job(spark, Star(**{**tables, "sent_history": mailed}), GATE, RUN, DELIVERY, files) == "done"
    assert output(spark, files, "EXEC", "outbox").isEmpty()


def test_late_data_is_reported_on_the_last_try_only(spark, stored, tmp_path):
    files = files_in(tmp_path)
    late = J.Gate(("schema_1",), ("view_table", "error_table"))
    assert J.run_tag_job(spark, stored, late, RUN, DELIVERY, files) == "late"
    assert sent(spark, files) == []
    last = replace(late, last_try=True)
    assert J.run_tag_job(spark, stored, last, RUN, DELIVERY, files) == "late"
    assert [s for _, s in sent(spark, files)] == ["Data Delayed -- No KPI TS Americas Alerts"]
    # a later try does not send the notice again, and may still run when the data has come
    assert J.run_tag_job(spark, stored, last, RUN, DELIVERY, files) == "late"
    assert len(sent(spark, files)) == 1 and len(attempts(files)) == 1
    assert J.run_tag_job(spark, stored, GATE, RUN, DELIVERY, files) == "done"
    assert len(attempts(files)) == 2 and len(sent(spark, files)) == 1 + output(spark, files, "TS", "outbox").count()


def test_tag_job_with_and_without_alerts(spark, stored, tmp_path):
    files = files_in(tmp_path)
    assert J.run_tag_job(spark, stored, GATE, RUN, DELIVERY, files) == "done"
    assert spark.read.json(f"{N.committed(spark, files.log, RUN.today, 'TS', DELIVERY.geo)}/documents").count() > 0
    calm = files_in(tmp_path / "calm")
    quiet = P.RunParams(today=date(2024, 2, 29))    # nothing special happened the day before
    assert J.run_tag_job(spark, stored, GATE, quiet, DELIVERY, calm) == "no_alerts"
    assert spark.read.schema("name string").json(f"{N.committed(spark, calm.log, quiet.today, 'TS', DELIVERY.geo)}/documents").count() == 0
    assert [r.kind for r in output(spark, calm, "TS", "outbox", p=quiet).collect()] == ["no_alerts"]
    assert {r.text for r in output(spark, calm, "TS", "chat", p=quiet).collect()} == {"No _technical_ alerts to send for today :grinning:"}
    assert J.run_tag_job(spark, stored, GATE, quiet, DELIVERY, calm) == "already_ran"


EMPTY = P.RunParams(today=RUN.today, client_filter="false")
UNABLE = "{name} can't run today due to issues querying the warehouse :disappointed:"


def told(spark, files, name):
    assert [s for _, s in sent(spark, files)] == [f"KPI {name} Americas Alerts Unable to Run Today"]
    chat = {(r.channel, r.text) for r in output(spark, files, name, "chat", "error").collect()}
    assert chat == {(c, UNABLE.format(name=name)) for c in DELIVERY.channels.values()}
    assert N.logged_runs(spark, files.log, RUN.today).isEmpty()


def test_failed_pull_is_told_on_the_last_try(spark, stored, tmp_path):
    files = files_in(tmp_path)
    with pytest.raises(EmptySourceError):
        J.run_account_job(spark, stored, GATE, EMPTY, DELIVERY, files)
    assert sent(spark, files) == [] and attempts(files) == []
    broken = P.RunParams(today=RUN.today, client_filter="no_such_column > 1")
    for job, p, name, error in ((J.run_account_job, EMPTY, "AS", EmptySourceError), (J.run_tag_job, broken, "TS", Exception)):
        own = files_in(tmp_path / name)
        with pytest.raises(error):
            job(spark, stored, replace(GATE, last_try=True), p, DELIVERY, own)
        told(spark, own, name)


@pytest.mark.parametrize("failure", [lambda *a: (_ for _ in ()).throw(RuntimeError("no connection")), lambda star, p: star.stats_2.sparkSession.range(0)])
def test_failed_account_pull_of_the_executive_job_is_told(spark, stored, tmp_path, monkeypatch, failure):
    """The second pull of the job: it fails, or has no rows."""
    files = files_in(tmp_path)
    monkeypatch.setattr(J.X, "account_daily", failure)
    with pytest.raises(RuntimeError):
        J.run_territory_job(spark, stored, GATE, RUN, DELIVERY, files)
    assert sent(spark, files) == [] and attempts(files) == []
    with pytest.raises(RuntimeError):
        J.run_territory_job(spark, stored, replace(GATE, last_try=True), RUN, DELIVERY, files)
    told(spark, files, "EXEC")


def test_jobs_leave_nothing_staged(spark, stored, tmp_path):
    files = files_in(tmp_path)
    folder = Path(staging_root(spark)) / "pulsewatch" / spark.sparkContext.applicationId
    assert J.run_territory_job(spark, stored, GATE, RUN, DELIVERY, files) == "done"
    with pytest.raises(EmptySourceError):
        J.run_account_job(spark, stored, GATE, EMPTY, DELIVERY, files_in(tmp_path / "b"))
    assert not list(folder.glob("run-*"))


def test_files_must_have_the_declared_columns(spark, tmp_path):
    staff = [(1, "A", "a@e", "US", "US", "x", "y", None), (2, "B", "b@e", "CA", "US", "x", "y", 1)]
    spark.createDataFrame(staff, SCHEMAS["employee"]).write.parquet(str(tmp_path / "employee"))
    read = read_table(spark, "employee", str(tmp_path / "employee"))
    assert {r.employee_id for r in read.alias("em").where("em.country IN ('US', 'CA')").collect()} == {1, 2}
    spark.range(1).withColumnRenamed("id", "employee_ident").write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="employee lacks the columns"):
        read_table(spark, "employee", str(tmp_path / "other"))


def test_territory_and_export_jobs(spark, stored, tmp_path):
    files = files_in(tmp_path)
    assert J.run_territory_job(spark, stored, GATE, RUN, DELIVERY, files) == "done"
    assert output(spark, files, "EXEC", "gainers_losers").count() == 20
    assert output(spark, files, "EXEC", "highlight").count() == 11
    written = J.run_export_job(spark, stored, RUN, str(tmp_path / "export"))
    assert [len(spark.read.option("header", True).csv(path).columns) for path in written] == [25, 25, 25]
    assert set(J.run_export_job(spark, stored, RUN, str(tmp_path / "export"))).isdisjoint(written)


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder, self.applicationId = master, folder, f"app-{master}"

    def getCheckpointDir(self):
        return self.folder


class _Session:
    def __init__(self, master, configured=None, folder=None):
        self.sparkContext = _Context(master, folder)
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}


def test_staging_folder():
    assert staging_root(_Session("spark://host:7077", "hdfs://shared/checkpoints/")) == "hdfs://shared/checkpoints"
    assert staging_root(_Session("yarn", folder="s3a://bucket/x")) == "s3a://bucket/x"
    with pytest.raises(ValueError):
        staging_root(_Session("yarn"))
    assert staging_root(_Session("local[2]")).startswith("/")
