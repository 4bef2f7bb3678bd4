"""Daily sums kept from run to run."""

from datetime import timedelta

import pytest

from pulsewatch import params as P
from pulsewatch.plans import daily_store as D
from pulsewatch.plans import features as X
from pulsewatch.sources.warehouse import SCHEMAS, Star
from tests.small_star import TODAY, star, stat

RUN = P.RunParams(today=TODAY, account_window_days=10)


def day(back):
    return TODAY - timedelta(days=back)


def values(df):
    return sorted(str(r) for r in df.select(*sorted(df.columns)).collect())


class Table:
    """A fact table in files, one folder per day."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path)

    def put(self, facts):
        self.spark.createDataFrame(facts, SCHEMAS["stats"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(self.path)

    def read(self):
        return self.spark.read.schema(SCHEMAS["stats"]).parquet(self.path)


@pytest.fixture
def summed(monkeypatch):
    """The days that are summed, run by run."""
    seen, real = [], X.fact_sums

    def spy(facts):
        seen.append(sorted(r.day for r in facts.select("day").distinct().collect()))
        return real(facts)

    monkeypatch.setattr(X, "fact_sums", spy)
    return seen


def daily(spark, table, p):
    own = star(spark, fx_daily=[(1, 1, day(b), 1.0) for b in range(15)])
    return X.campaign_daily(Star(**{**{n: getattr(own, n) for n in SCHEMAS}, "stats": table}), p)


def test_a_later_run_reads_new_and_changed_days_only(spark, tmp_path, summed):
    table = Table(spark, tmp_path / "stats")
    table.put([stat(day(b), 11, clicks=float(b)) for b in range(2, 14)] + [stat(day(3), 11, clicks=3.0)])
    p = P.RunParams(today=day(1), account_window_days=10, daily_store=str(tmp_path / "kept"))
    assert values(daily(spark, table.read(), p)) == values(daily(spark, table.read(), P.RunParams(today=day(1), account_window_days=10)))
    assert summed[0] == [day(b) for b in range(11, 1, -1)]
    table.put([stat(day(1), 11, clicks=100.0)])
    table.put([stat(day(5), 11, clicks=50.0), stat(day(5), 11, clicks=51.0), stat(day(5), 11, clicks=51.0)])
    del summed[:]
    p = P.RunParams(today=TODAY, account_window_days=10, daily_store=p.daily_store)
    got = values(daily(spark, table.read(), p))
    assert summed == [[day(5), day(1)]]
    assert got == values(daily(spark, table.read(), RUN))
    del summed[:]
    assert values(daily(spark, table.read(), p)) == got and summed == [[]]


def test_a_run_that_breaks_before_the_marks_is_made_up_for(spark, tmp_path, monkeypatch, summed):
    table = Table(spark, tmp_path / "stats")
    table.put([stat(day(b), 11, clicks=float(b)) for b in range(1, 5)])
    p = P.RunParams(today=TODAY, account_window_days=10, daily_store=str(tmp_path / "kept"))
    daily(spark, table.read(), p)
    table.put([stat(day(2), 11, clicks=20.0)])
    marks = D.MARKS
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(D, "MARKS", "no such schema")      # breaks after the sums of an earlier run are there
        with pytest.raises(Exception):
            daily(spark, table.read(), p)
    assert D.MARKS == marks
    assert values(daily(spark, table.read(), p)) == values(daily(spark, table.read(), RUN))


def test_days_without_facts_any_more_and_facts_that_are_no_files(spark, tmp_path, summed):
    p = P.RunParams(today=TODAY, account_window_days=10, daily_store=str(tmp_path / "kept"))
    rows = [stat(day(b), 11, clicks=float(b)) for b in range(1, 5)]
    frame = spark.createDataFrame(rows, SCHEMAS["stats"])
    assert values(daily(spark, frame, p)) == values(daily(spark, frame, RUN))
    fewer = spark.createDataFrame([*rows[1:2], stat(day(2), 12), *rows[2:]], SCHEMAS["stats"])
    del summed[:]
    assert values(daily(spark, fewer, p)) == values(daily(spark, fewer, RUN))
    assert summed[0] == [day(2)]
    none = frame.limit(0)
    assert daily(spark, none, p).isEmpty()


def test_events_are_kept_too(spark, tmp_path):
    rows = [(1, day(b), "d", name, 5 * b) for b in range(1, 6) for name in ("page", "homepage", "sales")]
    own = star(spark, events=rows, stats_2=[(day(b), 11, 60.0, 100.0, 1) for b in range(1, 29)])
    p = P.RunParams(today=TODAY, required_days=20)
    kept = P.RunParams(today=TODAY, required_days=20, daily_store=str(tmp_path / "kept"))
    want = values(X.tag_daily(own, p))
    assert want and values(X.tag_daily(own, kept)) == want and values(X.tag_daily(own, kept)) == want
