"""Cleaning, screening and calendar fill on hand-made frames."""

import random
from dataclasses import replace
from datetime import date, timedelta

import pytest

from pulsewatch import params as P
from pulsewatch.functions.cleaning import clean_data, with_kpi_ratios
from pulsewatch.operators.calendar import calendar_fill, last_entries, pad_days
from pulsewatch.operators.detector import detector_stats
from pulsewatch.operators.screening import disqualify, drop_series, eligibility, live_keys
from pulsewatch.plans import account_alerts as AS
from pulsewatch.plans.features import CAMPAIGN_ATTRIBUTES, MEASURES, SeriesFrame

D0 = date(2024, 2, 1)
Y = date(2024, 2, 29)


def day(n):
    return D0 + timedelta(days=n)


def test_clean_data_replaces_missing_and_infinite(spark):
    rows = [(None, D0, float("nan"), None), ("a", None, float("inf"), 3), ("b", D0, float("-inf"), 4), ("c", D0, 1.5, 5)]
    df = spark.createDataFrame(rows, "name string, day date, x double, n bigint")
    got = {r.name: (r.day, r.x, r.n) for r in clean_data(df).collect()}
    assert got == {"0": (D0, 0.0, 0), "a": (None, 0.0, 3), "b": (D0, 0.0, 4), "c": (D0, 1.5, 5)}


def test_ratios_of_zero_denominators_are_zero(spark):
    df = spark.createDataFrame([(5.0, 0.0, 0.0, 3.0, 2.0)], "spend double, order_value double, clicks double, displays double, conversions double")
    row = with_kpi_ratios(df).first()
    assert (row.cos, row.ctr, row.cr) == (0.0, 0.0, 0.0)


def fill_rows(spark, rows, **kwargs):
    df = spark.createDataFrame(rows, "combo string, day date, owner string, v double, extra double")
    out = calendar_fill(df, "combo", ["v"], **kwargs)
    return {(r.combo, r.day): (r.owner, r.v, r.extra) for r in out.collect()}


def test_calendar_fill_cases(spark):
    # day 2 is missing everywhere; "b" starts on day 3, "a" has a gap on day 4, "c" ends on day 3
    rows = [("a", day(i), "x", float(10 + i), 1.0) for i in (0, 1, 3, 5)]
    rows += [("b", day(i), "y", float(i), 2.0) for i in (3, 4, 5)]
    rows += [("c", day(i), "z", float(i), 3.0) for i in (0, 3)]
    got = fill_rows(spark, rows)
    assert got["a", day(2)] == ("x", 12.0, 1.0)        # median of 10, 11, 13, 15
    assert got["a", day(4)] == ("x", 0.0, 1.0)         # own gap
    assert got["b", day(2)] == ("y", 4.0, 2.0)         # missing everywhere: also before the first day
    assert ("b", day(0)) not in got and ("b", day(1)) not in got
    assert got["c", day(4)] == got["c", day(5)] == ("z", 0.0, 3.0)
    assert got["c", day(1)] == ("z", 0.0, 3.0) and got["c", day(2)] == ("z", 1.5, 3.0)
    assert len(got) == 6 + 4 + 6


def test_calendar_fill_copies_first_row_and_is_idempotent(spark):
    rows = [("a", day(0), "first", 1.0, 9.0), ("a", day(2), "later", 3.0, 8.0), ("b", day(1), "o", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "combo string, day date, owner string, v double, extra double")
    once = calendar_fill(df, "combo", ["v"])
    assert {(r.owner, r.extra) for r in once.where("combo = 'a' AND v = 0").collect()} == {("first", 9.0)}
    twice = calendar_fill(once, "combo", ["v"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_calendar_fill_keeps_duplicate_days(spark):
    rows = [("a", day(0), "x", 1.0, 1.0), ("a", day(0), "y", 2.0, 1.0), ("a", day(2), "x", 5.0, 1.0), ("b", day(1), "z", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "combo string, day date, owner string, v double, extra double")
    out = calendar_fill(df, "combo", ["v"])
    assert out.where("combo = 'a'").count() == 4


def tac_rows(combo, days, tac=1.0):
    return [(combo, Y - timedelta(days=i), tac) for i in days]


def test_disqualify_reasons(spark):
    rows = tac_rows("ok", range(30))
    rows += tac_rows("no_yesterday", range(1, 31))
    rows += tac_rows("no_tac", range(2, 30)) + tac_rows("no_tac", [0, 1], 0.004)
    rows += tac_rows("negative", range(2, 30)) + tac_rows("negative", [0], 5.0) + tac_rows("negative", [1], -6.0)
    rows += tac_rows("short", range(24))
    rows += tac_rows("edge", range(5, 29)) + tac_rows("edge", [0])
    rows += tac_rows("doubled", list(range(12)) * 2) + tac_rows("doubled", [12])   # rows count, not days
    rows += [(None, Y, 0.0)]
    df = spark.createDataFrame(rows, "combo string, day date, tac double")
    bad = disqualify(df, "combo", Y)
    got = {r.combo: (r.no_data_yesterday, r.no_recent_tac, r.not_live) for r in bad.collect()}
    assert got == {"no_yesterday": (True, False, False), "no_tac": (False, True, False), "negative": (False, True, False),
                   "short": (False, False, True), None: (False, True, True)}
    kept = {r.combo for r in drop_series(df, "combo", bad).collect()}
    assert kept == {"ok", "edge", "doubled"}


def test_eligibility_and_live_keys(spark):
    rows = [("full", Y - timedelta(days=i)) for i in range(25)] + [("old", Y - timedelta(days=i)) for i in range(1, 30)]
    df = spark.createDataFrame(rows + [("full", Y)], "combo string, day date")
    got = {(r.combo, r.metric): r.is_eligible for r in eligibility(df, "combo", ["a", "b"], Y).collect()}
    assert got == {("full", "a"): True, ("full", "b"): True, ("old", "a"): False, ("old", "b"): False}
    live = live_keys(df, "combo", Y - timedelta(days=24), Y, 25)
    assert [r.combo for r in live.collect()] == ["full"]


def test_pad_days(spark):
    df = spark.createDataFrame([("a", day(i), i) for i in range(5)] + [("b", day(i), i) for i in range(9)], "k string, day date, n int")
    names = spark.createDataFrame([("a",), ("b",), ("none",)], "k string")
    out = pad_days(df, "k", "n", day(20), 7, names)
    got = {}
    for r in out.collect():
        got.setdefault(r.k, []).append((r.day, r.n))
    assert sorted(got["a"]) [5:] == [(day(5), None), (day(6), None)]
    assert len(got["b"]) == 9
    assert sorted(got["none"]) == [(day(13 + i), None) for i in range(7)]


@pytest.mark.parametrize("n,expected", [(2, [day(2), day(3)]), (10, [day(0), day(1), day(2), day(3)])])
def test_last_entries(spark, n, expected):
    df = spark.createDataFrame([("a", day(i), i + 0.125) for i in range(4)], "k string, day date, v double")
    out = sorted((r.day, r.v) for r in last_entries(df, "k", "v", n).collect())
    assert [d for d, _ in out] == expected and out[-1][1] == 3.12


def test_series_as_one_row_equal_daily_rows(spark):
    """Screening, fill and statistics on arrays give what they give on daily rows, for all, some and no oversized series."""
    r, p = random.Random(2), P.RunParams(today=date(2024, 3, 1), required_days=6)
    rows = []
    for name in [*(f"s{k}" for k in range(14)), None, "0"]:
        first = r.randrange(0, 12)
        for back in range(1, 20):
            if back == 9 or (back == 4 and name == "s1") or r.random() < 0.15 or back > 19 - first or (back == 1 and name in ("s2", "s3")):
                continue
            for owner in range(3 if name in (None, "s4") else 1):
                measures = [None if r.random() < 0.05 else float(r.randrange(-20 if m == "rext" else 0, 200)) for m in MEASURES]
                rows.append((name, owner, True, p.days_ago(back), *measures, 0.1 * r.random()))
    columns = ["combo", "attributes_id", "is_client", "day", *MEASURES, "margin"]
    kinds = ["string", "long", "boolean", "date", *["double"] * (len(MEASURES) + 1)]
    daily = spark.createDataFrame(rows, ", ".join(f"{c} {k}" for c, k in zip(columns, kinds)))
    names = spark.createDataFrame([(c, o, *["x"] * len(CAMPAIGN_ATTRIBUTES)) for c, o in {(x[0], x[1]) for x in rows}],
                                  ", ".join(["combo string", "attributes_id long", *(f"{c} string" for c in CAMPAIGN_ATTRIBUTES)]))
    old = AS.eligible_rows(daily, p).cache()
    fill = calendar_fill(old, "combo", list(P.ACCOUNT_FILL_METRICS))
    stats = detector_stats(fill, "combo", list(P.ALERT_KPIS), p.yesterday)
    plain = lambda df, cols: sorted(str([round(v, 9) if isinstance(v, float) else v for v in x]) for x in df.select(*cols).collect())
    numbers = ["combo", "kpi", "n_rows", "last_day", "n_yesterday", "mean", "variance", "q1", "median", "q3", "value", "value_before"]
    assert 0 < old.select("combo").distinct().count() < 16
    for limit in (100_000, 30, 18, 0):
        found = AS.detect_accounts(SeriesFrame(daily, names), replace(p, oversized_rows=limit), keep_history=limit != 30)
        assert plain(found.cleaned, fill.columns) == plain(fill, fill.columns), limit
        assert plain(found.flags, numbers) == plain(stats, numbers), limit
        assert found.results.select("combo").distinct().count() == old.select("combo").distinct().count()
    old.unpersist()
