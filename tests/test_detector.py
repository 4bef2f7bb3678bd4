"""The detector against a plain Python calculation, and its branches."""

import random
import statistics
from datetime import date, timedelta

import numpy as np
import pytest

from pulsewatch import params as P
from pulsewatch.operators.detector import detector_flags, detector_stats
from pulsewatch.operators.quantiles import counted_quantiles, oversized_keys, series_profile

Y = date(2024, 2, 29)


def series(name, values, last=Y):
    """Values end on ``last``."""
    n = len(values)
    return [(name, last - timedelta(days=n - 1 - i), float(v)) for i, v in enumerate(values)]


def flags(spark, rows, rule=P.KpiRule(0.975)):
    df = spark.createDataFrame(rows, "combo string, day date, v double")
    out = detector_flags(detector_stats(df, "combo", ["v"], Y), {"v": rule}, Y)
    return {r.combo: r for r in out.collect()}


USUAL = [100 + i % 7 for i in range(40)]


def test_drop_and_rise(spark):
    got = flags(spark, series("drop", USUAL + [10]) + series("rise", USUAL + [400]) + series("flat", USUAL + [101]))
    assert (got["drop"].neg, got["drop"].pos, got["drop"].is_alert) == (True, False, True)
    assert (got["rise"].neg, got["rise"].pos, got["rise"].is_alert) == (False, True, True)
    assert not got["flat"].is_alert


@pytest.mark.parametrize("direction,drop,rise", [("neg", True, False), ("POS", False, True), ("both", True, True)])
def test_directions(spark, direction, drop, rise):
    got = flags(spark, series("drop", USUAL + [10]) + series("rise", USUAL + [400]), P.KpiRule(0.975, direction))
    assert (got["drop"].is_alert, got["rise"].is_alert) == (drop, rise)


def test_no_alert_branches(spark):
    rows = series("short", [100] * 10 + [101] * 10 + [5])            # fewer than 25 rows
    rows += series("constant", [100] * 40)                            # no variance
    rows += series("late", USUAL + [10], Y - timedelta(days=1))       # last row is not yesterday
    rows += series("slid", USUAL + [12, 11.5])                        # not much lower than the day before
    rows += [r for r in series("gap", USUAL + [9, 10]) if r[1] != Y - timedelta(days=1)]   # day before missing
    rows += series("twice", USUAL + [10]) + [("twice", Y, 10.0)]      # two rows for yesterday
    got = flags(spark, rows)
    assert not any(r.is_alert for r in got.values())
    assert not got["short"].enough_rows and not got["late"].ends_yesterday and not got["constant"].is_outlier
    assert got["slid"].below_fence and not got["slid"].fell
    assert got["twice"].neg and not got["twice"].is_material


def test_rows_dated_today_silence_the_series(spark):
    got = flags(spark, series("a", USUAL + [10]) + [("a", Y + timedelta(days=1), 100.0)])
    assert got["a"].fell and not got["a"].ends_yesterday and not got["a"].is_alert


def test_small_change_is_immaterial(spark):
    values = [0.100 + (i % 5) * 1e-6 for i in range(40)] + [0.0899]
    got = flags(spark, series("a", values), P.KpiRule(0.975, "both", 1.0))
    assert got["a"].neg and not got["a"].is_alert
    assert flags(spark, series("a", values), P.KpiRule(0.975, "both", 0.0001))["a"].is_alert


def test_negative_values_keep_the_sign_of_the_guard(spark):
    # -100 the day before: 0.9 * -100 = -90, so any value up to -90 counts as a fall
    values = [-100 - i % 3 for i in range(40)]
    got = flags(spark, series("a", values + [-95]))
    assert got["a"].fell


def test_unknown_settings_are_refused():
    with pytest.raises(ValueError):
        P.KpiRule(0.975, "sideways")
    with pytest.raises(ValueError):
        P.rule_for("visits")
    assert P.rule_for("COS") == P.rule_for("cos")


def expected_alert(values, critical):
    """Independent calculation with numpy for a series that ends yesterday."""
    v = np.array(values)
    variance = v.var(ddof=1)
    if len(v) < 25 or variance == 0:
        return False
    outlier = (v[-1] - v.mean()) ** 2 / variance > critical
    q1, q3 = np.percentile(v, [25, 75])
    neg = outlier and v[-1] < q1 - 3 * (q3 - q1) and v[-1] <= v[-2] * 0.9
    pos = outlier and v[-1] > q3 + 3 * (q3 - q1) and v[-1] >= v[-2] * 1.1
    return bool((neg or pos) and abs(abs(np.median(v)) - abs(v[-1])) >= 1)


def test_against_numpy(spark):
    rng = random.Random(7)
    cases = {}
    for i in range(120):
        n = rng.randint(20, 60)
        values = [rng.gauss(1000, rng.choice([5, 50, 400])) for _ in range(n)]
        values[-1] *= rng.choice([1, 1, 0.1, 0.6, 1.6, 5])
        cases[f"s{i}"] = values
    rows = [r for name, values in cases.items() for r in series(name, values)]
    rule = P.KpiRule(0.9975)
    got = flags(spark, rows, rule)
    expected = {name: expected_alert(values, rule.critical) for name, values in cases.items()}
    assert {name: r.is_alert for name, r in got.items()} == expected
    assert 10 < sum(expected.values()) < 110


def test_result_does_not_depend_on_order_or_partitions(spark):
    rows = series("a", USUAL + [10]) + series("b", USUAL + [400])
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "combo string, day date, v double").repartition(7)
    out = detector_flags(detector_stats(df, "combo", ["v"], Y), {"v": P.KpiRule(0.975)}, Y)
    assert {r.combo: (r.neg, r.pos) for r in out.collect()} == {"a": (True, False), "b": (False, True)}


def test_counted_quantiles_equal_exact_ones(spark):
    rng = random.Random(3)
    rows = []
    for i in range(5000):
        rows.append(("ties", float(rng.randint(0, 3)), rng.random()))
        rows.append(("spread", rng.gauss(0, 1e6), float(i)))
    rows += [("one", 4.0, 1.0), ("two", 1.0, 5.0), ("two", 2.0, 5.0)]
    df = spark.createDataFrame(rows, "k string, a double, b double").repartition(6)
    probs = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r.k: r for r in counted_quantiles(df, "k", ["a", "b"], probs).collect()}
    exact = {r.k: r for r in series_profile(df, "k", [], ["a", "b"], probs).collect()}
    assert got.keys() == exact.keys()
    for k in got:
        assert got[k].a__q == exact[k].a__q and got[k].b__q == exact[k].b__q


def test_ranges_shrink_until_few_values_are_left(spark, monkeypatch):
    """A bucket with more values than the limit is cut again; ties, infinities and values that are no number keep their order."""
    from pulsewatch.operators import quantiles as Q

    monkeypatch.setattr(Q, "FEW", 4)
    monkeypatch.setattr(Q, "_CUTS", 3)
    rng = random.Random(8)
    rows = [("hot", 1e9 + rng.random() if i % 2 else float(i)) for i in range(600)] + [("hot", 5.0)] * 300
    rows += [("odd", v) for v in (float("inf"), float("-inf"), float("nan"), 0.0, 1.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0)]
    df = spark.createDataFrame(rows, "k string, a double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {r.k: r.a__q for r in counted_quantiles(df, "k", ["a"], probs).collect()}
    exact = {r.k: r.a__q for r in series_profile(df, "k", [], ["a"], probs).collect()}
    assert got.keys() == exact.keys() and all(str(got[k]) == str(exact[k]) for k in got)
    plan = counted_quantiles(df, "k", ["a"], [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_oversized_series_take_the_counting_path(spark):
    rng = random.Random(5)
    rows = [("big", Y - timedelta(days=i % 50), rng.gauss(10, 3)) for i in range(900)]
    rows += series("small", USUAL + [10])
    df = spark.createDataFrame(rows, "combo string, day date, v double")
    large = oversized_keys(df, "combo", 500)
    assert [r.combo for r in large.collect()] == ["big"]
    assert oversized_keys(df, "combo", 5000) is None
    usual = {r.combo: r.asDict() for r in detector_stats(df, "combo", ["v"], Y).collect()}
    split = {r.combo: r.asDict() for r in detector_stats(df, "combo", ["v"], Y, large).collect()}
    assert split.keys() == usual.keys()
    for combo in usual:
        for name in ("n_rows", "q1", "median", "q3", "value", "value_before", "n_yesterday"):
            assert split[combo][name] == usual[combo][name]
    big = [v for k, _, v in rows if k == "big"]
    assert split["big"]["median"] == pytest.approx(statistics.median(big))


def test_row_order_and_partitions_do_not_matter(spark):
    """Whole values, so that sums do not depend on the order of addition."""
    rng = random.Random(11)
    rows = []
    for k in range(30):
        rows += series(f"s{k}", [rng.randint(50, 150) for _ in range(rng.randint(20, 45))] + [rng.choice([1, 100, 900])])
    columns = ("score", "below_fence", "above_fence", "fell", "rose", "is_outlier", "is_material", "is_alert")
    seen = None
    for parts in (1, 3, 17):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "combo string, day date, v double").repartition(parts)
        out = detector_flags(detector_stats(df, "combo", ["v"], Y), {"v": P.KpiRule(0.975)}, Y)
        got = {r.combo: tuple(round(x, 9) if isinstance(x, float) else x for x in (r[c] for c in columns)) for r in out.collect()}
        assert seen is None or got == seen
        seen = got
    assert any(r[-1] for r in seen.values())


@pytest.mark.parametrize("confidence, quantile", [(0.5, 0.454936423119572), (0.9, 2.705543454095404), (0.95, 3.841458820694124), (0.99, 6.634896601021213), (1e-6, 1.5707963267955e-12)])
def test_any_confidence_has_its_quantile(confidence, quantile):
    assert P.KpiRule(confidence).critical == pytest.approx(quantile, rel=1e-9)


def test_listed_quantiles_stay_as_they_are():
    from statistics import NormalDist

    for confidence, value in P.CHI_SQUARE_CRITICAL.items():
        assert P.KpiRule(confidence).critical == value == pytest.approx(NormalDist().inv_cdf((1 + confidence) / 2) ** 2, rel=1e-9)
    for wrong in (0, 1, -0.5, 1.5):
        with pytest.raises(ValueError, match="between 0 and 1"):
            P.KpiRule(wrong)
