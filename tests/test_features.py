"""Daily features on a small warehouse: duplicates, missing values, prices, scope."""

from dataclasses import replace
from datetime import date, timedelta

import pytest

from pulsewatch import params as P
from pulsewatch.plans import account_alerts as AS
from pulsewatch.plans import features as X
from pulsewatch.plans import territory as EX
from pulsewatch.sources.warehouse import SCHEMAS, EmptySourceError, Star
from tests.small_star import TODAY, Y, client, employee, star, stat

RUN = P.RunParams(today=TODAY)


def test_repeated_facts_count_once_and_missing_rates_drop(spark):
    facts = [stat(Y, 11), stat(Y, 11), stat(Y, 11, clicks=5.0), stat(Y, 11, clicks=7.0, cur=9)]
    row, = X.campaign_daily(star(spark, stats=facts), RUN).collect()
    assert (row.clicks, row.spend, row.tac, row.rext) == (15.0, 200.0, 120.0, 80.0)


def test_missing_amounts(spark):
    # a row without media cost has no margin, but its revenue is spend
    facts = [stat(Y, 11, revenue=100.0, tac=None), stat(Y, 11, revenue=None, tac=30.0), stat(Y, 11, revenue=50.0, tac=20.0)]
    row, = X.campaign_daily(star(spark, stats=facts), RUN).collect()
    assert (row.spend, row.tac, row.rext, row.rext_euro) == (150.0, 50.0, 30.0, 30.0)
    row, = X.campaign_daily(star(spark, stats=[stat(Y, 11, tac=None)]), RUN).collect()
    assert (row.tac, row.rext) == (0.0, 0.0)


def test_media_is_priced_in_client_currency(spark):
    facts = [stat(Y, 11, cur=2), stat(Y, 11, cur=1)]
    row, = X.campaign_daily(star(spark, stats=facts), RUN).collect()
    assert (row.tac, row.rext) == (180.0, 20.0)


def test_two_rates_for_one_key_count_twice(spark):
    row, = X.campaign_daily(star(spark, fx_daily=[(1, 1, Y, 1.0), (1, 1, Y, 1.5)]), RUN).collect()
    assert (row.clicks, row.tac) == (20.0, 150.0)


def test_owner_needs_a_manager_and_every_owner_gets_the_rows(spark):
    staff = [employee(1, None), employee(2), employee(3), employee(4, 77)]
    clients = [client(1, 11, owner=2), client(1, 11, owner=3), client(1, 11, owner=4)]
    rows = X.campaign_daily(star(spark, employee=staff, client=clients), RUN).collect()
    assert {(r.AS_email, r.manager_email, r.clicks) for r in rows} == {
        ("user2@example.test", "user1@example.test", 10.0), ("user3@example.test", "user1@example.test", 10.0)}


def test_currencies_sharing_a_code_merge(spark):
    clients = [client(1, 11, currency=1), client(1, 11, currency=3)]
    rates = [(1, 1, Y, 1.0), (1, 3, Y, 1.0)]
    s = star(spark, client=clients, currency=[(1, "EUR"), (3, "EUR")], fx_daily=rates)
    row, = X.campaign_daily(s, RUN).collect()
    assert row.clicks == 20.0
    assert {r.clicks for r in X.account_series(s, RUN).daily.collect()} == {20.0}


def test_window_and_filters(spark):
    first = TODAY - timedelta(days=60)
    days = [first - timedelta(days=1), first, Y, TODAY]
    rates = [(1, 1, d, 1.0) for d in days]
    s = star(spark, stats=[stat(d, 11) for d in days], fx_daily=rates)
    assert {r.day for r in X.campaign_daily(s, RUN).collect()} == set(days[1:])
    other = replace(RUN, employee_filter="em.cost_center_country = 'LM'")
    assert X.campaign_daily(s, other).isEmpty()
    assert X.campaign_daily(s, replace(RUN, client_filter="ranking IN ('TIER 2')")).isEmpty()


def test_client_rows_and_campaign_rows(spark):
    clients = [client(1, 11), client(1, 12), client(2, 21, name=None)]
    facts = [stat(Y, 11), stat(Y, 12, clicks=4.0), stat(Y, 21, client_id=2)]
    rows = X.account_series(star(spark, client=clients, stats=facts), RUN).wide().collect()
    got = {(r.combo, r.campaign_name, r.campaign_id, r.campaign_revenue_type): r.clicks for r in rows}
    assert got == {
        ("client 1", "NOT A CAMPAIGN", -1, -11): 14.0, ("client 2", "NOT A CAMPAIGN", -1, -11): 10.0,
        ("client 1: campaign 11", "campaign 11", 11, 1): 10.0, ("client 1: campaign 12", "campaign 12", 12, 1): 4.0,
        ("client 2: campaign 21", "campaign 21", 21, 1): 10.0}
    assert {r.margin for r in rows} == {0.4}


def test_scope_broadcast_and_join_give_the_same(spark, sf_dir):
    from pulsewatch.sources.sample import sample_star

    s = sample_star(spark, sf_dir)
    narrow = replace(RUN, client_filter="ranking = 'TIER 1'", required_days=20)
    unlimited = replace(narrow, broadcast_keys=0)
    for build in (X.campaign_daily, X.tag_daily, X.territory_daily, X.account_daily, X.live_partners):
        usual, joined = build(s, narrow), build(s, unlimited)
        assert sorted(map(str, usual.collect())) == sorted(map(str, joined.collect())), build.__name__


def test_beta_keeps_only_listed_owners(spark):
    staff = [employee(1, None), employee(2), employee(3)]
    clients = [client(1, 11, owner=2), client(2, 21, owner=3)]
    s = star(spark, employee=staff, client=clients, stats=[stat(Y, 11), stat(Y, 21, client_id=2)])
    rows = AS.account_rows(s, replace(RUN, beta_emails=("user3@example.test",))).wide("AS_email").collect()
    assert {r.AS_email for r in rows} == {"user3@example.test"} and len(rows) == 2


def test_empty_result_is_an_error(spark):
    with pytest.raises(EmptySourceError):
        AS.account_rows(star(spark, stats=[stat(Y, 99)]), RUN)
    with pytest.raises(ValueError):
        Star(employee=None)


def test_constant_dollar_margin_prefers_yearly_rates(spark):
    clients = [client(1, 11, currency=1), client(2, 21, currency=3, place=("PERU", "SOUTH AMERICA", "LATAM", "AMERICAS")),
               client(3, 31, vertical="FILLER"), client(4, 41, vertical=None), client(5, 51, ranking="TIER 2")]
    facts = [(Y, c, 60.0, 100.0, 1) for c in (11, 21, 31, 41, 51)] + [(Y, 11, 60.0, 100.0, 1)]
    daily = [(1, 1, Y, 5.0), (1, 2, Y, 5.0), (3, 2, Y, 3.0), (1, 3, Y, 0.5)]
    yearly = [(1, 2, 2024, 0, 2.0), (1, 1, 2024, 0, 1.0), (1, 2, 2024, 1, 9.0)]
    s = star(spark, client=clients, stats_2=facts, fx_daily=daily, fx_year=yearly)
    got = {(r.region, r.country): r.RexT_USD_Constant for r in X.territory_daily(s, RUN).collect()}
    # client 1: 100 * 2 - 60 * 1 * 2; client 2: daily only, 100 * 3 - 60 * 0.5 * 3
    assert got == {("NORTH AMERICA", "US"): 80.0, ("LATAM", "SAM OTHER"): 210.0}


def test_margin_without_any_rate(spark):
    s = star(spark, client=[client(1, 11, currency=7)], fx_daily=[], fx_year=[(1, 7, 2024, 0, 2.0)])
    row, = X.territory_daily(s, RUN).collect()
    assert row.RexT_USD_Constant == -120.0     # no revenue rate: 0 - 60 * 2 * 1


def test_equal_territory_names_merge_without_path(spark):
    daily = spark.createDataFrame(
        [(Y, "A", "N", "X", 1.0), (Y, "A", "M", "X", 2.0), (Y, "A", "M", None, 4.0)],
        "day date, area string, region string, country string, RexT_USD_Constant double")
    merged = sorted((r.series, r.RexT) for r in EX.territory_series(daily).collect())
    assert merged == [("0", 4.0), ("A", 7.0), ("M", 6.0), ("N", 1.0), ("X", 3.0)]
    paths = {(r.series, r.subregion): r.RexT for r in EX.territory_paths(daily).collect()}
    assert paths["X", "N"] == 1.0 and paths["X", "M"] == 2.0 and paths["A", "N/A"] == 7.0


def test_live_partner_rules(spark):
    days = [Y - timedelta(days=i) for i in range(30)]
    clients = [client(1, 11), client(2, 21), client(3, 31)]
    facts = [(d, 11, 5.0, 9.0, 1) for d in days[:25]]
    facts += [(d, 21, 5.0, 9.0, 1) for d in days[:24]]                      # a day short
    facts += [(d, 31, 5.0 if d < days[1] else 0.0, 9.0, 1) for d in days]   # nothing spent lately
    events = [(p, Y, "d", n, 3) for p in (1, 2, 3) for n in ("page", "homepage", "basket")]
    s = star(spark, client=clients, stats_2=facts, events=events)
    got = {(r.partner_name, r.event_name): r.events for r in X.tag_daily(s, RUN).collect()}
    assert got == {("partner 1", "homepage"): 6, ("partner 1", "basket"): 3}


def test_tag_series_after_cleaning(spark):
    days = [Y - timedelta(days=i) for i in range(30)]
    events = [(1, Y, None, "basket", 3), (1, Y, "0", "basket", 4), (1, Y, "d", None, None)]
    staff = [employee(1, None), employee(2, center="LM")]
    s = star(spark, employee=staff, stats_2=[(d, 11, 5.0, 9.0, 1) for d in days], events=events)
    series = X.tag_series(s, RUN)
    got = sorted((r.combo, r.events) for r in series.daily.collect())
    assert got == [("partner 1 0 on d managed by NAME 2", 0),
                   ("partner 1 SITE LEVEL on SITE LEVEL managed by NAME 2", 7),
                   ("partner 1 basket on 0 managed by NAME 2", 3), ("partner 1 basket on 0 managed by NAME 2", 4)]
    assert {r.ts_subregion for r in series.attributes.collect()} == {"LATAM"}


def test_empty_names_are_one_series(spark):
    clients = [client(i, 10 * i + 1, name=None) for i in (1, 2)]
    clients = [(c[0], None, *c[2:]) for c in clients]
    facts = [stat(date(2024, 2, 1) + timedelta(days=n), 10 * i + 1, client_id=i) for i in (1, 2) for n in range(29)]
    rates = [(1, 1, date(2024, 2, 1) + timedelta(days=n), 1.0) for n in range(29)]
    found = AS.detect_accounts(AS.account_rows(star(spark, client=clients, stats=facts, fx_daily=rates), RUN), RUN)
    got = {(r.combo, r.client_id) for r in found.results.collect() if r.campaign_name == "NOT A CAMPAIGN"}
    assert got == {("0", 1), ("0", 2)}
    low = replace(RUN, oversized_rows=10)
    again = AS.detect_accounts(AS.account_rows(star(spark, client=clients, stats=facts, fx_daily=rates), low), low)
    assert sorted(map(str, found.results.collect())) == sorted(map(str, again.results.collect()))
    assert sorted(map(str, found.cleaned.collect())) == sorted(map(str, again.cleaned.collect()))


def test_nulls_in_neighbouring_attributes_stay_apart(spark):
    first, second = client(1, 11), client(1, 12)
    at = [f.name for f in SCHEMAS["client"].fields]
    def with_verticals(row, rtc, vertical):
        row = list(row)
        row[at.index("vertical_level_2_name")], row[at.index("vertical_name")] = rtc, vertical
        return tuple(row)
    small = star(spark, client=[with_verticals(first, "x", None), with_verticals(second, None, "x")],
                 stats=[stat(Y, 11), stat(Y, 12)])
    rows = X.account_series(small, RUN).wide().where("campaign_id = -1").collect()
    assert sorted((r.RTC_vertical or "", r.vertical_name or "", r.spend) for r in rows) == [("", "x", 100.0), ("x", "", 100.0)]


def test_a_key_stands_once_among_the_attributes(spark, sf_dir):
    from pulsewatch.sources.sample import sample_star
    attributes = X.account_series(sample_star(spark, sf_dir), RUN).attributes
    assert attributes.groupBy("combo", "attributes_id").count().where("count > 1").isEmpty()


@pytest.mark.parametrize("limit", [1000, 1, 0])
def test_rows_without_repeats_equal_distinct(spark, limit):
    """Also with nulls, zeros of both signs and NaN; more repeated hashes than may be sent fall back on all rows."""
    rows = [(k % 50, None if k % 7 == 0 else float(k % 3), "x") for k in range(200)] + [(1000 + k, float(k), None) for k in range(30)]
    rows += [(2000, 0.0, "z"), (2000, -0.0, "z"), (2001, float("nan"), None), (2001, float("nan"), None), (None, 1.0, "y"), (None, 1.0, "y")]
    df = spark.createDataFrame(rows, "a long, b double, c string")
    assert sorted(map(str, X.without_repeats(df, limit).collect())) == sorted(map(str, df.distinct().collect()))
    once = df.where("a >= 1000 AND a < 2000")
    assert X.without_repeats(once, limit).count() == 30 and X.without_repeats(df.limit(0), limit).isEmpty()


def test_facts_once_in_the_table_are_not_shuffled(spark):
    """Rows without a twin reach the sums without an exchange of their own."""
    facts = spark.range(1000).selectExpr("id AS campaign_id", "id * 1.0D AS clicks")
    twice = facts.unionByName(facts.where("campaign_id < 5"))
    plan = X.without_repeats(twice, 100)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__hash" not in plan and plan.count("hashpartitioning(campaign_id") == 1 and "BroadcastHashJoin" in plan
