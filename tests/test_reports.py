"""Report tables: texts, numbering, digests, documents, links and the outbox."""

import random
from dataclasses import replace
from datetime import date, datetime, timedelta
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.sql import functions as F

from pulsewatch import params as P
from pulsewatch.functions import links as L
from pulsewatch.functions import texts as X
from pulsewatch.operators.numbering import number_rows
from pulsewatch.plans import account_alerts as AS
from pulsewatch.plans import export as E
from pulsewatch.plans import gates as G
from pulsewatch.plans import reports as R
from pulsewatch.plans import tag_alerts as TS
from pulsewatch.plans import territory as EX
from pulsewatch.sources.sinks import read_csv, read_documents, write_csv, write_documents

TODAY = date(2024, 3, 1)
Y = date(2024, 2, 29)
RUN = P.RunParams(today=TODAY)
D = P.DeliveryParams(sent_at=datetime(2024, 3, 1, 9, 30), channels={"tier1": "#t1"}, alias="team@example.test", summary_cc={"tier1": "lead@example.test"})


def shown(spark, column, value, kind="double"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("t")).first().t


@pytest.mark.parametrize("column,value,text", [
    (X.number_text, 1234567.125, "1,234,567.12"), (X.number_text, -0.001, "0.00"), (lambda c: X.number_text(c, 0), 2.5, "2"),
    (X.currency_text, -1234.5, "-$1,234.50"), (lambda c: X.currency_text(c, prefix="+"), 12.0, "+$12.00"),
    (lambda c: X.currency_text(c, prefix="+", symbol="", code=F.lit("EUR")), -3.0, "-3.00 EUR"),
    (X.percent_text, 0.12345, "12.34%"), (lambda c: X.percent_text(c, plus=True), 0.5, "+50.00%"),
    (lambda c: X.percent_text(c, plus=True), 0.00001, "0.00%"), (lambda c: X.percent_text(c, plus=True), -0.5, "-50.00%"),
    (lambda c: X.bps_text(c, plus=True), 12.4, "+12 bps"), (X.bps_text, -7.6, "-8 bps"),
    (X.compact_text, 999.0, "999"), (X.compact_text, -5000.0, "-5,000"), (X.compact_text, 1500.0, "2K"),
    (X.compact_text, 2.4e6, "2M"), (X.compact_text, 3.6e9, "4B"), (X.compact_text, 0.0, "0")])
def test_number_texts(spark, column, value, text):
    assert shown(spark, column, value) == text


@pytest.mark.parametrize("column,value,text", [
    (X.title_name, "ANNA von BERG", "Anna Von Berg"), (X.user_name, "a.b@example.test", "a.b"),
    (X.capitalize_first, "homepage", "Homepage"), (X.site_name, "AA", "Android App"), (X.site_name, "0", "site_type = 0"),
    (X.site_name, "tv app", "Tv App"), (L.encoded, "a b&c:1", "a%20b%26c%3A1"),
    (L.dashboard_event, "homepage", "page"), (L.dashboard_event, "itempageview", "product"), (L.dashboard_event, "sales", "sales")])
def test_name_texts(spark, column, value, text):
    assert shown(spark, column, value, "string") == text


def test_moment_and_changes(spark):
    text = spark.range(1).select(X.moment_text(datetime(2024, 3, 1, 20, 5), "America/New_York").alias("t")).first().t
    assert text == "Fri  1 Mar 2024 03:05PM EST"
    row = spark.createDataFrame([(0.0, 5.0), (4.0, 5.0)], "b double, a double").select(
        X.percent_difference(F.col("b"), F.col("a")).alias("d"), X.bps_change(F.col("b"), F.col("a"), 100).alias("c")).collect()
    assert [(r.d, r.c) for r in row] == [(None, 500.0), (0.25, 100.0)]


def test_number_rows_spreads_a_large_group(spark):
    rng = random.Random(2)
    rows = [("hot", rng.random(), i) for i in range(3000)] + [(f"g{i % 40}", rng.random(), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, v double, i int").repartition(5)
    out = number_rows(df, ["g"], [F.col("v").desc(), F.col("i")], "no")
    got = {}
    for r in out.collect():
        got.setdefault(r.g, []).append((r.no, -r.v, r.i))
    assert sum(map(len, got.values())) == len(rows)
    for items in got.values():
        items.sort()
        assert [n for n, _, _ in items] == list(range(1, len(items) + 1))
        assert [(v, i) for _, v, i in items] == sorted((v, i) for _, v, i in items)


def test_every_run_of_letters_gets_a_capital(spark):
    for value, text in (("ANNE-MARIE o'neil", "Anne-Marie O'Neil"), ("élan 2go", "Élan 2Go"), ("", "")):
        assert shown(spark, X.every_part_capitalized, value, "string") == text


def alerts(spark, n_clients, tier="TIER 1"):
    rows = []
    for i in range(n_clients):
        for kpi in ("spend", "rext")[: 1 + i % 2]:
            rows.append((f"client {i:03d}", i, kpi, f"OWNER {i % 4}", f"o{i % 4}@example.test", "BOSS", tier, "US", "FR", "W", "E",
                         float(-i if i % 3 else i), {"rext": 1, "spend": 2}[kpi]))
    return spark.createDataFrame(
        rows, "combo string, client_id bigint, kpi string, AS_name string, AS_email string, manager_name string, ranking string, "
        "cost_center string, country string, subregion string, region string, avg_rext_euro double, kpi_rank int")


def test_account_digest_messages(spark):
    df = alerts(spark, 60).unionByName(alerts(spark, 3, "TIER 2"))
    out = sorted((r.message_no, r.text) for r in R.account_digest(df, D).collect())
    assert [n for n, _ in out] == [0, 1, 2, 3, 4]
    assert out[0][1] == "*Business alert(s)* sent to AS at Fri  1 Mar 2024 09:30AM UTC"
    lines = [text.removeprefix(">>>").split("\n") for _, text in out[1:4]]
    assert [len(block) for block in lines] == [25, 25, 10]
    assert lines[0][:2] == ["client 000   -   `SPEND`", "client 001   -   `REXT`  `SPEND`"]
    assert out[4][1].startswith("*Total accounts with business alert(s): 60*\n---")
    test = R.account_digest(df, replace(D, test_mode=True)).select("channel").distinct().collect()
    assert [r.channel for r in test] == ["@tester"]


def test_summary_leaves_out_own_managers(spark):
    df = alerts(spark, 6).unionByName(alerts(spark, 2, "TIER 2").withColumn("AS_name", F.lit("BOSS")))
    row, = R.account_summary(df).collect()
    assert (row.ranking, row.emails_sent, row.total_alerts) == ("TIER 1", 4, 9)
    assert row.body == "Emails Sent: 4\nTotal Alerts Triggered: 9\n\nRecap of triggered accounts/alerts attached."


def test_owner_clients_and_documents(spark):
    df = alerts(spark, 20)
    axis = df.select("AS_email", "combo", "kpi", F.lit("1").alias("last_label")).distinct()
    digest = R.owner_digest(df, axis)
    order = {r.combo: (r.client_no, r.color_slot) for r in digest.where("AS_email = 'o0@example.test'").collect()}
    # by margin: client 12 (12), 0 (0), then -4, -8, -16
    assert order == {"client 012": (1, 1), "client 000": (2, 2), "client 004": (3, 0), "client 008": (4, 1), "client 016": (5, 2)}
    docs = {(r.AS_email, r.client_no): r for r in R.owner_documents(digest).collect()}
    assert len(docs) == 20 and [n for e, n in sorted(docs) if e == "o1@example.test"] == [1, 2, 3, 4, 5]
    assert [a.kpi for a in docs["o1@example.test", 1].alerts] == ["rext", "spend"]


def test_charts_keep_owners_apart(spark):
    df = alerts(spark, 2).where("kpi = 'spend'")
    two = df.unionByName(df.withColumns({"AS_name": F.lit("OTHER"), "AS_email": F.lit("other@example.test")})).where("combo = 'client 000'")
    owners = [("a", "OWNER 0", "o0@example.test", 5.0), ("b", "OTHER", "other@example.test", 9000.0), ("c", "THIRD", "third@example.test", 1.0)]
    attributes = spark.createDataFrame([("client 000", i, n, e) for i, (_, n, e, _) in enumerate(owners)], "combo string, attributes_id long, AS_name string, AS_email string"
                                       ).withColumns({"currency_code": F.lit("EUR"), "manager_name": F.lit("M"), "manager_email": F.lit("m@e")})
    cleaned = spark.createDataFrame([("client 000", i, Y, v) for i, (_, _, _, v) in enumerate(owners)], "combo string, attributes_id long, day date, spend double"
                                    ).withColumns({"is_client": F.lit(True), **{k: F.lit(0.0) for k in ("rext", "cos", "cr", "ctr")}})
    axis = R.chart_axis(R.account_chart_input(cleaned, attributes, two))
    assert {(r.AS_name, r.last_label) for r in axis.collect()} == {("OWNER 0", "5.00 EUR"), ("OTHER", "9,000.00 EUR")}
    digest = R.owner_digest(two, axis.select("AS_email", "combo", "kpi", "last_label"))
    assert {(r.AS_email, r.last_label) for r in digest.collect()} == {("o0@example.test", "5.00 EUR"), ("other@example.test", "9,000.00 EUR")}


def test_pod_leaders(spark):
    df = spark.createDataFrame([
        ("a", "ANN", "ann@e", "LEA", "lea@e"), ("b", "LEA", "lea@e", "TOP", "top@e"), ("c", "BOB", "bob@e", "TOP", "top@e"),
        ("d", "LEA", "lea@e", "LEA", "lea@e")], "combo string, AS_name string, AS_email string, manager_name string, manager_email string")
    got = sorted((r.combo, r.AS_name, r.AS_email) for r in AS.with_pod_leaders(df, ("Lea",)).collect())
    assert got == [("a", "ANN", "ann@e"), ("a", "LEA", "lea@e"), ("b", "LEA", "lea@e"), ("c", "BOB", "bob@e"), ("d", "LEA", "lea@e")]


def test_chart_axis(spark):
    rows = [("a", "EUR", "spend", Y - timedelta(days=i), 1000.0 + i) for i in range(29)]
    rows += [("a", "EUR", "rext", Y - timedelta(days=i), -50.0 + i) for i in range(3)]
    rows += [("a", "EUR", "cos", Y, 0.234), ("b", "EUR", "cos", Y, 0.7), ("t", "", "events", Y, 12345.0)]
    df = spark.createDataFrame(rows, "combo string, currency_code string, kpi string, day date, value double")
    got = {(r.combo, r.kpi): r for r in R.chart_axis(df).collect()}
    spend = got["a", "spend"]
    assert (spend.step, spend.y_max, spend.y_min, spend.last_label) == (100.0, 1100.0, 0.0, "1,000.00 EUR")
    assert (spend.y_max_label, spend.y_min_label, spend.n_ticks, spend.first_tick) == ("1K EUR", "0 EUR", 3, Y - timedelta(days=28))
    rext = got["a", "rext"]
    assert (rext.step, rext.y_max, rext.y_min) == (5.0, 0.0, -55.0)
    assert got["a", "cos"].y_max == pytest.approx(0.25) and got["a", "cos"].last_label == "23.40%"
    assert got["b", "cos"].y_max == pytest.approx(0.8) and got["b", "cos"].y_max_label == "80 %"
    events = got["t", "events"]
    assert (events.step, events.y_max, events.y_min, events.last_label) == (1000.0, 13000.0, 0.0, "12,345")


def test_links(spark):
    df = alerts(spark, 2).withColumn("combo", F.concat("combo", F.lit(" & co")))
    row = R.account_links(df, RUN, D).where("kpi = 'rext'").first()
    query = parse_qs(urlsplit(row.true_link).query)
    assert query["series"] == ["client 001 & co"] and query["kpi"] == ["client_rext"] and query["is_alert"] == ["true"]
    assert query["username"] == ["o1"] and query["run_date"] == ["2024-03-01"]
    explore = parse_qs(urlsplit(row.explore_link).query)
    assert (explore["start_date"], explore["end_date"], explore["kpi"]) == (["2024-02-14"], ["2024-02-29"], ["rext"])


def tag_alert_rows(spark):
    rows = [("TS 1", "p2", 2, "d", "basket"), ("TS 1", "p1", 1, "m", "sales"), ("TS 1", "p1", 1, "d", "sales"),
            ("TS 1", "p1", 1, "d", "basket"), ("TS 2", "p3", 3, "d", "homepage")]
    df = spark.createDataFrame(rows, "TS_name string, partner_name string, partner_id bigint, site_type string, event_name string")
    fixed = {"ts_engineer_email": "t@e", "manager_name": "M", "manager_email": "m@e", "ts_cost_center": "US", "ts_country": "US",
             "ts_subregion": "NA", "ts_region": "AM"}
    df = df.withColumns({k: F.lit(v) for k, v in fixed.items()}).withColumns({
        "ranking": F.when(F.col("partner_id") == 2, "TIER 2").otherwise("TIER 1"), "run_date": F.lit(TODAY)})
    return df.withColumn("combo", F.concat_ws(" ", "partner_name", "event_name", "site_type"))


def test_tag_documents_round_trip(spark, tmp_path):
    df = tag_alert_rows(spark)
    docs = TS.owner_documents(df)
    by = {(r.name, r.partner_name): r for r in docs.collect()}
    assert sorted(by) == [("TS 1", "p1"), ("TS 1", "p2"), ("TS 2", "p3")] and by["TS 1", "p2"].ranking == "TIER 2"
    assert [(a.site, [e.event_name for e in a.event]) for a in by["TS 1", "p1"].alerts] == [("d", ["basket", "sales"]), ("m", ["sales"])]
    path = write_documents(docs, str(tmp_path / "docs"))
    flat = TS.flatten_documents(read_documents(spark, path, docs.schema))
    assert {(r.partner_name, r.site, r.event_name) for r in flat.collect()} == {
        (r.partner_name, r.site_type, r.event_name) for r in df.collect()}
    assert flat.where("graph = '1_m_sales.png'").count() == 1
    empty = write_documents(TS.owner_documents(df.limit(0)), str(tmp_path / "none"))
    assert read_documents(spark, empty, docs.schema).count() == 0


def test_a_large_owner_keeps_whole_partners(spark):
    one = tag_alert_rows(spark).where("partner_name = 'p2'")
    many = one.drop("partner_id", "event_name").join(spark.range(20_000).select(
        (F.col("id") % 1000).alias("partner_id"), F.concat(F.lit("e"), (F.col("id") / 1000).cast("int").cast("string")).alias("event_name")))
    docs = TS.owner_documents(many)
    assert docs.count() == 1000 and docs.where(F.size(F.col("alerts")[0]["event"]) == 20).count() == 1000


def test_documents_without_site_are_skipped(spark):
    docs = TS.owner_documents(tag_alert_rows(spark))
    no_site = docs.withColumn("alerts", F.transform("alerts", lambda a: a.withField("site", F.lit(None).cast("string"))))
    assert TS.flatten_documents(no_site).count() == 0


def test_tag_digest(spark):
    out = sorted((r.message_no, r.text) for r in R.tag_digest(tag_alert_rows(spark), D).collect())
    assert out[1][1] == (">>>p1   -   `Basket on D`  `Sales on D`  `Sales on M`\np2   -   `Basket on D`\np3   -   `Homepage on D`")
    assert out[2][1].startswith("*Total accounts with technical alert(s): 3*")


def test_alert_texts_and_review(spark):
    flags = spark.createDataFrame(
        [("a", "spend", True, False, True), ("a", "rext", True, True, True), ("b", "rext", False, True, True),
         ("c", "cos", False, False, False)], "combo string, kpi string, is_statistical boolean, is_override boolean, is_alert boolean")
    texts = {r.combo: r.alerts for r in AS.alert_texts(flags).collect()}
    assert texts == {"a": "REXT, SPEND", "b": "Negative RexT"}
    long = spark.createDataFrame([("a", "spend", Y, 1.0), ("a", "site_events", Y, 2.0), ("b", "rext", Y, 3.0)],
                                 "combo string, kpi string, day date, value double")
    given = spark.createDataFrame([("a", "Negative RexT, Drop in Site Events, SPEND"), ("b", "Negative RexT")], "combo string, alerts string")
    got = sorted((r.combo, r.alert, r.value) for r in AS.alert_review_series(given, long).collect())
    assert got == [("a", "Drop in Site Events", 2.0), ("a", "SPEND", 1.0)]


def test_gainers_and_losers(spark):
    rows = [(f"c{i}", "LATAM", 100.0, 100.0 + 10 * i, 10.0 * i, 0.1 * i) for i in range(1, 8)] + [("zero", "LATAM", 5.0, 5.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "client_name string, region string, expected double, actual double, magnitude double, percent_diff double")
    daily = df.select("client_name")
    got = {(r.region, r.side, r.position): r for r in EX.gainers_losers(df, daily).collect()}
    assert len(got) == 20
    assert [got["LATAM", "gainers", i].client for i in range(1, 6)] == ["c7", "c6", "c5", "c4", "c3"]
    assert got["LATAM", "gainers", 1].deviation == "+$70.00" and got["LATAM", "gainers", 1].percent_diff == "+70.00%"
    assert (got["LATAM", "losers", 1].client, got["LATAM", "losers", 1].deviation) == ("zero", "-$0.00")
    assert got["LATAM", "losers", 2].client == "" and got["NORTH AMERICA", "gainers", 1].client == ""
    late = {r.client for r in EX.gainers_losers(df.limit(0), daily.limit(0)).collect()}
    assert late == {"DATA IS LATE"}


def test_territory_texts(spark):
    results = spark.createDataFrame([("US", True), ("SAM OTHER", True), ("LATAM", False)], "series string, is_alert boolean")
    text = EX.alert_text(results)
    assert text.first().alerts == "SAM OTHER, US"
    assert EX.alert_text(results.where("false")).first().alerts == "NONE"
    lit = {r.region for r in EX.territory_highlight(text).where("is_highlighted").collect()}
    assert lit == {"us", "sam"}


def test_export_filter_and_csv(spark, tmp_path):
    rows = [("a", "x", Y - timedelta(days=i), TODAY, float(i)) for i in range(3)]
    rows += [("b", "x", Y - timedelta(days=i), TODAY, 1.0) for i in (0, 2)]           # too few points
    rows += [("c", "x", Y - timedelta(days=i), TODAY, 1.0) for i in range(1, 6)]      # nothing yesterday
    df = spark.createDataFrame(rows, "series string, kpi string, day date, run_date date, value double")
    assert {r.series for r in E.export_filter(df).collect()} == {"a"}
    assert {r.series for r in E.export_filter(df, 2).collect()} == {"a", "b"}
    full = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in E.EXPORT_SCHEMA.fields])
    full = full.withColumn("client_name", F.lit('Ü "quoted", comma'))
    path = write_csv(full, str(tmp_path / "csv"))
    assert sorted(map(str, read_csv(spark, path, E.EXPORT_SCHEMA).collect())) == sorted(map(str, full.collect()))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_csv(full, path)


def test_outbox_sends_each_mail_once(spark):
    box = G.owner_notices(alerts(spark, 8), D, RUN)
    box = box.unionByName(box).unionByName(G.summary_notices(R.account_summary(alerts(spark, 8)), D, RUN))
    sent = spark.createDataFrame([(TODAY, "o1@example.test", "KPI AS Alert for Owner 1"), (Y, "o2@example.test", "KPI AS Alert for Owner 2")],
                                 "run_date date, to string, subject string")
    got = {(r.kind, r["to"]): r for r in G.unsent(box, sent).collect()}
    assert set(got) == {("alert", f"o{i}@example.test") for i in (0, 2, 3)} | {("summary", "maintainers@example.test")}
    assert got["summary", "maintainers@example.test"].cc == "lead@example.test"
    test = {(r["to"], r.cc, r.subject) for r in G.unsent(G.owner_notices(alerts(spark, 1), replace(D, test_mode=True), RUN), sent).collect()}
    assert test == {("tester@example.test", None, "[TEST] KPI AS Alert for Owner 0")}


@pytest.mark.parametrize("kind,changes,to,subject", [
    ("late", {}, "team@example.test", "Data Delayed -- No KPI TS Americas Alerts"),
    ("late", {"beta_active": True, "beta_testers": "b@e"}, "b@e", "Data Delayed -- No KPI TS Americas Alerts"),
    ("error", {"alias": None, "recipients": "r@e"}, "r@e", "KPI TS Americas Alerts Unable to Run Today"),
    ("no_alerts", {}, "maintainers@example.test", "No Alerts to Send for KPI TS Americas"),
    ("late", {"test_mode": True}, "tester@example.test", "[TEST] Data Delayed -- No KPI TS Americas Alerts")])
def test_trouble_notices(spark, kind, changes, to, subject):
    row = G.trouble_notice(spark, "ts", kind, replace(D, **changes), RUN).first()
    assert (row["to"], row.subject) == (to, subject)
    assert row.product == "TS"


def test_unknown_product_is_refused(spark):
    with pytest.raises(ValueError):
        G.trouble_notice(spark, "web", "late", D, RUN)
    told = G.chat_notices(spark, "AS", "late", replace(D, test_mode=False, channels={"a": "#x", "b": "#y", "c": "#x"})).collect()
    assert [r.channel for r in told] == ["#x", "#y"] and all(r.text.startswith("_business_ alerts can't be sent") for r in told)


def test_notices_of_many_jobs_at_a_time(spark):
    jobs = spark.createDataFrame([("AS", "late", "north"), ("TS", "error", "south"), ("EXEC", "no_alerts", "west")], "product string, kind string, geo string")
    rows = {r.geo: r for r in G.trouble_notices(jobs, replace(D, test_mode=False, alias="r@e"), RUN).collect()}
    assert rows["north"].subject == f"Data Delayed -- No {D.product_label} AS north Alerts" and rows["north"].to == "r@e"
    assert rows["south"].chat == "TS can't run today due to issues querying the warehouse :disappointed:"
    assert rows["west"].body == "There are no alerts for today." and rows["west"].to == D.maintainers and rows["west"].bcc is None


def test_freshness(spark):
    reports = spark.createDataFrame([("s1", "a", datetime(2024, 3, 1)), ("s1", "b", datetime(2024, 2, 29, 23)), ("s9", "c", datetime(2024, 3, 1, 5))],
                                    "table_schema string, table_name string, update_time timestamp")
    required = spark.createDataFrame([("a",), ("b",), ("c",)], "table_name string")
    checked = G.freshness(required, G.loaded_today(reports, TODAY, ["s1"], ["a", "b", "c"]))
    assert {r.table_name: r.is_late for r in checked.collect()} == {"a": False, "b": True, "c": True}
    assert G.data_late(checked) and not G.data_late(checked.where("table_name = 'a'"))



def test_csv_keeps_texts(spark, tmp_path):
    rows = [(" lead", 'a\nb', 'q"x', 1), ("", None, 'back\\slash, "', 2), (None, " tail ", "ü\r\nz", None)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d int")
    back = read_csv(spark, write_csv(df, str(tmp_path / "texts")), df.schema)
    want = [tuple(x or None for x in r) for r in rows]  # an empty text comes back as null
    assert sorted(map(tuple, back.collect()), key=str) == sorted(want, key=str)


def test_export_filter_drops_by_hash_or_by_join(spark):
    """few dropped series go to the tasks as hashes, many are joined; rows without a name go in both ways."""
    days = [date(2024, 2, 26 + i) for i in range(4)]
    rows = [(s, k, d, date(2024, 3, 1)) for s in ("a", "b", None) for k in ("x", "y") for d in days if (s, k) != ("b", "y") or d < days[3]]
    df = spark.createDataFrame(rows, "series string, kpi string, day date, run_date date")
    want = sorted((s, k, d) for s, k, d, _ in rows if s and (s, k) != ("b", "y"))
    for limit in (0, 10):
        assert sorted((r.series, r.kpi, r.day) for r in E.export_filter(df, limit=limit).collect()) == want
    plan = E.export_filter(df.where("series = 'a'"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_compressed_csv_reads_back(spark, tmp_path):
    df = spark.createDataFrame([(" \"a, b\"\n", 1)], "text string, n int")
    path = write_csv(df, str(tmp_path / "zip"), compression="gzip")
    assert all(f.name.endswith(".csv.gz") for f in (tmp_path / "zip").glob("part-*"))
    assert read_csv(spark, path, df.schema).collect() == df.collect()
