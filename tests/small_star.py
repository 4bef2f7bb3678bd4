"""A warehouse of a few rows, to be varied by the tests."""

from datetime import date, datetime

from pulsewatch.sources.warehouse import SCHEMAS, Star

TODAY = date(2024, 3, 1)
Y = date(2024, 2, 29)


def employee(i, manager=1, name=None, country="10", center="US"):
    return (i, name or f"NAME {i}", f"user{i}@example.test", country, center, "FIELD", "JOB", manager)


def client(client_id, campaign_id, owner=2, currency=1, name=None, ranking="TIER 1", vertical="RETAIL",
           place=("US", "US", "NORTH AMERICA", "AMERICAS"), partner=None, campaign_name=None):
    return (client_id, name or f"client {client_id}", campaign_id, campaign_name or f"campaign {campaign_id}", owner, owner, currency,
            partner or client_id, f"partner {partner or client_id}", ranking, "WEB", "CONVERSION", 1, 1, "v", "g", vertical,
            "global", *place)


def stat(day, campaign_id, client_id=1, clicks=10.0, revenue=100.0, tac=60.0, cur=1, displays=200.0):
    return (day, campaign_id, client_id, displays, clicks, 2.0, 500.0, revenue, tac,
            None if revenue is None else revenue, None if tac is None else tac, cur)


DEFAULT = {
    "employee": [employee(1, None), employee(2)],
    "client": [client(1, 11)],
    "currency": [(1, "EUR"), (2, "USD")],
    "country": [("10", "US", "NORTH AMERICA", "AMERICAS")],
    "stats": [stat(Y, 11)],
    "stats_2": [(Y, 11, 60.0, 100.0, 1)],
    "fx_daily": [(s, t, Y, 1.0 if s == t else 2.0) for s in (1, 2) for t in (1, 2)],
    "fx_year": [],
    "events": [],
    "import_reports": [("schema_1", "stats", datetime(2024, 3, 1, 4)), ("schema_1", "rates", datetime(2024, 2, 29, 4))],
    "run_history": [],
    "sent_history": [],
}


def star(spark, **tables) -> Star:
    rows = {**DEFAULT, **tables}
    return Star(**{name: spark.createDataFrame(rows[name], schema) for name, schema in SCHEMAS.items()})
