"""Registered queries against their DuckDB statements.

All run here on the smallest data; ``python -m tests.compare <data dir>`` runs them on others.
"""

import pytest

import __spark_entry__ as entry
from pulsewatch import catalog
from pulsewatch.oracle import statements
from tests.compare import compare, connect

#: Queries that may have no rows on the smallest data.
EMPTY_HERE = {"pod_alerts", "account_alerts"}
MEDIUM = "/root/testdata/sf0.01"
NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_statement():
    assert catalog.queries().keys() == statements.oracle_sql().keys()
    assert entry.queries().keys() >= catalog.queries().keys() and entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_statement(spark, con, sf_dir, name):
    rows, difference = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], sf_dir)
    assert difference is None
    assert rows > 0 or name in EMPTY_HERE


def test_entry_returns_alerts(spark):
    assert entry.entry(spark).count() > 0


def test_no_branch_is_idle():
    """At the scale of the checks every kind of outcome occurs."""
    con = connect(MEDIUM)
    from pulsewatch.oracle.ctes import statement

    def count(sql):
        return con.execute(statement(sql)).fetchall()[0][0]

    for column in ("neg", "pos", "is_override", "is_statistical"):
        assert count(f"SELECT count(*) FILTER ({column}) FROM x_as_flags") > 0, column
    assert count("SELECT count(*) FILTER (is_override AND NOT is_statistical) FROM x_as_flags") > 0
    for column in ("no_data_yesterday", "not_live"):
        assert count(f"SELECT count(*) FILTER ({column}) FROM x_disqualified") > 0, column
    assert count("SELECT count(*) FROM x_ts_alerts") > 0
    assert count("SELECT count(*) FILTER (is_alert) FROM x_territory_flags") > 0
    assert count("SELECT count(*) FILTER (percent_diff > 0) FROM x_account_alerts") > 0
    assert count("SELECT count(*) FILTER (percent_diff < 0) FROM x_account_alerts") > 0
    assert count("SELECT count(*) FROM x_export_tag WHERE site_type = 'unknown'") > 0
