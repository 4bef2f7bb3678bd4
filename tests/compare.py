"""Run the registered queries against DuckDB and compare values."""

from __future__ import annotations

import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(value):
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, Decimal):
        return float(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(canonical(r[i]) for i in order) for r in rows),
                                   key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


_FAMILIES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp": "TIMESTAMP"}


def type_differences(df, description):
    """Columns whose types differ between the engines."""
    want = {c[0]: str(c[1]).upper() for c in description}
    return [f"{name}: {kind} / {want.get(name)}" for name, kind in df.dtypes
            if not want.get(name, "").startswith(_FAMILIES.get(kind, kind.upper()))]


def compare(spark, con, build, sql, sf_dir):
    """(number of rows, first difference or None)."""
    df = build(spark, sf_dir)
    cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want_cols, want = rows_of(names, cur.fetchall())
    if cols != want_cols:
        return len(got), f"columns {cols} != {want_cols}"
    if len(got) != len(want):
        missing = [r for r in want if r not in set(got)][:3] if len(want) < 20000 else ""
        extra = [r for r in got if r not in set(want)][:3] if len(got) < 20000 else ""
        return len(got), f"{len(got)} rows != {len(want)}; missing {missing}; extra {extra}"
    for a, b in zip(got, want):
        if a != b:
            return len(got), f"{a} != {b}"
    types = type_differences(df, cur.description)
    return len(got), f"types {types}" if types else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tests.session import make_session

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark = make_session()
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if name not in (only or sql):
            continue
        started = time.time()
        try:
            n, diff = compare(spark, con, build, sql[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            n, diff = -1, f"{type(error).__name__}: {str(error)[:600]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name:26s} {n:7d} rows {time.time() - started:6.1f}s {diff or ''}", flush=True)
    print("failed:", bad, "without a statement:", sorted(set(entry.queries()) - set(sql)))
