"""Sources: damaged records, predicates and type checks of a JDBC read. No database is needed."""

from datetime import date, timedelta
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import types as T

from pulsewatch.sources import sinks as K
from pulsewatch.sources import warehouse as W

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("day", T.DateType()), T.StructField("amount", T.DoubleType())])


def test_damaged_csv_lines_are_listed(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,day,amount\n1,"a ""b"", c",2024-03-01,1.5\nx,bad id,2024-03-01,2\n3,,2024-13-01,2\n4,few\n5,"two\nlines",,\n')
    good, bad = K.read_checked(spark, str(tmp_path / "a.csv"), "csv", ROW, 0.6)
    assert sorted((r.id, r.name) for r in good.collect()) == [(1, 'a "b", c'), (5, "two\nlines")]
    assert sorted(r.record for r in bad.collect()) == ["3,,2024-13-01,2", "4,few", "x,bad id,2024-03-01,2"]
    with pytest.raises(K.BadRecordsError, match="3 of 5 records"):
        K.read_checked(spark, str(tmp_path / "a.csv"), "csv", ROW, 0.5)


def test_damaged_json_lines_are_listed(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "name": "a"}\n{"id": 2, "name": \n{"id": "x"}\n{}\n')
    good, bad = K.read_checked(spark, str(tmp_path / "a.json"), "json", ROW, 0.5)
    assert sorted((r.id is None, r.id) for r in good.collect()) == [(False, 1), (True, None)] and bad.count() == 2
    good, bad = K.read_checked(spark, str(tmp_path / "a.json"), "json", ROW, 1)
    (tmp_path / "none.json").write_text("")
    good, bad = K.read_checked(spark, str(tmp_path / "none.json"), "json", ROW)
    assert good.isEmpty() and bad.isEmpty()


@pytest.mark.parametrize("low, high, parts", [(1, 100, 7), (5, 6, 4), (-3, 3, 100), (1, 1, 3), (None, None, 3), (0, 10, 1),
                                              (date(2024, 1, 1), date(2024, 3, 1), 8), (date(2024, 1, 1), date(2024, 1, 2), 8)])
def test_predicates_cover_every_row_once(low, high, parts):
    found = W.range_predicates("c", low, high, parts)
    assert 1 <= len(found) <= max(1, parts)
    if isinstance(low, date):
        values = [None, *(low + timedelta(days=k) for k in range(-5, 80))]
    else:
        values = [None, *range((low or 0) - 5, (high or 0) + 6)]
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t (c {'DATE' if isinstance(low, date) else 'BIGINT'})")
    con.executemany("INSERT INTO t VALUES (?)", [(v,) for v in values])
    counts = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in found]
    assert sum(counts) == len(values) and con.execute(f"SELECT count(*) FROM t WHERE {' OR '.join(f'({p})' for p in found)}").fetchone()[0] == len(values)
    if isinstance(low, int) and high - low > parts:
        assert max(counts) <= 2 * len(values) / parts + 12


def test_columns_and_types_of_a_source_are_checked(spark):
    rows = [(Decimal(7), "EUR", 1)]
    df = spark.createDataFrame(rows, "CURRENCY_ID decimal(10,0), Currency_Code string, extra int")
    got = W.conforming(df, "currency")
    assert got.dtypes == [("currency_id", "int"), ("currency_code", "string")] and got.first() == (7, "EUR")
    with pytest.raises(ValueError, match="lacks the columns currency_code"):
        W.conforming(df.drop("Currency_Code"), "currency")
    with pytest.raises(ValueError, match=r"currency_id is decimal\(10,2\), not int"):
        W.conforming(df.withColumn("CURRENCY_ID", df["CURRENCY_ID"].cast("decimal(10,2)")), "currency")
    with pytest.raises(ValueError, match="currency_code is int"):
        W.conforming(df.withColumn("Currency_Code", df["extra"]), "currency")


class _Reader:
    """Stands for a session: notes what is asked, answers with bounds or a frame."""

    def __init__(self, frame):
        self.frame, self.calls = frame, []
        self.read = self

    def jdbc(self, url, table, predicates=None, properties=None):
        self.calls.append((url, table, predicates, properties))
        return self.frame if predicates else self

    def first(self):
        return 1, 10


def test_a_parallel_read_sends_one_predicate_per_task(spark):
    reader = _Reader(spark.createDataFrame([(1, "EUR")], "currency_id int, currency_code string"))
    got = W.jdbc_table(reader, "currency", {"url": "jdbc:x", "dbtable": "s.currency", "user": "u", "partition_column": "currency_id", "partitions": "3"})
    assert got.count() == 1
    assert reader.calls[0] == ("jdbc:x", "(SELECT min(currency_id) AS low, max(currency_id) AS high FROM s.currency) bounds", None, {"user": "u"})
    assert reader.calls[1][1:] == ("s.currency", ["currency_id < 4 OR currency_id IS NULL", "currency_id >= 4 AND currency_id < 7", "currency_id >= 7"], {"user": "u"})
