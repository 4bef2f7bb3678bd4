"""The warehouse star schema that all products read."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {"s": T.StringType(), "l": T.LongType(), "i": T.IntegerType(), "d": T.DoubleType(),
          "D": T.DateType(), "t": T.TimestampType()}


def _schema(text: str) -> T.StructType:
    pairs = (item.split(":") for item in text.split())
    return T.StructType([T.StructField(name, _TYPES[code]) for name, code in pairs])


# ---- fixed values: input schemas (s text, l long, i int, d double, D date, t timestamp)
SCHEMAS = {
    "employee": _schema("employee_id:l full_name:s email:s country:s cost_center_country:s "
                        "cost_center_activity:s job_name:s direct_reports_id:l"),
    "client": _schema("client_id:l client_name:s campaign_id:l campaign_name:s "
                      "account_strategist_employee_id:l ts_engineer_employee_id:l client_currency_id:i "
                      "partner_id:l partner_name:s ranking:s campaign_scenario_product_level_1_name:s "
                      "campaign_type_name:s campaign_revenue_type:i campaign_funnel_id:i vertical_name:s "
                      "vertical_level_2_name:s vertical_level_3_name:s global_account_name:s "
                      "client_country_name:s client_country_level_1_name:s "
                      "client_country_level_2_name:s client_country_level_3_name:s"),
    "currency": _schema("currency_id:i currency_code:s"),
    "country": _schema("country_code:s country_level_1_name:s country_level_2_name:s country_level_3_name:s"),
    "stats": _schema("day:D campaign_id:l client_id:l displays:d clicks:d sales_all_post_click:d "
                     "order_value_all_post_click_local:d revenue_local:d tac_local:d revenue_euro:d "
                     "tac_euro:d affiliate_currency_id:i"),
    "stats_2": _schema("day:D campaign_id:l tac_local:d revenue_local:d affiliate_currency_id:i"),
    "fx_daily": _schema("source_currency_id:i destination_currency_id:i day:D rate:d"),
    "fx_year": _schema("source_currency_id:i destination_currency_id:i year_code:i forecast_type_id:i rate:d"),
    "events": _schema("partner_id:l day:D site_type:s event_name:s events:l"),
    "import_reports": _schema("table_schema:s table_name:s update_time:t"),
    "run_history": _schema("run_date:D script:s geo:s"),
    "sent_history": _schema("run_date:D to:s subject:s"),
}
# -----------------------------------------------------------------------------


class Star:
    """The warehouse tables as attributes; a table is opened when first used."""

    def __init__(self, **tables: DataFrame | Callable[[], DataFrame]):
        missing = SCHEMAS.keys() - tables.keys()
        if missing:
            raise ValueError(f"missing tables: {', '.join(sorted(missing))}")
        self._tables = dict(tables)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._tables:
            raise AttributeError(name)
        table = self._tables[name]
        if not isinstance(table, DataFrame):
            table = self._tables[name] = table()
        return table


# what a source's type may be read as; numbers of any kind as double
_READS_AS = {
    T.LongType: (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType), T.IntegerType: (T.ByteType, T.ShortType, T.IntegerType, T.DecimalType),
    T.DoubleType: (T.NumericType,), T.StringType: (T.StringType, T.CharType, T.VarcharType), T.DateType: (T.DateType, T.TimestampType),
    T.TimestampType: (T.TimestampType, T.TimestampNTZType, T.DateType)}


def conforming(df: DataFrame, name: str) -> DataFrame:
    """The declared columns of a table in their declared types.

    Column names are matched whatever their case, as databases return them. A missing column, one of a type that does not fit, or a
    decimal with digits behind the point for a whole number is an error.
    """
    own = {f.name.lower(): f for f in df.schema.fields}
    missing = [f.name for f in SCHEMAS[name].fields if f.name.lower() not in own]
    if missing:
        raise ValueError(f"table {name} lacks the columns {', '.join(sorted(missing))}")
    out, wrong = [], []
    for f in SCHEMAS[name].fields:
        kind = own[f.name.lower()].dataType
        whole = not (isinstance(kind, T.DecimalType) and kind.scale and isinstance(f.dataType, T.IntegralType))
        if not whole or not isinstance(kind, _READS_AS[type(f.dataType)]):
            wrong.append(f"{f.name} is {kind.simpleString()}, not {f.dataType.simpleString()}")
        out.append(F.col(f"`{own[f.name.lower()].name}`").cast(f.dataType).alias(f.name))
    if wrong:
        raise ValueError(f"table {name}: {'; '.join(wrong)}")
    return df.select(*out)


def _literal(value) -> str:
    return f"DATE '{value.isoformat()}'" if isinstance(value, date) else str(value)


def range_predicates(column: str, low, high, parts: int) -> list[str]:
    """Conditions that cut a column's range, whole numbers or dates, into at most ``parts`` of equal width.

    Every row meets exactly one of them: the first also takes nulls, the first and the last what lies outside the bounds, which may
    have moved since they were asked for.
    """
    if low is None or parts < 2 or low == high:
        return ["1 = 1"]
    width = (high - low).days if isinstance(low, date) else high - low
    steps = sorted({width * k // parts for k in range(1, parts)} - {0})
    cuts = [low + (timedelta(days=s) if isinstance(low, date) else s) for s in steps]
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {_literal(a)} AND {column} < {_literal(b)}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {_literal(cuts[0])} OR {column} IS NULL", *inner, f"{column} >= {_literal(cuts[-1])}"]


def jdbc_table(spark: SparkSession, name: str, options: Mapping[str, str]) -> DataFrame:
    """A table over JDBC, read in parallel if ``partition_column`` (whole numbers or dates) and ``partitions`` are given.

    Bounds are asked for in a query of its own; every task then sends one of the predicates. All other options go to the source.
    """
    options = dict(options)
    column, parts = options.pop("partition_column", None), int(options.pop("partitions", 1))
    if column is None or parts < 2:
        return conforming(spark.read.format("jdbc").options(**options).load(), name)
    url, table = options.pop("url"), options.pop("dbtable")
    asked = f"(SELECT min({column}) AS low, max({column}) AS high FROM {table}) bounds"
    low, high = spark.read.jdbc(url, asked, properties=options).first()
    return conforming(spark.read.jdbc(url, table, predicates=range_predicates(column, low, high, parts), properties=options), name)


def read_table(spark: SparkSession, name: str, location: str | Mapping[str, str],
               fmt: str = "parquet") -> DataFrame:
    """A warehouse table from files (path) or from JDBC (mapping of options).

    Files are read with the declared schema, after a check that they have its
    columns; those of a JDBC source are checked and cast.
    """
    if isinstance(location, Mapping):
        return jdbc_table(spark, name, location)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    missing = {f.name for f in SCHEMAS[name].fields} - set(reader.load(location).columns)
    if missing:
        raise ValueError(f"table {name} lacks the columns {', '.join(sorted(missing))}")
    return reader.schema(SCHEMAS[name]).load(location)


def load_star(spark: SparkSession, locations: Mapping[str, str | Mapping[str, str]],
              fmt: str = "parquet") -> Star:
    return Star(**{name: partial(read_table, spark, name, locations[name], fmt) for name in SCHEMAS})


class EmptySourceError(RuntimeError):
    """A source that must have rows returned none."""


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """An empty query result is a failure, not "no alerts"; pass a staged frame."""
    if df.isEmpty():
        raise EmptySourceError(f"{name} returned no rows")
    return df
