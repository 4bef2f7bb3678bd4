"""Expressions that replace missing and infinite values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio(numerator: str, denominator: str) -> Column:
    """Quotient, null where the denominator is zero (ANSI-safe)."""
    return F.try_divide(F.col(numerator).cast("double"), F.col(denominator).cast("double"))


def _cleaned(name: str, kind: T.DataType) -> str:
    col = f"`{name}`"
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # null is not less than infinity either
        return f"CASE WHEN NOT isnan({col}) AND abs({col}) < double('infinity') THEN {col} ELSE 0D END AS {col}"
    if isinstance(kind, T.StringType):
        return f"coalesce({col}, '0') AS {col}"
    if isinstance(kind, T.NumericType):
        return f"coalesce({col}, CAST(0 AS {kind.simpleString()})) AS {col}"
    return col


def clean_data(df: DataFrame, keep: tuple[str, ...] = ("day",)) -> DataFrame:
    """Null, NaN and infinite values become 0, null text becomes "0"."""
    return df.selectExpr(*[
        f"`{f.name}`" if f.name in keep else _cleaned(f.name, f.dataType) for f in df.schema.fields])


def with_kpi_ratios(df: DataFrame) -> DataFrame:
    """cost of sale, click-through and conversion rate; 0 where undefined."""
    return df.withColumns({
        "cos": F.coalesce(ratio("spend", "order_value"), F.lit(0.0)),
        "ctr": F.coalesce(ratio("clicks", "displays"), F.lit(0.0)),
        "cr": F.coalesce(ratio("conversions", "clicks"), F.lit(0.0)),
    })
