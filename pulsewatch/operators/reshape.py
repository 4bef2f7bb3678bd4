"""Wide to long."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_kpis(df: DataFrame, ids: list[str], kpis: list[str]) -> DataFrame:
    """Rows (ids, kpi, value), one per KPI; values as double."""
    wide = df.select(*ids, *[F.col(k).cast("double").alias(k) for k in kpis])
    return wide.unpivot(ids, kpis, "kpi", "value")


def wide_to_long(df: DataFrame, day: str, series: dict[str, str]) -> DataFrame:
    """Columns of ``df`` as rows (Day, Series, RexT); keys are the shown names."""
    wide = df.select(F.col(day).alias("Day"), *[
        F.col(column).cast("double").alias(shown) for shown, column in series.items()])
    return wide.unpivot(["Day"], list(series), "Series", "RexT")


def kpi_order(kpi: str = "kpi", order: tuple[str, ...] = ()) -> Column:
    """1-based position of a KPI in report order; unknown KPIs come last."""
    position = F.array_position(F.array(*[F.lit(k) for k in order]), F.col(kpi))
    return F.when(position > 0, position).otherwise(len(order) + 1).cast("int")
