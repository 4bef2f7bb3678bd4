"""Which series are fit to be tested."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def disqualify(df: DataFrame, key: str, yesterday: date, required_rows: int = 25) -> DataFrame:
    """Series that must not alert, with the reasons; one shuffle.

    * no row for yesterday
    * no positive cost of media (``tac``) over the last two days
    * fewer rows than ``required_rows`` since ``required_rows + 4`` days before
      yesterday (rows are counted, not distinct days)
    """
    day_before = yesterday - timedelta(days=1)
    since = yesterday - timedelta(days=required_rows + 4)
    flags = df.groupBy(key).agg(
        F.count_if(F.col("day") == F.lit(yesterday)).alias("rows_yesterday"),
        F.sum(F.when(F.col("day").isin(yesterday, day_before), F.bround("tac", 2))).alias("recent_tac"),
        F.count_if(F.col("day") >= F.lit(since)).alias("recent_rows"),
    )
    return flags.select(
        key,
        (F.col("rows_yesterday") == 0).alias("no_data_yesterday"),
        F.coalesce(F.col("recent_tac") <= 0, F.lit(False)).alias("no_recent_tac"),
        F.col("recent_rows").between(1, required_rows - 1).alias("not_live"),
    ).where("no_data_yesterday OR no_recent_tac OR not_live")


def drop_series(df: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """Anti join on the series key; a missing name counts as a name."""
    out = dropped.select(F.col(key).alias("__dropped"))
    return df.join(out, F.col(key).eqNullSafe(F.col("__dropped")), "left_anti")


def eligibility(df: DataFrame, key: str, metrics: list[str], check_day: date,
                required_rows: int = 25) -> DataFrame:
    """Per (series, metric): enough rows and a last row on the day checked."""
    per_series = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("day").alias("last_day"))
    return per_series.select(
        key, F.explode(F.array(*[F.lit(m) for m in metrics])).alias("metric"), "n_rows",
        ((F.col("n_rows") >= required_rows) & (F.col("last_day") == F.lit(check_day))).alias("is_eligible"))


def live_keys(df: DataFrame, key: str, first: date, last: date, days: int) -> DataFrame:
    """Keys seen on exactly ``days`` distinct days between two dates."""
    seen = df.where(F.col("day").between(F.lit(first), F.lit(last))).select(key, "day").distinct()
    return seen.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == days).select(key)
