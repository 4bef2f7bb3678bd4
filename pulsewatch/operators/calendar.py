"""Calendar fill of daily series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsewatch.operators.quantiles import series_profile
from pulsewatch.operators.series_state import calendar_of


def calendar_fill(df: DataFrame, key: str, metrics: list[str],
                  oversized: DataFrame | None = None, calendar: Column | None = None) -> DataFrame:
    """Add the days that a series lacks, up to the last day of all series.

    * a day that no series has: the series' own median per metric,
      also before the series' first day
    * any other day after the series' first day: 0
    * days before the series' first day are otherwise left out

    All other columns of an added row come from the series' first row, that is
    the smallest by day and then by the remaining columns, the hash of the
    attributes last. Reads ``df`` three
    times, so pass a staged frame. The calendar is the only thing shared by all
    tasks: one row with the distinct days (``series_state.calendar_of``); by default that of ``df``.
    """
    for metric in metrics:
        df = df.withColumn(metric, F.col(metric).cast("double"))
    calendar = calendar_of(df.select("day")) if calendar is None else calendar

    others = sorted((c for c in df.columns if c != "day"), key=lambda c: c == "attributes_id")
    profile = series_profile(df, key, [
        F.min("day").alias("__start"),
        F.collect_set("day").alias("__days"),
        F.min(F.struct("day", *others)).alias("__first"),
    ], metrics, [0.5], oversized)

    own = F.array_except(F.sequence("__start", calendar["hi"]), "__days")
    gaps = profile.withColumn("__unseen", calendar["unseen"]).withColumn(
        "__gap", F.explode(F.array_union(own, "__unseen")))
    by_median = F.array_contains("__unseen", F.col("__gap"))
    added = gaps.select(*[
        F.col("__gap").alias("day") if c == "day"
        else F.when(by_median, F.element_at(f"{c}__q", 1)).otherwise(0.0).alias(c) if c in metrics
        else F.col("__first")[c].alias(c)
        for c in df.columns])
    return df.unionByName(added)


def pad_days(df: DataFrame, key: str, value: str, today, days: int = 7,
             expected: DataFrame | None = None) -> DataFrame:
    """Short series get null rows after their last day until they have ``days``.

    Series of ``expected`` without any row start ``days`` days before today.
    """
    rows = df.select(key, "day", F.col(value).cast("double").alias(value))
    have = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max("day").alias("last"))
    if expected is not None:
        have = (expected.select(key).distinct().join(have, key, "left")
                .withColumn("n", F.coalesce("n", F.lit(0)))
                .withColumn("last", F.coalesce("last", F.date_sub(F.lit(today), days + 1))))
    missing = F.lit(days) - F.col("n").cast("int")
    padded = have.where(missing > 0).select(
        key, F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", missing))).alias("day"),
        F.lit(None).cast("double").alias(value))
    return rows.unionByName(padded)


def last_entries(df: DataFrame, key: str, value: str, n: int, digits: int = 2) -> DataFrame:
    """The last ``n`` rows of every series, value rounded half to even."""
    from pyspark.sql import Window

    newest_first = Window.partitionBy(key).orderBy(F.col("day").desc())
    return (df.select(key, "day", value)
            .withColumn("__rn", F.row_number().over(newest_first))
            .where(F.col("__rn") <= n)
            .select(key, "day", (F.bround(value, digits) + F.lit(0.0)).alias(value)))
