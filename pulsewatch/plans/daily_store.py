"""Daily sums that are kept from run to run: only days whose facts changed are read and summed again.

The store has one partition per day, and beside it a mark of the facts that each day's sums were made from. A run compares the
marks of the days in its window with the kept ones, sums the days that differ, overwrites just their partitions, and writes their
marks last. A run that breaks off in between leaves old marks, so the next one sums these days again. One run at a time may write
to a store.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewatch.plans.runs import exists
from pulsewatch.sources.stage import stage

MARKS = "mark long, n long, day date"


def day_marks(facts: DataFrame) -> DataFrame:
    """(day, mark, n) of a fact table: one row per day that has facts.

    Facts in files are marked by name, size and time of change of the files; where the day is a partition, no fact is read for
    that. Other facts are marked by a sum of row hashes, which reads them but shuffles one row per day and task.
    """
    file = [F.col(f"_metadata.{x}") for x in ("file_path", "file_size", "file_modification_time")]
    try:
        seen = facts.select("day", F.xxhash64(*file).alias("h"))
        seen.schema
    except AnalysisException:
        seen = facts.select("day", F.xxhash64(*facts.columns, *[F.col(c).isNull() for c in facts.columns]).alias("h"))
        return seen.groupBy("day").agg(F.sum(F.col("h").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")).select(
            F.xxhash64("s").alias("mark"), "n", "day")
    files = seen.distinct().groupBy("day").agg(F.sum(F.col("h").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n"))
    return files.select(F.xxhash64("s").alias("mark"), "n", "day")


def kept_sums(facts: DataFrame, store: str, since: date, sums: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``sums`` of the facts from ``since`` on, a frame with a column ``day`` that no row of another day adds to."""
    spark = facts.sparkSession
    window = facts.where(F.col("day") >= F.lit(since))
    marks = stage(day_marks(window).where("day IS NOT NULL"), "day-marks")
    now = {r["day"]: (r["mark"], r["n"]) for r in marks.collect()}       # a row per day of the window
    kept = {}
    if exists(spark, f"{store}/marks"):
        known = spark.read.schema(MARKS).parquet(f"{store}/marks").where(F.col("day") >= F.lit(since))
        kept = {r["day"]: (r["mark"], r["n"]) for r in known.collect()}
    changed = sorted(day for day, mark in now.items() if kept.get(day) != mark)
    fresh = sums(window.where(F.col("day").isin(changed)))
    schema = fresh.schema
    if changed:
        replace = {"partitionOverwriteMode": "dynamic", "compression": "zstd"}
        fresh.write.mode("overwrite").options(**replace).partitionBy("day").parquet(f"{store}/sums")
        marks.where(F.col("day").isin(changed)).coalesce(1).write.mode("overwrite").options(**replace).partitionBy("day").parquet(f"{store}/marks")
    if not now:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{store}/sums").where(F.col("day").isin(sorted(now)))
