"""Consecutive numbers for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsewatch.sources.stage import stage


def number_rows(df: DataFrame, groups: list[str], order: list[Column], name: str) -> DataFrame:
    """1-based row number per group in a total order, without one task per group.

    The rows are range-partitioned by (group, order), so a large group spreads
    over many slices; a running sum over the slice sizes gives each slice its
    first number. The slices are staged, which fixes them against recomputation.
    ``groups`` must not be null.
    """
    sliced = df.repartitionByRange(*[F.col(g) for g in groups], *order)
    sliced = stage(sliced.withColumn("__slice", F.spark_partition_id()), f"slices-{name}")
    sizes = sliced.groupBy(*groups, "__slice").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.partitionBy(*groups).orderBy("__slice").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    starts = sizes.select(*groups, "__slice", (F.sum("__size").over(before) - F.col("__size")).alias("__start"))
    within = Window.partitionBy(*groups, "__slice").orderBy(*order)
    return (sliced.join(starts, [*groups, "__slice"])
            .withColumn(name, (F.col("__start") + F.row_number().over(within)).cast("int"))
            .drop("__slice", "__start"))
