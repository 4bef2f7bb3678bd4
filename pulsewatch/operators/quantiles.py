"""Exact per-series aggregation that also holds for oversized series.

Spark's ``percentile`` keeps every distinct value of a group in one buffer. A
series normally has one row per day, so that is a few dozen values; but rows
without a name all fall into one series, which may then hold a large part of
the data. Such series are found by a cheap count and ranked by counting values
in buckets instead, so that no task ever holds a whole oversized series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsewatch.sources.stage import stage

_CUTS = 256
#: Distinct values that a range may have in the end.
FEW = 1000


def oversized_keys(df: DataFrame, key: str, limit: int) -> DataFrame | None:
    """Keys with more than ``limit`` rows, or None if there are none.

    Pass a staged frame: the emptiness check runs a job that reads the key
    column only.
    """
    big = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select(key)
    return None if big.isEmpty() else big


def _between(position: Column, low: Column, high: Column) -> Column:
    """Linear interpolation between the two values around ``position``."""
    below, above = F.floor(position), F.ceil(position)
    return F.when(below == above, low).otherwise(
        (above - position) * low + (position - below) * high)


def counted_quantiles(df: DataFrame, key: str, metrics: list[str],
                      probabilities: list[float]) -> DataFrame:
    """Exact quantiles (linear interpolation) by counting, for large groups.

    Every wanted rank has a range of values that holds it. The values of a range
    are counted in buckets, cut at approximate quantiles, and the range shrinks to
    the bucket with the rank, round by round, until it has few distinct values.
    No task sorts the values of a group or holds more than ``FEW`` of them. A
    missing key is a key.
    """
    pair = ["__key", "metric"]
    long = df.select(F.struct(F.col(key).alias("key")).alias("__key"), F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in metrics])).alias("e")).select("__key", "e.metric", "e.value")
    counts = stage(long.where(F.col("value").isNotNull())
                   .groupBy(*pair, "value").agg(F.count(F.lit(1)).alias("cnt")), "value-counts")
    numbers = counts.groupBy(*pair).agg(F.sum("cnt").alias("n"))
    positions = [(F.col("n") - 1) * F.lit(p) for p in probabilities]
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), r.cast("long").alias("rank")) for i, pos in enumerate(positions) for r in (F.floor(pos), F.ceil(pos))])
    whole = numbers.select(*pair, F.explode(F.array_distinct(F.transform(ranks, lambda r: r["rank"]))).alias("rank"))
    ranges = whole.select(*pair, "rank", F.lit(float("-inf")).alias("low"), F.lit(float("nan")).alias("high"), F.lit(0).cast("long").alias("start"))
    while True:
        # not a number is the greatest value
        inside = counts.join(ranges, pair).where((F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high")))
        sizes = inside.groupBy(*pair, "rank").agg(F.count(F.lit(1)).alias("k"))
        if sizes.where(F.col("k") > FEW).isEmpty():
            break
        ranges = stage(_narrowed(inside, [*pair, "rank"]), "value-ranges")
    held = inside.groupBy(*pair, "rank", "start").agg(F.sort_array(F.collect_list(F.struct("value", "cnt"))).alias("held"))
    seen = F.aggregate("held", F.struct(F.col("start").alias("upto"), F.lit(None).cast("double").alias("value")), lambda done, v: F.struct(
        (done["upto"] + v["cnt"]).alias("upto"), F.when(done["upto"] <= F.col("rank"), v["value"]).otherwise(done["value"]).alias("value")), lambda done: done["value"])
    found = held.select(*pair, "rank", seen.alias("value")).groupBy(*pair).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))

    def value_at(position: Column) -> Column:
        return F.element_at("at", position.cast("long"))

    result = found.join(numbers, pair).select(*pair, F.array(*[
        _between(pos, value_at(F.floor(pos)), value_at(F.ceil(pos))) for pos in positions]).alias("q"))
    return result.groupBy(F.col("__key.key").alias(key)).agg(*[
        F.max(F.when(F.col("metric") == m, F.col("q"))).alias(f"{m}__q") for m in metrics])


def _narrowed(inside: DataFrame, rank: list[str]) -> DataFrame:
    """For every rank the bucket of its range that holds it."""
    steps = F.array(*[F.lit(i / _CUTS) for i in range(1, _CUTS)])
    cuts = inside.groupBy(*rank).agg(F.percentile_approx("value", steps, 10_000).alias("cuts"))
    buckets = (inside.join(cuts, rank).withColumn("bucket", F.size(F.filter("cuts", lambda c: c < F.col("value"))))
               .groupBy(*rank, "start", "bucket").agg(F.sum("cnt").alias("size"), F.min("value").alias("low"), F.max("value").alias("high")))
    # a row per bucket, of which there are few
    before = Window.partitionBy(*rank).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = buckets.withColumn("start", F.col("start") + F.coalesce(F.sum("size").over(before), F.lit(0)))
    return placed.where((F.col("start") <= F.col("rank")) & (F.col("rank") < F.col("start") + F.col("size"))).select(*rank, "low", "high", "start")


def series_profile(df: DataFrame, key: str, aggregates: list[Column], metrics: list[str],
                   probabilities: list[float], oversized: DataFrame | None = None) -> DataFrame:
    """One row per series: ``aggregates`` plus ``<metric>__q`` quantile arrays.

    ``aggregates`` must keep a bounded state per series. One shuffle on the
    series key unless there are oversized series.
    """
    steps = F.array(*[F.lit(p) for p in probabilities])
    quantiles = [F.percentile(m, steps).alias(f"{m}__q") for m in metrics]
    if oversized is None:
        return df.groupBy(key).agg(*aggregates, *quantiles)
    usual = df.join(oversized, key, "left_anti").groupBy(key).agg(*aggregates, *quantiles)
    large = df.join(oversized, key, "left_semi")
    counted = counted_quantiles(large, key, metrics, probabilities)
    return usual.unionByName(large.groupBy(key).agg(*aggregates).join(counted, key))
