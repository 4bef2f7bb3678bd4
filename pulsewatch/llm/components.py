"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewatch.llm.common import staged


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Connects the neighbours of every node to the least of them: the larger ones, or the smaller ones and the node."""
    if large:
        around = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    joined = around.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            least.select("a", F.col("low").alias("b")))
    return out.where("a != b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): label is the least node that links reach. Nodes without a link to another node have no row.

    Every round writes its edges to the shared folder. A round ends with a forest of stars whose centre is smaller than
    its leaves; nothing changes any more when all components are stars.
    """
    now = staged(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b").distinct())

    def state(x: DataFrame) -> tuple:
        return x.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = state(now)
    while before[0]:
        now = staged(_star(_star(now, large=True), large=False))
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
