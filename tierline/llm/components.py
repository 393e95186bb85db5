"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import drop_staged, stage


def _ordered(a, b) -> tuple:
    return F.greatest(a, b).alias("u"), F.least(a, b).alias("v")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node links to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, link to the smallest of them."""
    e = edges.select(*_ordered(F.col("u"), F.col("v")))
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    linked = e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: one edge per larger node, and no centre is one."""
    centres = edges.select(F.col("v").alias("u")).distinct()
    inner = edges.join(centres, "u", "left_semi").select("u")
    double = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
    return inner.union(double).isEmpty()


def connected_components(spark: SparkSession, edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``: the smallest node that it
    reaches.  Self-links and repeated links are fine; nodes are integers.  Each round is
    written to shared storage, so lineage stays short; the rounds end when every
    component is a star around its smallest node."""
    now = stage(spark, edges.select(*_ordered(F.col("u"), F.col("v"))).where("u <> v").distinct(), "cc")
    for _ in range(most_rounds):
        if _settled(now):
            break
        after = stage(spark, _small_star(_large_star(now)), "cc")
        drop_staged(spark, now)
        now = after
    else:
        raise RuntimeError("components did not settle")
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
