"""Connected components of a graph of integer nodes, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """For each node with a link to another one: ``node`` and ``root``, the smallest node it is connected to;
    roots themselves have no row. Self-links and repeated links don't matter; nulls are left out.

    Each step halves paths, so that the number of steps grows with the logarithm of the number of nodes.
    Links are checkpointed after each step; nothing is collected.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    links = materialize(links.where(x != y).select(F.greatest(x, y).alias("hi"), F.least(x, y).alias("lo")).distinct())
    while not _all_stars(links):
        both = links.unionByName(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).select(
            F.col("hi").alias("u"), F.least("hi", "m").alias("m"))
        larger = both.where("lo > hi").select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        large = larger.join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = materialize(large)
        least = large.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("u"), "m")
        small = large.join(least, F.col("hi") == F.col("u"))
        links = materialize(small.select(F.explode(F.array(
            F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")),
            F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("l")).select("l.*").where("hi != lo").distinct())
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def _all_stars(links: DataFrame) -> bool:
    """Whether every node has one link down, to a node that has none."""
    ends = links.select(F.explode(F.array(
        F.struct(F.col("hi").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")),
        F.struct(F.col("lo").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))).alias("e")).select("e.*")
    return ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")) \
        .where("down > 1 or (down > 0 and up > 0)").isEmpty()
