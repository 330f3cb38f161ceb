"""Connected components of a link table that may be far larger than one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregate.operators.layout import written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    near = _both_ways(links)
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _settled(links: DataFrame) -> bool:
    """Whether all links are stars: each node points once, and to one that does not point."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("points"), F.lit(0).alias("pointed")).unionByName(
        links.select(F.col("v").alias("node"), F.lit(0).alias("points"), F.lit(1).alias("pointed"))
    )
    seen = ends.groupBy("node").agg(F.sum("points").alias("points"), F.max("pointed").alias("pointed"))
    return seen.filter(F.col("points") + F.col("pointed") > 1).filter("points > 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, label`` of every node with a link; the label is the component's smallest node.

    Large and small stars in turn until all links are stars: a number of rounds
    that grows with the logarithm of the nodes, none where they are stars from
    the start. Each round's links are written, so a lost executor costs a re-read.
    """
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = written(down.filter("u > v").distinct())
    while not _settled(now):
        now = written(_small_star(_large_star(now)).distinct())
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
