"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityscope.llm.shared import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    others = links.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node of links (``u``, ``v``).

    A node's neighbours are never gathered: each star is a minimum per node, aggregated
    before the shuffle, and a join back. Each star is written, so lineage stays short, and
    so do the plans: a star reads its links several times, and the driver keeps each node.
    """
    links = links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = written(links, "links")
    seen = None
    while True:
        links = written(_small_star(written(_large_star(links), "links")), "links")
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())
