"""Connected components of a table of links, by alternating large and small stars.

A large star ties every larger neighbour of a node to the smallest neighbour; a small star does the same
for the smaller ones. Alternated, they turn any graph into stars around each component's smallest node, in a number of
turns that grows with the logarithm of its size. Each turn is two aggregates and joins of links only, written to the
shared folder, so no component is ever gathered in one task or on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileframe.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` point from larger to smaller."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    others = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every node of the links ``a, b``; the component is its smallest node.

    Links of a node with itself and repeated links are allowed; nodes without links are not returned."""
    now = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
        now = stored(_small_star(_large_star(now).distinct()).distinct(), "stars")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
