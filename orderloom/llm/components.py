"""Connected components of a link table by alternating star contraction.

Every round hangs neighbours on their smallest neighbour, first the larger ones
(large star), then the smaller ones (small star), until every node hangs on the
smallest node of its component. All steps are joins and grouped minima; rounds
grow with the logarithm of the table. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.storage import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    joined = both.join(least, "u").where((F.col("v") > F.col("u")) & (F.col("v") != F.col("low")))
    return joined.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Takes edges with u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("low"))
    joined = edges.join(least, "u").where(F.col("v") != F.col("low"))
    moved = joined.select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionAll(least.select("u", F.col("low").alias("v"))).distinct()


def _mark(edges: DataFrame):
    found = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.max("u")).first()
    return tuple(found)


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it reaches) for every node with a link.

    ``links`` has two columns of one comparable type. Loops, repeated links and
    either direction are fine; rows with a null are ignored. No links, no rows.
    """
    a, b = links.columns
    edges = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = materialize(edges.distinct(), "links")
    before = None
    while (now := _mark(edges)) != before:
        before = now
        edges = materialize(_small_star(_large_star(edges)), "stars")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
