"""Connected components of a table of links, by alternating star steps.

Each step is two grouped minima and joins, so no node's links are collected; links stay a table from step to step. Every
step's table is written to the shared folder, and only its size and checksum come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rapproche.session import stage


def _minima(links: DataFrame) -> DataFrame:
    """The smallest neighbour of each node ``a``."""
    return links.groupBy("a").agg(F.min("b").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Links (a > b): every neighbour above a node is linked to the least of the node and its neighbours."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _minima(both).select("a", F.least("a", "least").alias("least"))
    out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return out.where("a > b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links (a > b): a node and its lesser neighbours are linked to the least of them."""
    least = _minima(links)
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a > b")
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); the component is its smallest node.

    Null nodes and links of a node to itself are ignored. An empty table gives an empty table.
    """
    known = links.where("a is not null and b is not null and a <> b")
    now = stage(known.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        now = stage(_small_star(_large_star(now)), "links")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
