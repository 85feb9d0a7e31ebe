"""Connected components of a large edge list, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node of an edge with the smallest node it reaches.

    Alternating large-star and small-star steps. Each step is a minimum per
    node (combined before the shuffle) joined back to the edges; nothing but
    an edge count and a checksum reaches the driver. Each round is written to
    the shared folder, so lineage stays short. Empty input gives no rows;
    repeated edges and self loops change nothing.
    """
    now = stage(_arrows(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))).distinct(), "components")
    seen = _digest(now)
    while seen[0]:
        now = stage(_small_star(_large_star(now)), "components")
        last, seen = seen, _digest(now)
        if seen == last:
            break
    children = now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return children.unionByName(roots)


def _arrows(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the node's smallest one."""
    both = e.select(F.col("hi").alias("node"), F.col("lo").alias("other")).unionByName(e.select(F.col("lo").alias("node"), F.col("hi").alias("other")))
    least = both.groupBy("node").agg(F.min("other").alias("least")).withColumn("least", F.least("least", "node"))
    out = both.where(F.col("other") > F.col("node")).join(least, "node")
    return out.select(F.col("other").alias("hi"), F.col("least").alias("lo")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them."""
    least = e.groupBy("hi").agg(F.min("lo").alias("least"))
    moved = e.join(least, "hi").where(F.col("lo") != F.col("least")).select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("least").alias("lo"))).distinct()


def _digest(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())
