"""Connected components of an edge table by alternating star contractions on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import stored

MAX_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour or itself."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return around.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def _print(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(mixed), F.bit_xor(F.xxhash64(mixed, F.lit(7)))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node.

    ``edges`` has the long columns a and b.  Each round is written to the shared folder; only a
    count and two checksums reach the driver.  The number of rounds grows with the logarithm of
    the longest chain.
    """
    current = stored(edges.select("a", "b").filter("a <> b"), "edges")
    before = _print(current)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        current = stored(_small_star(_large_star(current)), "edges")
        after = _print(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    leaves = current.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("component"))
    roots = leaves.select(F.col("component").alias("node"), "component").distinct()
    return leaves.union(roots)
