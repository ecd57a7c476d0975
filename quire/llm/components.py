"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import checkpointed


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, component)``: each linked node with the smallest node it reaches.

    Alternating large-star and small-star rounds (Kiveris et al. 2014): every
    node's larger, then smaller, neighbours move to its smallest neighbour,
    until the graph is a set of stars.  The number of rounds grows with the
    logarithm of the longest path.  A node's minimum is pre-aggregated before
    the shuffle, so a centre with very many links costs one row per task.
    Each round is checkpointed; links never reach the driver, only their
    count and checksum.
    """
    edges = links.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u <> v").distinct()
    edges = checkpointed(edges)
    seen = _state(edges)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        edges = checkpointed(_small_star(_large_star(edges)))
        now = _state(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components: not settled after {max_rounds} rounds")
    stars = edges.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("component"))
    centres = edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return stars.unionByName(centres)


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to its smallest neighbour (itself included)."""
    both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
        edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
    least = both.groupBy("x").agg(F.min("y").alias("m")).withColumn("m", F.least("m", "x"))
    return both.where("y > x").join(least, "x").select(F.col("m").alias("u"), F.col("y").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to its smallest neighbour."""
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    moved = edges.join(least, "v").where("u <> m").select(F.col("m").alias("a"), F.col("u").alias("b"))
    own = least.select(F.col("m").alias("a"), F.col("v").alias("b"))
    return moved.unionByName(own).select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u <> v").distinct()
