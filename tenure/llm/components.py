"""Connected components of a large graph by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.operators.staging import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every greater neighbour of a node to the least node around."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Written: the rows of a star's centre are split only against a table that is scanned.
    least = staged(both.groupBy("u").agg(F.min("v").alias("m")), "star_least")
    near = both.where("v > u").join(least, "u")
    return near.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = staged(down.groupBy("u").agg(F.min("v").alias("m")), "star_least")
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    # Decimal: a sum of 64-bit hashes may leave 64 bits.
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (u, v); the root is the least node reachable.

    Each round is written to the shared folder, which cuts the lineage and survives a lost
    executor; the number of rounds grows with the logarithm of the longest chain. Minima are
    combined before they are shuffled and written before they are joined, so that the rows of a
    node with very many links can be split.
    """
    now = staged(_small_star(edges), "star")
    before, state = None, _state(now)
    while state != before:
        now = staged(_small_star(staged(_large_star(now), "star")), "star")
        before, state = state, _state(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
