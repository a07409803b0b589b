"""Connected components by alternating star contraction, in a number of rounds that grows with the logarithm of the nodes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: No table comes near so many rounds; reaching it is an error, never a result.
MOST_ROUNDS = 1000


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour instead."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def components(edges: DataFrame, keep: Callable[[DataFrame], DataFrame], rounds: int = MOST_ROUNDS) -> DataFrame:
    """(node, root) for every node of edges (u, v) of longs; root is the least node reachable. No edges: no rows.

    ``keep`` ends the lineage of each round's table. Rounds go on until nothing changes; beyond ``rounds`` is an error.
    """
    edges = keep(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark, turn = _mark(edges), 0
    while mark[0]:
        if turn == rounds:
            raise RuntimeError(f"components still change after {rounds} rounds")
        edges = keep(_small_star(_large_star(edges)))
        before, mark, turn = mark, _mark(edges), turn + 1
        if mark == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
