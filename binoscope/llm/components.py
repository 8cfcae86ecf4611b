"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binoscope.llm.shared import written


def _down(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger end u to the smaller end v; no loops."""
    return (edges.where(F.col("u") != F.col("v"))
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("least"))


def large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the least node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least_neighbour(both).select("u", F.least("u", "least").alias("least"))
    return _down(both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v")))


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it move to the least of these."""
    least = _least_neighbour(edges)
    moved = edges.join(least, "u")
    return _down(moved.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(least.select("u", F.col("least").alias("v"))))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge between different nodes; component is the least node it can reach.

    Groups are never gathered: a step is a minimum per node and a join with it, and each round is written to the shared
    folder. The number of rounds grows with the logarithm of the longest path.
    """
    def mark(table: DataFrame) -> tuple:
        return tuple(table.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    current = written(_down(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "edges")
    before = mark(current)
    while before[0]:
        current = written(small_star(large_star(current)), "edges")
        now = mark(current)
        if now == before:
            break
        before = now
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
