"""Connected components of a distributed edge table, by alternating large and small stars.

Every round gives each neighbour of a node the smallest node known there, first to larger neighbours, then to smaller
ones, until all edges of a component point at its smallest node. Each round is stored, nothing is collected but a count
and a checksum, and minima are taken before rows are shuffled, so a node may have any number of neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.session import stored

ROUNDS = 60  # far beyond the logarithm of any component's size; not reaching a fixed point by then is an error


def _round(edges: DataFrame) -> DataFrame:
    """edges: big, small with big > small."""
    both = edges.union(edges.select(F.col("small").alias("big"), F.col("big").alias("small"))).toDF("node", "near")
    least = both.groupBy(F.col("node").alias("at")).agg(F.least(F.min("near"), F.first("node")).alias("least"))
    large = both.where(F.col("near") > F.col("node")).join(least, F.col("node") == F.col("at")).select(F.col("near").alias("big"), F.col("least").alias("small")).distinct()
    smallest = large.groupBy(F.col("big").alias("at")).agg(F.min("small").alias("least"))
    moved = large.join(smallest, F.col("big") == F.col("at")).where(F.col("small") != F.col("least"))
    return moved.select(F.col("small").alias("big"), F.col("least").alias("small")).union(smallest.select("at", "least")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("big", "small").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its smallest node) for every node that has an edge to another one."""
    ordered = edges.select(F.greatest(a, b).alias("big"), F.least(a, b).alias("small")).where("big > small").distinct()
    current = stored(ordered, "edges")
    mark = _mark(current)
    for _ in range(ROUNDS):
        current = stored(_round(current), "edges")
        before, mark = mark, _mark(current)
        if mark == before:
            leaves = current.select(F.col("big").alias("node"), F.col("small").alias("component"))
            return leaves.union(current.select("small", "small").distinct())
    raise RuntimeError("components did not settle")
