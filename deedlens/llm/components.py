"""Distributed union-find: connected components of a graph given as edges.

Alternating large-star and small-star rounds: each hangs the neighbours of a
node below the smallest node known to it, and the forest becomes one star per
component after a number of rounds that grows with the logarithm of the size.
A round is joins and grouped minima over narrow rows; no group is collected.
The edges of each round are written to shared scratch files and the ones before
are deleted, so a lost executor costs a re-read of one round.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deedlens.sources.scratch import remove, scratch_path, stored_at


class Forest:
    """Union-find in the memory of one task, over positions 0 to n - 1."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        """Unite two sets; False if they were one already."""
        a, b = self.root(i), self.root(j)
        if a == b:
            return False
        if a > b:
            a, b = b, a
        self.parent[b] = a
        return True

    def roots(self) -> np.ndarray:
        return np.fromiter((self.root(i) for i in range(len(self.parent))), np.int64, len(self.parent))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes below the smallest of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    return (
        both.where("b > a").join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go below the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
    moved = down.join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("k").alias("a"), F.col("m").alias("b"))
    return moved.where("a > b").union(own).distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    """One row: enough to tell whether a round has changed anything."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that has an edge to another: ``root`` is the smallest node in reach.

    Nodes are longs. Loops, repeated edges and edges with a NULL end add
    nothing. An empty frame gives an empty one. Jobs run while this is called;
    the result is a stored table.
    """
    spark = edges.sparkSession
    raw = edges.select(F.col(f"`{a}`").alias("a"), F.col(f"`{b}`").alias("b"))
    path = scratch_path(spark, "edges")
    work = stored_at(raw.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), path)
    seen = _fingerprint(work)
    while seen[0]:
        next_path = scratch_path(spark, "edges")
        after = stored_at(_small_star(_large_star(work)), next_path)
        remove(spark, path)
        found, path, work = _fingerprint(after), next_path, after
        if found == seen:
            break
        seen = found
    members = work.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return members.union(work.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
