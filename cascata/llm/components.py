"""Connected components of links, within a task and over a whole DataFrame."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from cascata.session import discard, materialize


class Forest:
    """Roots of the items 0..n-1 of one block under links that arrive in arrays; a root is its tree's least item."""

    def __init__(self, n: int) -> None:
        self.roots = np.arange(n)

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        roots = self.roots
        while True:
            a, b = roots[left], roots[right]
            apart = a != b
            if not apart.any():
                return
            low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
            left, right = left[apart], right[apart]
            np.minimum.at(roots, high, low)
            while True:
                further = roots[roots]
                if np.array_equal(further, roots):
                    break
                roots = further
            self.roots = roots

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Each item that is not a root, with its root."""
        items = np.flatnonzero(self.roots != np.arange(len(self.roots)))
        return items, self.roots[items]


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(xxhash64(b, a, 1))")).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(
        least.select("a", F.col("m").alias("b")))


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the links ``a``, ``b``; a component's name is its least node.

    Alternating large and small stars; each round is stored in the shared folder, which cuts the
    lineage, and the one before it deleted. Links of a node to itself and nulls are ignored. Minima are taken in part before the
    shuffle, and the joins are plain ones, which Spark's skew join can split at a hub.
    """
    now = materialize(edges.select("a", "b").where("a <> b").distinct(), "ligacoes")
    state = _state(now)
    while True:
        former, now = now, materialize(_small_star(_large_star(now).distinct()).distinct(), "ligacoes")
        discard(former)
        before, state = state, _state(now)
        if state == before:
            break
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
