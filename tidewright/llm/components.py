"""Connected components of a distributed edge table by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of one task reduced to (node, smallest node reachable) with node != smallest."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for end in (a, b, root[a], root[b]):
            np.minimum.at(new, end, low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b), bigint -> (node, root): every node of an edge that isn't itself the
    smallest node of its component, with that smallest node.

    Each round hooks neighbours to neighbourhood minima; a hub's edges are only joined to one
    row, never gathered. Rounds are written to the shared folder, so a lost executor costs no
    more than a round; the number of rounds grows with the logarithm of a component's size.
    """
    now = settle(_oriented(edges, "a", "b"), "edges")
    mark = None
    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _oriented(both.where("v > u").join(low, "u"), "v", "m")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        new = _oriented(small.select("b", "m").union(least.select("a", "m")), "b", "m")
        now = settle(new, "edges")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = seen


def _oriented(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct edges with the larger node as a; loops are left out."""
    return (
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct()
    )
