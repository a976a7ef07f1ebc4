"""Connected components of links between long ids, as Spark joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from membervane.llm.common import staged


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable number of each of ``n`` numbers linked by the pairs ``a[i], b[i]``."""
    root = np.arange(n)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            break
        a, b, low, high = a[apart], b[apart], low[apart], high[apart]
        np.minimum.at(root, high, low)
        while True:
            upper = root[root]
            if np.array_equal(upper, root):
                break
            root = upper
    return root


def connected(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) of every node that the links ``a, b`` join to a smaller one.

    Alternates the large star and the small star: every node hands its neighbours its smallest
    neighbour, first the larger ones, then the smaller ones. A round is two aggregations and two joins
    over the links; their number never grows. Nodes with very many links are pre-aggregated for
    the minimum, and the join that follows can be split. Self links and nulls are ignored.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = staged(edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("u") != F.col("v"))).distinct(), "links")
    while True:
        # Done when every node has one smaller neighbour, which itself has none.
        ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.union(edges.select("v", F.lit(0), F.lit(1))).groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not ends.where("up > 1 or (up = 1 and down = 1)").agg(F.count(F.lit(1))).first()[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        both = edges.select(F.col("v").alias("x"), F.col("u").alias("y")).union(edges.select("u", "v"))
        lowest = staged(both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m")), "large-star")
        edges = edges.join(lowest, edges.v == lowest.x).select("u", F.col("m").alias("v"))
        edges = staged(edges.where("u != v"), "links")
        lowest = staged(edges.groupBy("u").agg(F.min("v").alias("m")), "small-star")
        moved = edges.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        edges = staged(moved.union(lowest.select("u", "m")).distinct(), "links")
