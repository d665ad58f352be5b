"""Connected components of a graph of links, as Spark jobs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut


def merge_labels(size: int, a: np.ndarray, b: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """Smallest index reachable from each of ``size`` points over the links a-b (and ``labels``)."""
    root = np.arange(size) if labels is None else labels.copy()
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
        while True:
            further = root[root]
            if np.array_equal(further, root):
                break
            root = further


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the smallest node reachable.

    Large-star and small-star steps alternate: each hangs a node's neighbours on the smallest
    of them, so the number of edges never grows and a chain shortens by a factor each round.
    The smallest neighbour comes from a partial aggregate. It is checkpointed before it meets
    the edges again, so that join is one of two plain shuffles, which AQE splits where a hub
    holds a large share of them. Links from a node to itself and repeated links do no harm; a
    null endpoint drops the link.
    """
    edges = edges.filter("a is not null and b is not null and a <> b")
    state = cut(edges.selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct())
    seen = _signature(state)
    for _ in range(max_rounds):
        both = state.unionByName(state.selectExpr("b as a", "a as b"))
        low = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")))
        large = cut(both.join(low, "a").filter("b > a").selectExpr("b as a", "low as b").distinct())
        low = cut(large.groupBy("a").agg(F.min("b").alias("low")))
        small = large.join(low, "a").filter("b <> low").selectExpr("b as a", "low as b")
        state = cut(
            small.unionByName(low.selectExpr("a", "low as b"))
            .filter("a <> b")
            .selectExpr("greatest(a, b) as a", "least(a, b) as b")
            .distinct()
        )
        now = _signature(state)
        if now == seen:
            roots = state.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)
