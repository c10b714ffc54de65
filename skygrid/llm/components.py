"""Connected components: a task-local forest, and distributed over an edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.llm.common import cut_lineage


class Forest:
    """Union-find over ``n`` points that remembers the links it needed."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def roots(self, idx: np.ndarray) -> np.ndarray:
        r = self.parent[idx]
        while True:
            up = self.parent[r]
            if (up == r).all():
                self.parent[idx] = r
                return r
            r = up

    def join(self, i: int, others: np.ndarray) -> None:
        roots = np.unique(self.roots(np.append(others, i)))
        if len(roots) > 1:
            self.parent[roots] = roots[0]
            self.links += [(int(roots[0]), int(x)) for x in roots[1:]]


def _priority(node: Column) -> Column:
    """A hashed order of nodes, so that no chain of ids slows contraction down."""
    return F.struct(F.xxhash64(node).alias("h"), node.alias("node"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``edges``; component = smallest node.

    Rounds of contraction: every node moves to the first of itself and its
    neighbours in a hashed order, edges are rewritten to the new nodes, and
    loops and repeats are dropped.  The number of nodes falls by a constant
    factor a round in expectation, whatever the shape of the graph.  Each
    round's tables are written to the shared folder, so a lost executor costs
    one stage, not the history.  A hub node is a hot key of inner joins only,
    which adaptive execution splits; the per-node minimum is combined before
    the shuffle.

    Null ends and self loops are ignored; repeated edges count once; an empty
    edge table gives an empty result.
    """
    pairs = cut_lineage(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
                        .where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), "edges")
    placed = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = cut_lineage(
            both.groupBy("a").agg(F.min(_priority(F.col("b"))).alias("near"))
            .select("a", F.least(F.col("near"), _priority(F.col("a")))["node"].alias("to")), "moves")
        if placed is None:
            placed = moves.select(F.col("a").alias("node"), F.col("to").alias("rep"))
        else:
            step = moves.select(F.col("a").alias("rep"), "to")
            placed = cut_lineage(placed.join(step, "rep", "left")
                                 .select("node", F.coalesce("to", "rep").alias("rep")), "placed")
        pairs = cut_lineage(
            pairs.join(moves.withColumnRenamed("to", "ta"), "a")
            .join(moves.select(F.col("a").alias("b"), F.col("to").alias("tb")), "b")
            .where("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
            .distinct(), "edges")
        if pairs.isEmpty():
            break
    smallest = placed.groupBy("rep").agg(F.min("node").alias("component"))
    return placed.join(smallest, "rep").select("node", "component")
