"""Connected components of a graph too large for one machine.

Large-star and small-star rounds: every round hangs each node below its least neighbour, edges never
outnumber what they were, and the graph becomes one star for each component in a number of rounds
that grows with the logarithm of its size.  Minima are combined before the shuffle, and the joins are plain
equi-joins that adaptive execution may split, so a node with very many neighbours is no single task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.plans.shared import materialize


class Forest:
    """Union-find of the links that one task has seen; the least node is the root."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        top = x
        while (p := parent.get(top, top)) != top:
            top = p
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    def link(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        nodes = list(self.parent)
        return np.array(nodes, np.int64), np.array([self.root(x) for x in nodes], np.int64)


EDGES = "u long, v long"


def edge_batches(forest: Forest) -> Iterator[pa.RecordBatch]:
    u, v = forest.edges()
    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _state(edges: DataFrame) -> tuple:
    got = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(got)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for every node that isn't a root itself.

    ``edges`` has columns ``u`` and ``v`` (long, not null); loops and repeated edges do no harm.
    """
    linked = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = materialize(linked.distinct())
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(moved.unionByName(small.select("u", F.col("m").alias("v"))).distinct())
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
