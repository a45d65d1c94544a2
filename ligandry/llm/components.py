"""Connected components of an edge table, without ever holding a graph of unbounded size in one place."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Edges that one task may join up; beyond it rounds of hooking and pointer jumping shrink the graph first.
BOUND = 2_000_000


class UnionFind:
    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (up := self.parent.get(root, root)) != root:
            root = up
        while (up := self.parent.get(x, x)) != root:
            self.parent[x], x = root, up
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        a, b = min(a, b), max(a, b)
        self.parent.setdefault(a, a)
        self.parent[b] = a
        return True


def _join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets = UnionFind()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sets.join(a, b)
    nodes = sorted(sets.parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([sets.find(x) for x in nodes], pa.int64())], ["node", "label"])


def components(edges: DataFrame, bound: int = BOUND) -> DataFrame:
    """node, label (the smallest node of its component) of every node of the edges (a, b)."""
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    hooks: list[DataFrame] = []
    while edges.count() > bound:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "hooks")
        while True:  # every node points at a smaller one, so this ends after about log2 of the longest chain
            over = up.select(F.col("node").alias("label"), F.col("label").alias("next"))
            jumped = written(up.join(over, "label", "left").select("node", "label", F.coalesce("next", "label").alias("next")), "hooks")
            moved = not jumped.where("label <> next").isEmpty()
            up = jumped.select("node", F.col("next").alias("label"))
            if not moved:
                break
        hooks.append(up)
        a, b = up.select(F.col("node").alias("a"), F.col("label").alias("la")), up.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        moved_edges = edges.join(a, "a").join(b, "b").where("la <> lb").select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct()
        edges = written(moved_edges, "edges")
    labels = edges.coalesce(1).mapInArrow(_join_up, "node long, label long")
    for up in reversed(hooks):
        later = labels.select(F.col("node").alias("label"), F.col("label").alias("last"))
        labels = up.join(later, "label", "left").select("node", F.coalesce("last", "label").alias("label"))
    return written(labels, "labels")
