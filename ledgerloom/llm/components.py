"""Connected components of an edge table by alternating large and small stars, all in DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.joins import lookup_join
from ledgerloom.llm.shared import cut


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a task's rows, one per node, that connect the same nodes: each node with the smallest of its tree."""
    up: dict = {}

    def root(x: object) -> object:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    kind = None
    for batch in batches:
        kind = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                up[max(a, b)] = min(a, b)
    pairs = [(x, root(x)) for x in list(up)]
    if kind is not None:
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], kind.field(k).type) for k in (0, 1)], schema=kind)


def least(edges: DataFrame) -> DataFrame:
    """For each node ``a`` the smallest of itself and its neighbours ``b``."""
    return edges.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of an edge; the component is its smallest node.

    Self-loops count as nodes; repeated edges, either direction and no edges are allowed; edges with a null end are not
    edges. Each round is a grouped minimum, joined back so that a node with very many edges is split over tasks;
    rounds end when nothing changes, after about the logarithm of the longest path. The edges, each round and
    the result are checkpointed: whatever makes the edges runs once.
    """
    start = edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
    start = cut(start.where("a is not null and b is not null").mapInArrow(_forest, start.schema).distinct())
    nodes = start.select("a").union(start.select("b")).distinct()
    now = start.where("a <> b")
    last = None
    while True:
        both = now.union(now.select("b", "a"))
        large = lookup_join(both, least(both), ["a"]).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.where("a <> b").distinct()
        smallest = least(large)
        small = lookup_join(large, smallest, ["a"]).select(F.col("b").alias("a"), F.col("least").alias("b"))
        now = cut(small.union(smallest.select("a", F.col("least").alias("b"))).where("a <> b").distinct())
        state = now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if state == last:
            break
        last = state
    return cut(nodes.withColumnRenamed("a", "node").join(now.withColumnRenamed("a", "node"), "node", "left").select("node", F.coalesce("b", "node").alias("component")))
