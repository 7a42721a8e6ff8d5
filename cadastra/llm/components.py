"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import bounded, written

#: Edges up to which one task joins the nodes by itself; more take distributed rounds.
TASK_EDGES = 1_000_000


def _joined(type: pa.DataType) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict = {}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                root.setdefault(a, a)
                root.setdefault(b, b)
                a, b = find(a), find(b)
                root[max(a, b)] = min(a, b)
        nodes = list(root)
        yield pa.record_batch([pa.array(nodes, type), pa.array([find(x) for x in nodes], type)], names=["node", "component"])

    return run


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``edges`` (a, b) to (node, component): the least node reachable.

    Nodes are long, string or binary. Rows with a null end and loops are left
    out; nodes without an edge do not appear. Each round hangs every node's
    larger neighbours, then its smaller ones, on the least node it knows, with
    minima combined before the shuffle; a hub is only the skewed side of a join.
    """
    pairs = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = written(pairs, "cc")
    n = pairs.count()
    if n <= TASK_EDGES:
        kind = pairs.schema["a"].dataType
        arrow = pa.binary() if kind.simpleString() == "binary" else pa.string() if kind.simpleString() == "string" else pa.int64()
        # a node of each edge and one of each component
        return bounded(pairs.coalesce(1).mapInArrow(_joined(arrow), f"node {kind.simpleString()}, component {kind.simpleString()}"), n)
    pairs = bounded(pairs, n)
    for _ in range(max_rounds):
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = hung.where("a != b").union(low.select("a", F.col("m").alias("b"))).distinct()
        after = bounded(written(small, "cc"))
        same = after.join(pairs, ["a", "b"], "left_anti").isEmpty() and pairs.join(after, ["a", "b"], "left_anti").isEmpty()
        pairs = after
        if same:
            break
    else:
        raise RuntimeError("components: not stable within max_rounds")
    roots = pairs.select(F.col("b").alias("a"), "b")
    return pairs.union(roots).distinct().select(F.col("a").alias("node"), F.col("b").alias("component"))
