"""Approximate nearest neighbours by inner product: NN-descent graph and greedy search.

Equal vectors are one node. Nodes get one coordinate more, so that all have the
same length and the largest inner product is the nearest. The graph starts from
brute force within small groups cut by random projections; then each round joins
the neighbours of every node with each other, and pairs that beat a node's worst
neighbour enter its list. An edge stays fresh at either end until it was joined
there, and rounds go on until few edges change. A query's pool of nodes starts
with the list of its own node and grows by the neighbours of its best nodes not yet
looked at, until all of it is looked at; a node is scored once a query.

Hubs: a node joins, and a search goes on to, a fixed number of the nodes that have it
in their lists. Both are picked before the shuffle, so a hub sends few rows a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import written

#: Neighbours of a node in the graph.
DEGREE = 48
#: Random cuts at the start and the nodes of a group.
CUTS = 8
GROUP = 1024
#: Share of new edges in a round of NN-descent at which the graph counts as stable.
DELTA = 0.04
#: Half the fresh, and half the other, neighbours that a node joins in a round.
JOINED = 20
#: Nearest of a node's neighbours that a search goes on to, and as many of those that have it among theirs.
LINKED = 24
#: Best nodes of a query that stay in its pool, and those expanded in a hop.
POOL = 96
EXPANDED = 32
#: Entry nodes of queries that are not in the graph.
ENTRIES = 64


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, v) of rows with an id whose vector has only finite components and is not zero, of the commonest length."""
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id}`").cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null and size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (common["d"] if common else 0))


def _grouped_rows(cuts: int, dimensions: int, bits: int) -> Callable:
    """A row per node and cut: the side of ``bits`` random planes, and a place along one more direction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(7).standard_normal((cuts, bits + 1, dimensions))
        for b in batches:
            x = matrix(b.column("x"))
            for cut in range(cuts):
                side = x @ planes[cut].T
                bucket = (side[:, :bits] > 0) @ (1 << np.arange(bits)).astype(np.int64) if bits else np.zeros(len(x), np.int64)
                yield pa.record_batch([b.column("node"), b.column("x"), pa.array(np.full(len(x), cut)), pa.array(bucket), pa.array(side[:, bits])], names=["node", "x", "cut", "bucket", "along"])

    return run


def _top_pairs(node: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    score = (x @ x.T).astype(np.float64)
    np.fill_diagonal(score, -np.inf)
    k = min(k, len(node) - 1)
    best = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return np.repeat(node, k), node[best].ravel(), np.take_along_axis(score, best, 1).ravel()


def _group_pairs(k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for members in b.column("members"):
                own = members.values
                if len(own) > 1:
                    a, c, s = _top_pairs(own.field("node").to_numpy(), matrix(own.field("x")), k)
                    yield pa.record_batch([pa.array(a), pa.array(c), pa.array(s)], names=["node", "near", "score"])

    return run


def _joined_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of a node's sampled neighbours with a fresh one that beat the worst neighbour of either."""
    for b in batches:
        out: list[list[np.ndarray]] = [[], [], []]
        for members in b.column("members"):
            own = members.values
            node, fresh, worst = (own.field(c).to_numpy(zero_copy_only=False) for c in ("node", "fresh", "worst"))
            x = matrix(own.field("x"))
            score = (x @ x.T).astype(np.float64)
            new = (fresh[:, None] | fresh[None, :]) & (score > worst[:, None]) & (node[:, None] != node[None, :])
            i, j = np.nonzero(new)
            for o, c in zip(out, (node[i], node[j], score[i, j]), strict=True):
                o.append(c)
        yield pa.record_batch([pa.array(np.concatenate(o) if o else []) for o in out], schema=pa.schema([("node", pa.int64()), ("near", pa.int64()), ("score", pa.float64())]))


def _best(rows: DataFrame, by: str, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), "near"))
    return rows.withColumn("place", place).where(F.col("place") <= k).drop("place")


def build_graph(nodes: DataFrame, degree: int = DEGREE, delta: float = DELTA) -> DataFrame:
    """(node, near, score) with at most ``degree`` neighbours a node; ``nodes`` has node and x.

    Rounds end when at most ``delta`` of the edges are new. Lists only improve, so they do end.
    """
    first = nodes.select(F.size("x").alias("d")).first()
    n = nodes.count()
    dimensions, bits = first["d"] if first else 1, max(0, int(np.log2(max(1, n / GROUP))))
    dealt = nodes.mapInArrow(_grouped_rows(CUTS, dimensions, bits), "node long, x array<float>, cut long, bucket long, along double")
    place = F.row_number().over(Window.partitionBy("cut", "bucket").orderBy("along", "node"))
    size = F.count(F.lit(1)).over(Window.partitionBy("cut", "bucket"))
    groups = dealt.withColumns({"place": place, "size": size})
    group = F.floor((F.col("place") - 1) / F.ceil(F.col("size") / F.ceil(F.col("size") / GROUP)))
    groups = groups.groupBy("cut", "bucket", group.alias("group")).agg(F.collect_list(F.struct("node", "x")).alias("members"))
    pairs = groups.select("members").mapInArrow(_group_pairs(degree), "node long, near long, score double")
    # fresh: not yet joined at node; back: not yet joined at near
    graph = _best(pairs.distinct(), "node", degree).withColumns({"fresh": F.lit(True), "back": F.lit(True), "new": F.lit(True)})
    graph = written(graph, "graph")
    r = 0
    while True:
        ends = graph.select(F.col("node").alias("center"), F.col("near").alias("node"), "fresh").union(graph.select(F.col("near").alias("center"), "node", F.col("back").alias("fresh")))
        mixed = F.row_number().over(Window.partitionBy("center", "fresh").orderBy(F.xxhash64("center", "node", F.lit(r))))
        members = ends.groupBy("center", "node").agg(F.max("fresh").alias("fresh")).withColumn("place", mixed).where(F.col("place") <= 2 * JOINED)
        members = written(members.select("center", "node", "fresh"), "members")
        worst = graph.groupBy("node").agg(F.when(F.count(F.lit(1)) >= degree, F.min("score")).otherwise(float("-inf")).alias("worst"))
        facts = nodes.join(worst, "node", "left").select("node", "x", F.coalesce("worst", F.lit(float("-inf"))).alias("worst"))
        each = members.join(facts, "node").groupBy("center").agg(F.collect_list(F.struct("node", "fresh", "worst", "x")).alias("members"))
        found = each.select("members").mapInArrow(_joined_pairs, "node long, near long, score double").withColumns({"fresh": F.lit(True), "back": F.lit(True), "new": F.lit(True)})
        # a flag is cleared only where its edge was among the members just joined
        joined = members.where("fresh")
        here = joined.select(F.col("center").alias("node"), F.col("node").alias("near"), F.lit(False).alias("fresh"), F.lit(True).alias("back"))
        there = joined.select("node", F.col("center").alias("near"), F.lit(True).alias("fresh"), F.lit(False).alias("back"))
        cleared = here.union(there).select("node", "near", F.lit(None).cast("double").alias("score"), "fresh", "back", F.lit(True).alias("new"))
        kept = graph.withColumn("new", F.lit(False))
        both = kept.union(found.select(*kept.columns)).union(cleared.select(*kept.columns)).groupBy("node", "near")
        both = both.agg(F.max("score").alias("score"), *[F.min(c).alias(c) for c in ("fresh", "back", "new")]).where("score is not null")
        graph = written(_best(both, "node", degree), "graph")
        r += 1
        size = graph.agg(F.count(F.lit(1)), F.count_if("new")).first()
        if size[1] <= delta * size[0]:
            break
    return graph.select("node", "near", "score")


def _score_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        score = np.einsum("ij,ij->i", matrix(b.column("q")), matrix(b.column("x")), dtype=np.float64)
        yield pa.record_batch([b.column("query"), b.column("near"), pa.array(score)], names=["query", "near", "score"])


def _scored(pairs: DataFrame, queries: DataFrame, nodes: DataFrame) -> DataFrame:
    sides = pairs.join(nodes.select(F.col("node").alias("near"), "x"), "near").join(queries.select("query", "q"), "query")
    return sides.select("query", "near", "q", "x").mapInArrow(_score_rows, "query long, near long, score double")


def _links(graph: DataFrame) -> DataFrame:
    """(node, near): the LINKED best neighbours of each node, and the LINKED best nodes that have it among theirs."""
    own = _best(graph.select("node", "near", "score"), "node", LINKED)
    back = _best(own.select(F.col("near").alias("node"), F.col("node").alias("near"), "score"), "node", LINKED)
    return own.union(back).select("node", "near").distinct()


def search_graph(queries: DataFrame, nodes: DataFrame, graph: DataFrame, pool: int = POOL) -> tuple[DataFrame, DataFrame]:
    """(query, near, score): each query's best nodes found; and (query, near) of all pairs scored.

    ``queries`` has query, q and node, its own node or null.
    """
    links = written(_links(graph), "links")
    entries = nodes.select("node").orderBy(F.xxhash64("node"), "node").limit(ENTRIES).withColumn("one", F.lit(1))
    foreign = queries.where("node is null").select("query", F.lit(1).alias("one")).join(F.broadcast(entries), "one").select("query", F.col("node").alias("near"))
    known = queries.where("node is not null").select("query", "node")
    start = known.withColumnRenamed("node", "near").union(known.join(graph, "node").select("query", "near")).union(foreign)
    new = written(_scored(start.distinct(), queries, nodes), "scored")
    scored = new.select("query", "near")
    found = new.withColumn("seen", F.lit(False))
    while True:
        place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "near"))
        found = found.withColumn("place", place).where(F.col("place") <= pool).drop("place")
        turn = F.row_number().over(Window.partitionBy("query", "seen").orderBy(F.desc("score"), "near"))
        found = written(found.withColumn("next", ~F.col("seen") & (turn <= EXPANDED)), "pool")
        frontier = found.where("next").select("query", F.col("near").alias("node"))
        if frontier.isEmpty():
            break
        near = frontier.join(links, "node").select("query", "near").distinct().join(scored, ["query", "near"], "left_anti")
        new = written(_scored(near, queries, nodes), "scored")
        scored = scored.union(new.select("query", "near"))
        found = found.select("query", "near", "score", (F.col("seen") | F.col("next")).alias("seen")).union(new.withColumn("seen", F.lit(False)))
    return found.select("query", "near", "score"), scored


def nearest(vectors: DataFrame, is_query, id: str = "vec_id", vector: str = "embedding", k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k nearest other rows found, ties to the smaller id.

    ``is_query`` is a condition on ``id``. Rows without an id, or whose vector is
    null, zero, of an uncommon length or holds null or non-finite components take
    no part. Of rows with the same id and vector one counts. Fewer than k
    candidates give fewer rows.
    """
    rows = usable(vectors, id, vector).distinct().withColumn("key", F.unhex(F.md5(F.array_join(F.col("v").cast("array<string>"), ",").cast("binary"))))
    place = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    # enough of each group of equal vectors to fill an answer, besides the query itself
    members = written(rows.withColumn("place", place).where(F.col("place") <= k + 1), "members")
    longest = members.where("place = 1").agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0] or 1.0
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    extra = F.sqrt(F.greatest(F.lit(0.0), F.lit(longest) - norm))
    nodes = members.where("place = 1").select(F.col("id").alias("node"), "key", F.concat("v", F.array(extra)).cast("array<float>").alias("x"))
    nodes = written(nodes, "nodes")
    graph = build_graph(nodes.select("node", "x"))
    flat = F.concat("v", F.array(F.lit(0.0))).cast("array<float>")
    queries = rows.where(is_query).select(F.col("id").alias("query"), flat.alias("q"), "key", "v").join(nodes.select("key", "node"), "key")
    queries = written(queries, "queries")
    # one search for equal queries
    asked = queries.groupBy("node").agg(F.first("q").alias("q")).select(F.col("node").alias("query"), "q", "node")
    pool, _ = search_graph(asked, nodes, graph)
    close = _best(pool, "query", 2 * k + 1).select(F.col("query").alias("node"), F.col("near").alias("hit"))
    answers = queries.select("query", "v", "node").join(close, "node")
    held = members.select("key", F.col("id").alias("vec_id"), F.col("v").alias("w")).join(nodes.select("key", F.col("node").alias("hit")), "key")
    exact = F.aggregate(F.zip_with("v", "w", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    pairs = answers.join(held, "hit").where("query != vec_id").select("query", "vec_id", exact.alias("score"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")
