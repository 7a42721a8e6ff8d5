"""Mixing sources to target weights with Pfair scheduling.

Each source's rows are shuffled by hash and cut into blocks. While sources of
weights w last, the fluid sequence takes them in exact proportion; a source that
has run out leaves its share to the others. At virtual time v it holds
t(v) = sum of min(blocks, w * v) blocks, so block j of a source has release time
floor(t(j / w)) and deadline ceil(t((j + 1) / w)); every slot goes to the
released block with the earliest deadline. Weights are not rounded and the
schedule is one over the whole sequence. All deadlines are met, so at any slot
each source is less than one block from its fluid share.

Rows are handled by DataFrame functions only. The driver works out the schedule
from one count per source and holds a number per block; blocks grow with the
table once there are MAX_BLOCKS of them, so that does not.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import sized, written

#: Rows of a block, and blocks of a table beyond which they get larger.
BLOCK_ROWS = 64
MAX_BLOCKS = 1 << 20
#: Hash ranges that a source's rows are numbered in.
RANGES = 1024
#: Times this near to a whole number count as whole.
NEAR = 1e-6


def target_weights(rows: dict, weights: dict | None) -> dict:
    """Weights by source; without weights the square roots of the rows."""
    weights = weights if weights is not None else {s: n**0.5 for s, n in rows.items()}
    missing = [s for s in rows if weights.get(s, 0) <= 0]
    if missing:
        raise ValueError(f"sources without a positive weight: {missing[:5]}")
    return {s: weights[s] for s in rows}


def schedule(blocks: list[int], weights: list[float]) -> np.ndarray:
    """The source number at each slot, for blocks and weights by source number."""
    n, w = np.array(blocks, np.int64), np.array(weights, np.float64)
    ends = np.argsort(n / w, kind="stable")
    at = (n / w)[ends]
    full = np.cumsum(n[ends]) + at * np.maximum(w.sum() - np.cumsum(w[ends]), 0)
    jobs: list[list[np.ndarray]] = [[], [], []]
    for i in range(len(n)):
        t = np.interp(np.arange(n[i] + 1) / w[i], np.concatenate([[0.0], at]), np.concatenate([[0.0], full]))
        for o, x in zip(jobs, (np.floor(t[:-1] + NEAR), np.ceil(t[1:] - NEAR), np.full(n[i], i)), strict=True):
            o.append(x.astype(np.int64))
    release, deadline, number = (np.concatenate(o) if o else np.zeros(0, np.int64) for o in jobs)
    by_release = np.argsort(release, kind="stable")
    waiting = zip(release[by_release].tolist(), deadline[by_release].tolist(), number[by_release].tolist(), strict=True)
    following = next(waiting, None)
    out = np.zeros(len(number), np.int32)
    heap: list[tuple[int, int]] = []
    for slot in range(len(out)):
        while following is not None and (following[0] <= slot or not heap):
            heapq.heappush(heap, following[1:])
            following = next(waiting, None)
        out[slot] = heapq.heappop(heap)[1]
    return out


def mix(docs: DataFrame, id: str = "doc_id", source: str = "source", weights: dict | None = None, block_rows: int | None = None, seed: int = 0) -> DataFrame:
    """Every row of ``docs`` with block, position and place.

    ``block`` numbers the source's blocks, ``position`` is the block's place in
    the mixed sequence, ``place`` the row's in its block. A null source is a
    source of its own. Rows equal in id and source share their rank in any order;
    rows of null ids are told apart by their other columns. Columns of these
    names are replaced. An empty input gives an empty result.
    """
    spark = docs.sparkSession
    names = ("block", "position", "place")
    rest = [c for c in docs.columns if c not in names]
    counts = {r[0]: r[1] for r in docs.groupBy(F.col(f"`{source}`").cast("string")).count().collect()}
    if block_rows is None:
        block_rows = max(BLOCK_ROWS, -(-sum(counts.values()) // MAX_BLOCKS))
    order = sorted(counts, key=lambda s: (s is not None, s))
    target = target_weights(counts, weights)
    slots = schedule([-(-counts[s] // block_rows) for s in order], [target[s] for s in order])
    # block j of a source is at the j-th slot of its number
    by_number = np.argsort(slots, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(slots, minlength=len(order)))])
    columns = [slots[by_number].astype(np.int32), np.arange(len(slots)) - starts[slots[by_number]], by_number]
    slots = spark.createDataFrame(pa.table([pa.array(c) for c in columns], names=["number", "block", "position"]), "number int, block long, position long")
    slots = sized(written(slots, "schedule"))

    numbers = spark.createDataFrame([(s, i) for i, s in enumerate(order)], "_source string, number int")
    numbers = sized(written(numbers, "sources"))
    rank = F.xxhash64(F.lit(seed), F.col("_id"), F.when(F.col("_id").isNull(), F.xxhash64(*[F.col(f"c{i}") for i in range(len(rest))])))
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], F.col(f"`{id}`").alias("_id"), F.col(f"`{source}`").cast("string").alias("_own"))
    rows = rows.join(numbers, F.col("_own").eqNullSafe(F.col("_source"))).drop("_own", "_source").withColumn("rank", rank)
    rows = rows.withColumn("range", F.pmod("rank", F.lit(RANGES)).cast("int"))
    own = F.row_number().over(Window.partitionBy("number", "range").orderBy("rank", "_id"))
    held = rows.groupBy("number", "range").agg(F.count(F.lit(1)).alias("held"))
    before = F.coalesce(F.sum("held").over(Window.partitionBy("number").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = held.select("number", "range", before.alias("before"))
    ranked = rows.withColumn("own", own).join(offsets, ["number", "range"]).withColumn("nth_row", F.col("before") + F.col("own") - 1)
    block = F.floor(F.col("nth_row") / block_rows)
    ranked = ranked.withColumns({"block": block, "place": (F.col("nth_row") % block_rows).cast("int")})
    placed = ranked.join(slots, ["number", "block"])
    return placed.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], "block", "position", "place")
