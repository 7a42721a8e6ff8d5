"""Sharding into near-equal bytes by histogram sort.

Rows are written once with a number each and ordered by (key, hash of the
number), so equal rows have different order values. For each shard border a range of
order values is kept in which it must lie. Each round puts evenly spaced probes
into all ranges, counts the exact bytes and rows below every probe across
partitions, and narrows the ranges, until a probe meets each target within the
tolerance. Then rows are exchanged once, by the borders found. Shards larger
than PART_BYTES get borders inside, so no task sorts a whole one; as counts
below all borders are exact, slots need no further pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import written

#: Distance from an even border that is accepted, as a share of a shard's bytes.
TOLERANCE = 0.0005
PROBES = 32
PART_BYTES = 1 << 30
SIZE_OVERHEAD = 16

_SIGN = 1 << 63


def _codes(key: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Order values as 16 bytes that sort as the signed pair does."""
    pair = np.empty((len(key), 2), ">u8")
    pair[:, 0] = key.astype(np.int64).view(np.uint64) ^ np.uint64(_SIGN)
    pair[:, 1] = tie.astype(np.int64).view(np.uint64) ^ np.uint64(_SIGN)
    return pair.view("S16").ravel()


def _bytes(values: list[int]) -> np.ndarray:
    return np.array([v.to_bytes(16, "big") for v in values], "S16")


def _count_rows(probes: np.ndarray) -> Callable:
    """Bytes and rows from each probe up to the next, per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, len(probes) + 1), np.int64)
        for b in batches:
            at = np.searchsorted(probes, _codes(b.column("key").to_numpy(), b.column("tie").to_numpy()), "right")
            total[0] += np.bincount(at, b.column("size").to_numpy(), len(probes) + 1).astype(np.int64)
            total[1] += np.bincount(at, minlength=len(probes) + 1)
        seen = np.flatnonzero(total[1])
        yield pa.record_batch([pa.array(seen), pa.array(total[0, seen]), pa.array(total[1, seen])], names=["bin", "bytes", "rows"])

    return run


def find_borders(rows: DataFrame, targets: list[float], slack: float) -> tuple[list[int], list[int]]:
    """Order values near each target in bytes, and the exact rows below each.

    ``rows`` has key, tie and size. The driver holds a range per target and
    counts per probe, which do not grow with the rows.
    """
    low = [(0, 0, 0)] * len(targets)
    high = [(1 << 128, None, None)] * len(targets)
    best: list[tuple | None] = [None] * len(targets)
    edges = rows.agg(F.min("key"), F.max("key"), F.sum("size"), F.count("*")).first()
    total = (edges[2] or 0, edges[3])
    open_ = list(range(len(targets))) if edges[3] else []
    if edges[3]:
        low = [((edges[0] + _SIGN) << 64, 0, 0)] * len(targets)
        high = [((edges[1] + _SIGN + 1) << 64, *total)] * len(targets)
    while open_:
        probes = sorted({low[i][0] + (high[i][0] - low[i][0]) * j // (PROBES + 1) for i in open_ for j in range(1, PROBES + 1)})
        counts = rows.mapInArrow(_count_rows(_bytes(probes)), "bin long, bytes long, rows long").groupBy("bin").agg(F.sum("bytes"), F.sum("rows")).collect()
        below = np.zeros((2, len(probes) + 1), np.int64)
        for b, size, n in counts:
            below[:, b] = size, n
        below = below.cumsum(axis=1)
        known = [(p, int(below[0, i]), int(below[1, i])) for i, p in enumerate(probes)]
        places = np.array([k[1] for k in known])
        still = []
        for i in open_:
            for k in known[max(0, np.searchsorted(places, targets[i]) - 1) :]:
                if best[i] is None or abs(k[1] - targets[i]) < abs(best[i][1] - targets[i]):
                    best[i] = k
                if k[1] > targets[i]:
                    break
            inside = [k for k in known if low[i][0] < k[0] < high[i][0]]
            under = [k for k in inside if k[1] <= targets[i]]
            over = [k for k in inside if k[1] > targets[i]]
            low[i] = max([low[i], *under])
            high[i] = min([high[i], *over], key=lambda k: k[0])
            if abs(best[i][1] - targets[i]) > slack and high[i][0] - low[i][0] > 1 and high[i][2] - low[i][2] > 1:
                still.append(i)
            else:
                best[i] = min((low[i], high[i], best[i]), key=lambda k: abs(k[1] - targets[i]))
        open_ = still
    best = [b or (0, 0, 0) for b in best]
    return [b[0] for b in best], [b[2] for b in best]


def _part_rows(borders: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = np.searchsorted(borders, _codes(b.column("key").to_numpy(), b.column("tie").to_numpy()), "right")
            yield pa.record_batch([*b.columns, pa.array(part.astype(np.int32))], names=[*b.schema.names, "part"])

    return run


def shard_by_bytes(docs: DataFrame, size: str, key: str, shards: int, tolerance: float = TOLERANCE) -> DataFrame:
    """Every row of ``docs`` with shard (0 to shards - 1) and slot (gapless from 0 in its shard).

    ``key`` is an integer column; null keys come first. Rows that are equal in
    all columns have an order, too, so they do not need to stay together. All
    columns given are written once: give ids and sizes, not texts. A null size
    counts as 0. Columns shard and slot are replaced. An empty input gives an
    empty result.
    """
    rest = [c for c in docs.columns if c not in ("shard", "slot")]
    least = F.lit(-(2**63)).cast("long")
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)],
        F.coalesce(F.col(f"`{key}`").cast("long"), least).alias("key"),
        F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0).cast("long")).alias("size"),
        F.monotonically_increasing_id().alias("number"),
    )
    rows = written(rows, "rows").withColumn("tie", F.xxhash64("number")).drop("number")
    slim = rows.select("key", "tie", "size")
    total = slim.agg(F.sum("size")).first()[0] or 0
    parts = max(1, -(-total // (shards * PART_BYTES)))
    n = shards * parts
    borders, before = find_borders(slim, [total * i / n for i in range(1, n)], tolerance * total / shards)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    dealt = rows.mapInArrow(_part_rows(_bytes(borders)), f"{fields}, part int")
    first = F.lit([0, *before])
    place = F.row_number().over(Window.partitionBy("part").orderBy("key", "tie"))
    shard = F.floor(F.col("part") / parts).cast("int")
    slot = F.element_at(first, F.col("part") + 1) - F.element_at(first, shard * parts + 1) + place - 1
    return dealt.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], shard.alias("shard"), slot.cast("long").alias("slot"))
