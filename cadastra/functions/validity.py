"""Whether rings are simple, decided on a grid of edges with exact turns; keys of equal geometry."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .geom import bound

#: Edges up to which all pairs of a shape are looked at; more are dealt to cells.
ALL_PAIRS = 24
_EPS = np.finfo(float).eps


def _turn(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Sign of the turn from a over b to c. Where rounding leaves it open, it is worked out in rational numbers."""
    one, two = (b[:, 0] - a[:, 0]) * (c[:, 1] - a[:, 1]), (b[:, 1] - a[:, 1]) * (c[:, 0] - a[:, 0])
    value = one - two
    for i in np.flatnonzero(np.abs(value) <= 8 * _EPS * (np.abs(one) + np.abs(two))).tolist():
        (ax, ay), (bx, by), (cx, cy) = ([Fraction(v) for v in p[i].tolist()] for p in (a, b, c))
        value[i] = (z := (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)) and (1 if z > 0 else -1)
    return np.sign(value)


def near_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs i < j of edges that may meet: all of a few, else those that pass through a common cell.

    There are about as many cells as edges, and an edge goes into those that it passes
    in each column, so the work is near n log n unless edges crowd into a few cells.
    """
    n = len(a)
    if n <= ALL_PAIRS:
        return np.triu_indices(n, 1)
    low, high = np.minimum(a, b), np.maximum(a, b)
    origin, extent = low.min(axis=0), np.maximum((high.max(axis=0) - low.min(axis=0)), 1e-300)
    m = int(np.ceil(np.sqrt(n)))
    width = extent / m
    first, last = (np.clip(np.floor((v[:, 0] - origin[0]) / width[0]), 0, m - 1).astype(np.int64) for v in (low, high))
    per = last - first + 1
    edge = np.repeat(np.arange(n), per)
    column = np.arange(len(edge)) - np.repeat(np.cumsum(per) - per, per) + first[edge]
    # where the edge enters and leaves the column, a little widened
    run = b[edge, 0] - a[edge, 0]
    ends = []
    for side in (column, column + 1):
        x = np.clip(origin[0] + side * width[0], low[edge, 0], high[edge, 0])
        t = np.where(run != 0, (x - a[edge, 0]) / np.where(run != 0, run, 1), 0)
        ends.append(np.where(run != 0, a[edge, 1] + t * (b[edge, 1] - a[edge, 1]), np.where(side == column, low[edge, 1], high[edge, 1])))
    slack = width[1] * 1e-6
    bottom, top = np.minimum(*ends) - slack, np.maximum(*ends) + slack
    row0, row1 = (np.clip(np.floor((v - origin[1]) / width[1]), 0, m - 1).astype(np.int64) for v in (bottom, top))
    count = row1 - row0 + 1
    which = np.repeat(np.arange(len(edge)), count)
    row = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + row0[which]
    # a border may be rounded to either side, so an edge is in the columns next to it, too
    cell = np.concatenate([(column[which] + d) * (m + 2) + row for d in (0, 1)])
    held = np.concatenate([edge[which]] * 2)
    order = np.argsort(cell, kind="stable")
    cell, held = cell[order], held[order]
    end = np.searchsorted(cell, cell, "right")
    more = end - np.arange(len(cell)) - 1
    i = np.repeat(np.arange(len(cell)), more)
    j = np.arange(len(i)) - np.repeat(np.cumsum(more) - more, more) + i + 1
    x, y = np.minimum(held[i], held[j]), np.maximum(held[i], held[j])
    pair = np.unique(x[x != y] * n + y[x != y])
    return pair // n, pair % n


def _inside(ring: np.ndarray, points: np.ndarray) -> np.ndarray:
    """By ray crossings, point by point."""
    a, b = ring[:-1], ring[1:]
    out = np.zeros(len(points), bool)
    for k, (x, y) in enumerate(points.tolist()):
        hit = (a[:, 1] > y) != (b[:, 1] > y)
        out[k] = ((a[hit, 0] + (y - a[hit, 1]) * (b[hit, 0] - a[hit, 0]) / (b[hit, 1] - a[hit, 1])) > x).sum() % 2
    return out


def _simple(rings: list[np.ndarray]) -> bool:
    """Closed rings with an area, of which no two edges have a common point but ends of neighbours, and rings that do not cross."""
    starts, ends, ring_of, place, size = [], [], [], [], []
    for k, ring in enumerate(rings):
        if len(ring) < 4 or (ring[0] != ring[-1]).any() or not np.isfinite(ring).all():
            return False
        ring = ring[np.r_[True, (ring[1:] != ring[:-1]).any(axis=1)]]
        x, y = (ring - ring[0]).T
        if len(ring) < 4 or (x[:-1] * y[1:] - x[1:] * y[:-1]).sum() == 0:
            return False
        n = len(ring) - 1
        starts.append(ring[:-1])
        ends.append(ring[1:])
        ring_of.append(np.full(n, k))
        place.append(np.arange(n))
        size.append(np.full(n, n))
    a, b = np.concatenate(starts), np.concatenate(ends)
    ring_of, place, size = np.concatenate(ring_of), np.concatenate(place), np.concatenate(size)
    i, j = near_pairs(a, b)
    meet = ((np.minimum(a[i], b[i]) <= np.maximum(a[j], b[j])) & (np.minimum(a[j], b[j]) <= np.maximum(a[i], b[i]))).all(axis=1)
    i, j = i[meet], j[meet]
    same = ring_of[i] == ring_of[j]
    step = (place[j] - place[i]) % size[i]
    after, before = same & (step == 1), same & (step == size[i] - 1)
    # neighbours may not turn back
    for p, q in ((i[after], j[after]), (j[before], i[before])):
        back = ((b[p] - a[p]) * (b[q] - a[q])).sum(axis=1) < 0
        if (back & (_turn(a[p], b[p], b[q]) == 0)).any():
            return False
    rest = ~(after | before)
    p, q, same = i[rest], j[rest], same[rest]
    t = [_turn(a[p], b[p], a[q]), _turn(a[p], b[p], b[q]), _turn(a[q], b[q], a[p]), _turn(a[q], b[q], b[p])]
    if (same & (t[0] * t[1] <= 0) & (t[2] * t[3] <= 0)).any():
        return False
    if len(rings) == 1:
        return True
    # different rings may touch in points, not cross or share a stretch
    crossing = (t[0] * t[1] < 0) & (t[2] * t[3] < 0)
    shared = np.minimum(np.maximum(a[p], b[p]), np.maximum(a[q], b[q])) - np.maximum(np.minimum(a[p], b[p]), np.minimum(a[q], b[q]))
    stretch = (t[0] == 0) & (t[1] == 0) & (shared.max(axis=1) > 0)
    if (~same & (crossing | stretch)).any():
        return False
    # where they touch, neither goes over to the other side
    touching = ~same & (t[0] * t[1] <= 0) & (t[2] * t[3] <= 0)
    for x, y in {(int(u), int(v)) for u, v in zip(ring_of[p[touching]], ring_of[q[touching]])}:
        for own, other in ((x, y), (y, x)):
            middle = (rings[other][1:] + rings[other][:-1]) / 2
            if len(set(_inside(rings[own], middle).tolist())) > 1:
                return False
    return True


def _plain(rings: np.ndarray) -> np.ndarray:
    """For rings of the same few points, all finite (rings, points, 2): 1 simple, 0 not, -1 where this does not decide.

    All pairs of edges of all rings at once. Turns that rounding leaves open are left out, unless both
    points lie on a line along an axis, where signs are those of differences.
    """
    n = rings.shape[1] - 1
    a, b = rings[:, :-1], rings[:, 1:]
    closed = (rings[:, 0] == rings[:, -1]).all(axis=1)
    local = rings - rings[:, :1]
    cross = local[:, :-1, 0] * local[:, 1:, 1] - local[:, 1:, 0] * local[:, :-1, 1]
    area = cross.sum(axis=1)
    open_ = np.abs(area) <= 8 * n * _EPS * np.abs(cross).sum(axis=1)
    open_ |= (a == b).all(axis=2).any(axis=1)  # repeated points

    def turn(p: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
        nonlocal open_
        d, e = q - p, r - p
        one, two = d[..., 0] * e[..., 1], d[..., 1] * e[..., 0]
        value = one - two
        # where a product is 0 for a factor that is, the other's sign is that of the turn, unless it came to 0 by underflow
        none, neither = (d[..., 0] == 0) | (e[..., 1] == 0), (d[..., 1] == 0) | (e[..., 0] == 0)
        exact = (none & (neither | (two != 0))) | (neither & (one != 0))
        open_ |= ((np.abs(value) <= 8 * _EPS * (np.abs(one) + np.abs(two))) & ~exact).any(axis=1)
        return np.sign(value)

    i, j = np.triu_indices(n, 1)
    low, high = np.minimum(a, b), np.maximum(a, b)
    meet = ((low[:, i] <= high[:, j]) & (low[:, j] <= high[:, i])).all(axis=2)
    near = (j - i == 1) | (j - i == n - 1)
    p, q = np.where(j - i == 1, i, j), np.where(j - i == 1, j, i)
    p, q = p[near], q[near]
    back = ((b[:, p] - a[:, p]) * (b[:, q] - a[:, q])).sum(axis=2) < 0
    bad = (back & (turn(a[:, p], b[:, p], b[:, q]) == 0)).any(axis=1)
    i, j, meet = i[~near], j[~near], meet[:, ~near]
    if len(i):
        t = [turn(a[:, i], b[:, i], a[:, j]), turn(a[:, i], b[:, i], b[:, j]), turn(a[:, j], b[:, j], a[:, i]), turn(a[:, j], b[:, j], b[:, i])]
        bad |= (meet & (t[0] * t[1] <= 0) & (t[2] * t[3] <= 0)).any(axis=1)
    return np.where(~closed, 0, np.where(open_, -1, np.where(bad, 0, 1)))


#: Points up to which rings are judged many at once, and pairs of edges that are.
PLAIN_POINTS = 12
PLAIN_PAIRS = 200_000


def _status(shapes: pa.Array) -> pa.Array:
    """Shapes of one short ring are judged by number of points, many at once; others, and those left open, one by one."""
    shapes = shapes.combine_chunks() if isinstance(shapes, pa.ChunkedArray) else shapes
    out = np.full(len(shapes), "", dtype=object)
    parts, rings = np.asarray(pc.fill_null(pc.list_value_length(shapes), -1)), shapes.flatten()
    first = np.cumsum(np.maximum(parts, 0)) - np.maximum(parts, 0)
    points, count = rings.flatten(), np.asarray(pc.fill_null(pc.list_value_length(rings), -1))
    start = np.cumsum(np.maximum(count, 0)) - np.maximum(count, 0)
    xy = np.stack([np.asarray(pc.fill_null(points.field(c), np.nan)) for c in "xy"], axis=1) if len(points) else np.zeros((0, 2))
    one = np.flatnonzero(parts == 1)
    size = count[first[one]]
    for n in np.unique(size[(size >= 4) & (size <= PLAIN_POINTS)]).tolist():
        rows, step = one[size == n], max(1, PLAIN_PAIRS // (n * n))
        for k in range(0, len(rows), step):
            some = rows[k : k + step]
            v = xy[start[first[some]][:, None] + np.arange(n)]
            whole = np.isfinite(v).all(axis=(1, 2))
            found = _plain(v[whole])
            out[some[whole]] = np.array(["invalid", "valid", ""], dtype=object)[found]
    for k in np.flatnonzero(out == "").tolist():
        out[k] = _one_status(shapes[k])
    return pa.array(out.tolist(), pa.string())


def _one_status(rings: pa.ListScalar) -> str:
    if not rings.is_valid or (len(rings) and not rings[0].is_valid):
        return "null"
    points = [np.stack([r.values.field(c).to_numpy(zero_copy_only=False) for c in "xy"], axis=1) if len(r) else np.zeros((0, 2)) for r in rings]
    return "empty" if not any(len(p) for p in points) else "valid" if _simple(points) else "invalid"


def validity(shape: Column) -> Column:
    """'null', 'empty', 'invalid' or 'valid' for a column of shapes.

    Valid rings are closed, have an area, and no two of their edges have a common point
    other than that of neighbours: no crossing, no vertex on another edge, no
    spike, no edge twice. Repeated points in a row are fine. Different rings may touch in points only.
    That holes lie in their outer ring is not looked at.
    """

    @F.arrow_udf(T.StringType())
    def run(shapes: pa.Array) -> pa.Array:
        return _status(shapes)

    return run(shape)


def ring_key(ring: Column) -> Column:
    """The same text for the same closed ring from whichever vertex and in whichever direction it is written; null without points."""
    def loose(points: Column) -> Column:
        return F.filter(points, lambda p, i: (i == 0) | (p != F.get(points, i - 1)))

    def turned(v: Column) -> Column:
        at = F.array_position(v, F.array_min(v)).cast("int")
        return bound(at, lambda k: F.concat(F.slice(v, F.greatest(k, F.lit(1)), F.size(v)), F.slice(v, F.lit(1), F.greatest(k - 1, F.lit(0)))))

    def key(open_: Column) -> Column:
        least = F.array_min(F.array(turned(open_), bound(F.reverse(open_), turned)))
        return F.when(F.size(open_) > 0, F.array_join(F.transform(least, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ","))

    points = F.transform(ring, lambda p: F.struct((p["x"] + 0.0).alias("x"), (p["y"] + 0.0).alias("y")))
    return bound(bound(points, loose), lambda v: bound(F.slice(v, F.lit(1), F.greatest(F.size(v) - 1, F.lit(0))), key))


def shape_key(shape: Column) -> Column:
    """A key of equal geometry: the digest of its rings' keys in order, so parts may come in any order, too."""
    return F.when(F.size(shape) > 0, F.md5(F.array_join(F.sort_array(F.transform(shape, ring_key)), ";").cast("binary")))
