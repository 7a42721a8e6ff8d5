"""Footprints with holes and several parts, as column functions and one overlap kernel.

A shape is ``array`` of rings, each ``array<struct<x:double,y:double>>`` and
closed: outer rings run to the left (counter-clockwise), holes to the right, parts one
after the other (:func:`polygon`, :func:`multipolygon`). A shape is then a set of directed
edges, and areas, crossings and distances are sums or minima over all edges, so
holes cancel and parts add up by themselves. A null shape gives null, an empty one has no area and meets nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import geom
from .validity import near_pairs


def _turned(ring: Column, left: Column) -> Column:
    return F.when((geom.signed_area(ring) > 0) == left, ring).otherwise(F.reverse(ring))


def polygon(rings: Column) -> Column:
    """A shape from an outer ring and its holes, whichever way they run."""
    return F.transform(rings, lambda r, i: _turned(r, i == 0))


def multipolygon(parts: Column) -> Column:
    """A shape from several polygons, each an outer ring and its holes."""
    return F.flatten(F.transform(parts, polygon))


def from_wkt(text: Column) -> Column:
    """A shape from the text of a POLYGON or MULTIPOLYGON with any holes."""
    body = F.regexp_replace(text, r"^\s*(MULTI)?POLYGON\s*[ZM]*\s*", "")
    parts = F.split(body, r"\)\s*\)\s*,\s*\(\s*\(")

    def rings(part: Column) -> Column:
        inner = F.regexp_replace(part, r"^[(\s]+|[)\s]+$", "")
        return F.transform(F.split(inner, r"\)\s*,\s*\("), geom.ring_from_text)

    return multipolygon(F.transform(parts, rings))


def edges(shape: Column) -> Column:
    """Directed edges (a, b) of all rings."""
    return F.flatten(F.transform(shape, geom.ring_edges))


def area(shape: Column) -> Column:
    return F.abs(F.aggregate(shape, F.lit(0.0), lambda s, r: s + geom.signed_area(r)))


def centroid(shape: Column) -> Column:
    """Centre of mass, holes taken out; null where there is no area."""
    def local(own: Column, first: Column) -> Column:
        return F.transform(edges(own), lambda e: F.struct(*[F.struct(*[(e[v][c] - first[c]).alias(c) for c in "xy"]).alias(v) for v in "ab"]))

    def total(turns: Column, term) -> Column:
        return F.aggregate(turns, F.lit(0.0), lambda s, e: s + term(e["a"], e["b"]) * (e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]))

    def placed(turns: Column, first: Column) -> Column:
        six = total(turns, lambda a, b: F.lit(3.0))
        return F.struct(*[(first[c] + F.try_divide(total(turns, lambda a, b, c=c: a[c] + b[c]), six)).alias(c) for c in "xy"])

    return geom.bound(shape, lambda own: geom.bound(own[0][0], lambda first: geom.bound(local(own, first), lambda turns: placed(turns, first))))


def bbox(shape: Column) -> Column:
    return geom.bbox(F.flatten(shape))


def contains_point(shape: Column, p: Column) -> Column:
    """Crossings of a ray with all edges; points on the border may fall on either side."""
    return F.aggregate(edges(shape), F.lit(0), lambda s, e: s + geom.ray_hit(e, p)) % 2 == 1


def point_distance(shape: Column, p: Column) -> Column:
    """0 inside, else the distance to the nearest edge, that of a hole too."""
    return F.when(contains_point(shape, p), 0.0).otherwise(F.array_min(F.transform(edges(shape), lambda e: geom.edge_distance(e, p))))


def intersects(a: Column, b: Column) -> Column:
    """Whether two shapes have a common point; borders count, the inside of a hole does not."""
    other = edges(b)
    border = F.exists(edges(a), lambda s: F.exists(other, lambda t: geom.touch(s, t)))
    # without a common border point a part lies in the other shape whole or not at all
    inside = F.exists(b, lambda r: contains_point(a, r[0])) | F.exists(a, lambda r: contains_point(b, r[0]))
    return border | inside


def distance(a: Column, b: Column) -> Column:
    """0 where the shapes meet, else the least distance of a vertex of one to the other."""
    ways = F.concat(F.transform(F.flatten(a), lambda p: point_distance(b, p)), F.transform(F.flatten(b), lambda p: point_distance(a, p)))
    return F.when(intersects(a, b), 0.0).otherwise(F.array_min(ways))


#: Pairs of edges that are worked on at once.
EDGE_PAIRS = 200_000
#: Coordinates that are whole multiples of 1/GRID, on edges along the axes, give areas without any rounding.
GRID = 1024
_EPS = np.finfo(float).eps


class _Edges:
    """The edges of an Arrow column of shapes that are not upright: row, ends seen from the row's origin, and each row's area."""

    def __init__(self, shapes: pa.Array, origin: np.ndarray | None = None):
        outer, rings = np.asarray(shapes.offsets).astype(np.int64), shapes.values
        inner, points = np.asarray(rings.offsets).astype(np.int64), rings.values
        xy = np.stack([points.field(c).to_numpy(zero_copy_only=False) for c in "xy"], axis=1) if len(points) else np.zeros((0, 2))
        n = len(shapes)
        ring_row = np.repeat(np.arange(n), np.diff(outer))
        ring = np.arange(outer[0], outer[-1]) if n else outer[:0]
        if origin is None:
            # the first point of each row
            origin = np.zeros((n, 2))
            there = np.flatnonzero(np.diff(outer) > 0)
            at = inner[outer[there]]
            ok = at < inner[outer[there] + 1]
            origin[there[ok]] = xy[at[ok]]
        self.origin = origin
        count = np.maximum(inner[ring + 1] - inner[ring] - 1, 0)
        row = np.repeat(ring_row, count)
        k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(inner[ring], count)
        a, b = (xy[k] - origin[row], xy[k + 1] - origin[row]) if len(row) else (np.zeros((0, 2)),) * 2
        self.reach = np.zeros((n, 2))
        np.maximum.at(self.reach, row, np.maximum(np.abs(a), np.abs(b)))
        fit = (np.abs(a * GRID) % 1 == 0).all(axis=1) & (np.abs(origin[row] * GRID) % 1 == 0).all(axis=1) & ((a[:, 1] == b[:, 1]) | (a[:, 0] == b[:, 0]))
        self.on_grid = np.ones(n, bool)
        np.logical_and.at(self.on_grid, row, fit)
        flat = a[:, 0] != b[:, 0]
        self.row, self.a, self.b = row[flat], a[flat], b[flat]
        width = self.b[:, 0] - self.a[:, 0]
        self.count = np.bincount(self.row, minlength=n)
        self.area = np.abs(np.bincount(self.row, width * (self.a[:, 1] + self.b[:, 1]) / 2, n))
        self.slope = (self.b[:, 1] - self.a[:, 1]) / width
        self.low, self.high = np.minimum(self.a[:, 0], self.b[:, 0]), np.maximum(self.a[:, 0], self.b[:, 0])
        self.sign = np.sign(width)

    def at(self, i: np.ndarray, x: np.ndarray) -> np.ndarray:
        return self.a[i, 1] + (x - self.a[i, 0]) * self.slope[i]


def _common(a: _Edges, b: _Edges, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Common area of each row, and the widths that went into it.

    A shape is the signed sum of the columns below its edges, so the common area is that of
    the lower of two edges over their common width, summed over all pairs of edges.
    """
    begin = np.searchsorted(b.row, a.row, "left")
    per = np.searchsorted(b.row, a.row, "right") - begin
    ends = np.cumsum(per)
    total, widths = np.zeros(n), np.zeros(n)
    first = 0
    while first < len(per):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + EDGE_PAIRS, "right")))
        own = per[first:last]
        i = np.repeat(np.arange(first, last), own)
        j = np.arange(len(i)) - np.repeat(np.cumsum(own) - own, own) + np.repeat(begin[first:last], own)
        low, high = np.maximum(a.low[i], b.low[j]), np.minimum(a.high[i], b.high[j])
        met = high > low
        i, j, low, high = i[met], j[met], low[met], high[met]
        width = high - low
        f0, f1, g0, g1 = a.at(i, low), a.at(i, high), b.at(j, low), b.at(j, high)
        d0, d1 = np.abs(f0 - g0), np.abs(f1 - g1)
        crossed = (f0 - g0) * (f1 - g1) < 0
        both = np.where(crossed, d0 + d1, 1.0)
        apart = np.where(crossed, (d0 * d0 + d1 * d1) / both, d0 + d1)
        total += np.bincount(a.row[i], a.sign[i] * b.sign[j] * width * ((f0 + f1 + g0 + g1) - apart) / 4, n)
        widths += np.bincount(a.row[i], width, n)
        first = last
    return np.abs(total), widths


def _fractions(shape: list) -> tuple[list[tuple[Fraction, ...]], Fraction]:
    found, total = [], Fraction(0)
    for ring in shape:
        points = [(Fraction(p["x"]), Fraction(p["y"])) for p in ring]
        for (x0, y0), (x1, y1) in zip(points, points[1:]):
            if x0 != x1:
                found.append((x0, y0, x1, y1, (y1 - y0) / (x1 - x0)))
                total += (x1 - x0) * (y0 + y1) / 2
    return found, abs(total)


def exact_areas(a: list, b: list) -> tuple[Fraction, Fraction, Fraction]:
    """Common area of two shapes and the area of each, in rational numbers: the same sum without rounding."""
    (own, area_a), (other, area_b) = _fractions(a), _fractions(b)
    total = Fraction(0)
    for ax0, ay0, ax1, _, sa in own:
        for bx0, by0, bx1, _, sb in other:
            low, high = max(min(ax0, ax1), min(bx0, bx1)), min(max(ax0, ax1), max(bx0, bx1))
            if high <= low:
                continue
            f0, f1, g0, g1 = (y + (x - x0) * s for x0, y, s in ((ax0, ay0, sa), (bx0, by0, sb)) for x in (low, high))
            d0, d1 = f0 - g0, f1 - g1
            apart = (d0 * d0 + d1 * d1) / (abs(d0) + abs(d1)) if d0 * d1 < 0 else abs(d0) + abs(d1)
            total += (1 if (ax1 > ax0) == (bx1 > bx0) else -1) * (high - low) * (f0 + f1 + g0 + g1 - apart) / 4
    return abs(total), area_a, area_b


def _overlaps(a: pa.Array, b: pa.Array, limits: list[Fraction]) -> pa.Array:
    n = len(a)
    own = _Edges(a)
    other = _Edges(b, own.origin)
    area, widths = _common(own, other, n)
    pairs = own.count * other.count
    reach = np.maximum(own.reach, other.reach)
    size = np.maximum(1, max([1, *(max(x.numerator, x.denominator) for x in limits)]))
    exact = own.on_grid & other.on_grid & (reach[:, 0] * reach[:, 1] * (pairs + own.count + other.count) * size < 2.0**53 / GRID**2 / 4)
    off = np.where(exact, 0.0, _EPS * reach[:, 1] * ((64 + pairs) * widths + 16 * (pairs + 4) * reach[:, 0]))
    off_own, off_other = (np.where(exact, 0.0, _EPS * (64 + x.count) * 8 * reach[:, 0] * reach[:, 1] * np.maximum(x.count, 1)) for x in (own, other))
    smaller, off_smaller = np.minimum(own.area, other.area), np.maximum(off_own, off_other)
    size_diff = own.area - other.area
    larger = np.sign(size_diff)
    doubt = (np.abs(size_diff) <= off_own + off_other) & ~exact & (pairs > 0)
    sides = []
    for limit in limits:
        p, q = limit.numerator, limit.denominator
        diff = q * area - p * smaller
        off_diff = q * off + p * off_smaller + np.where(exact, 0.0, 4 * _EPS * (q * area + p * smaller) if p else 0.0)
        sides.append(np.sign(diff))
        doubt |= (np.abs(diff) <= off_diff) & ~exact & (pairs > 0)
    rows = np.flatnonzero(doubt)
    for k, (x, y) in zip(rows.tolist(), zip(a.take(pa.array(rows)).to_pylist(), b.take(pa.array(rows)).to_pylist(), strict=True), strict=True):
        common, area_a, area_b = exact_areas(x, y)
        area[k], smaller[k] = float(common), float(min(area_a, area_b))
        larger[k] = (area_a > area_b) - (area_a < area_b)
        for side, limit in zip(sides, limits, strict=True):
            bound = limit * min(area_a, area_b)
            side[k] = (common > bound) - (common < bound)
    offsets = pa.array(np.arange(0, len(limits) * n + 1, max(len(limits), 1))[: n + 1] if limits else np.zeros(n + 1), pa.int32())
    flat = np.stack(sides, axis=1).ravel() if limits else np.zeros(0)
    found = pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int8), pa.int8()))
    return pa.StructArray.from_arrays([pa.array(area), pa.array(larger.astype(np.int8), pa.int8()), found, pa.array(smaller)], names=["area", "larger", "sides", "smaller"])


def overlap(a: Column, b: Column, limits: Sequence[str] = ("0",)) -> Column:
    """Struct of area (common), larger, sides and smaller (the smaller shape's area).

    ``sides`` tells for each limit (a decimal number as text) whether the common area is above (1), at
    (0) or below (-1) that share of the smaller shape's area; ``larger`` whether a's
    area is larger (1), equal or smaller than b's. Every sum has a bound on its
    rounding; where it leaves a sign open, the pair is worked out again in
    rational numbers, so all signs are exact, and area is then the nearest double. Only the two shapes go to
    Python, a batch at once; they are columns that a join or a read has made, as Spark
    does not send nested lambdas of the same projection there. A null shape gives a null struct.
    """
    bounds = [Fraction(x) for x in limits]

    @F.arrow_udf("area double, larger tinyint, sides array<tinyint>, smaller double")
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        there = pc.and_(x.is_valid(), y.is_valid())
        if pc.all(there).as_py() is not False:
            return _overlaps(x, y, bounds)
        found = _overlaps(x.filter(there), y.filter(there), bounds)
        place = np.cumsum(there.to_numpy(zero_copy_only=False)) - 1
        return found.take(pc.if_else(there, pa.array(place), None))

    return run(a, b)


def _union_area(rings: list) -> float:
    """Area that any part covers: between neighbouring corners and crossings, edges lie one above the other, and what has a positive winding is covered."""
    points = [np.array([(p["x"], p["y"]) for p in r]) for r in rings if len(r) > 1]
    if not points:
        return 0.0
    origin = points[0][0]
    a, b = (np.concatenate([(r - origin)[s] for r in points]) for s in (slice(None, -1), slice(1, None)))
    flat = a[:, 0] != b[:, 0]
    a, b = a[flat], b[flat]
    if not len(a):
        return 0.0
    slope = (b[:, 1] - a[:, 1]) / (b[:, 0] - a[:, 0])
    low, high, sign = np.minimum(a[:, 0], b[:, 0]), np.maximum(a[:, 0], b[:, 0]), np.sign(b[:, 0] - a[:, 0])
    start = a[:, 1] - slope * a[:, 0]
    i, j = near_pairs(a, b)
    meet = (np.maximum(low[i], low[j]) < np.minimum(high[i], high[j])) & (slope[i] != slope[j])
    i, j = i[meet], j[meet]
    x = (start[j] - start[i]) / (slope[i] - slope[j])
    x = x[(x > np.maximum(low[i], low[j])) & (x < np.minimum(high[i], high[j]))]
    total, borders = 0.0, np.unique(np.concatenate([low, high, x]))
    for x0, x1 in zip(borders, borders[1:]):
        there = np.flatnonzero((low <= x0) & (high >= x1))
        middle = a[there, 1] + ((x0 + x1) / 2 - a[there, 0]) * slope[there]
        order = np.argsort(middle, kind="stable")
        covered = np.cumsum(sign[there[order]])[:-1] > 0
        total += (x1 - x0) * float(np.diff(middle[order])[covered].sum())
    return total


def union_area(shape: Column) -> Column:
    """Area that the parts of a shape cover together, stretches that several of them cover counted once; null for a null shape."""

    @F.arrow_udf(T.DoubleType())
    def run(shapes: pa.Array) -> pa.Array:
        return pa.array([None if s is None else _union_area(s) for s in shapes.to_pylist()], pa.float64())

    return run(shape)
