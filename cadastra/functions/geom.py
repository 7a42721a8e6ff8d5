"""Polygons as arrays of points: geometry as column functions.

A ring is ``array<struct<x:double,y:double>>``, closed, the outer one first in a
polygon (``array`` of rings). Sums start from the first vertex to keep digits.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RING = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def rectangle(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    return F.array(point(xmin, ymin), point(xmax, ymin), point(xmax, ymax), point(xmin, ymax), point(xmin, ymin))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once a row: an expression that occurs several times, or in a lambda, is worked out each time."""
    return F.transform(F.array(value), use)[0]


def _pairs(first: Column, second: Column) -> Column:
    return F.zip_with(first, second, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def edges(ring: Column) -> Column:
    """Consecutive vertices as (a, b), seen from the first vertex."""
    first, n = ring[0], F.size(ring)
    local = F.transform(ring, lambda p: F.struct((p["x"] - first["x"]).alias("x"), (p["y"] - first["y"]).alias("y")))
    return _pairs(F.slice(local, F.lit(1), n - 1), F.slice(local, F.lit(2), n - 1))


def _sum(array: Column, term) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda s, e: s + term(e["a"], e["b"]))


def signed_area(ring: Column) -> Column:
    def turns(r: Column) -> Column:
        x, y, n = r[0]["x"], r[0]["y"], F.size(r) - 1
        return F.zip_with(F.slice(r, F.lit(1), n), F.slice(r, F.lit(2), n), lambda a, b: (a["x"] - x) * (b["y"] - y) - (b["x"] - x) * (a["y"] - y))

    return bound(ring, lambda r: F.aggregate(turns(r), F.lit(0.0), lambda s, v: s + v) / 2)


def area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


def polygon_area(rings: Column) -> Column:
    """Area of the outer ring less that of the holes."""
    return bound(rings, lambda own: F.aggregate(F.slice(own, F.lit(2), F.size(own)), area(own[0]), lambda s, r: s - area(r)))


def centroid(ring: Column) -> Column:
    def parts(first: Column, e: Column, a6: Column) -> Column:
        def part(axis: str) -> Column:
            total = _sum(e, lambda a, b: (a[axis] + b[axis]) * (a["x"] * b["y"] - b["x"] * a["y"]))
            return first[axis] + F.try_divide(total, a6)

        return F.struct(part("x").alias("x"), part("y").alias("y"))

    def measured(r: Column, e: Column) -> Column:
        six = _sum(e, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]) / 2 * 6
        return bound(six, lambda a6: parts(r[0], e, a6))

    return bound(ring, lambda r: bound(edges(r), lambda e: measured(r, e)))


def bbox(ring: Column) -> Column:
    def box(xs: Column, ys: Column) -> Column:
        return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))

    return bound(ring, lambda r: bound(r["x"], lambda xs: bound(r["y"], lambda ys: box(xs, ys))))


def drop_z(ring: Column) -> Column:
    return F.transform(ring, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))


def to_wkt(ring: Column) -> Column:
    points = F.transform(ring, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))
    return F.concat(F.lit("POLYGON (("), F.array_join(points, ", "), F.lit("))"))


def from_wkt(text: Column) -> Column:
    """Rings of a POLYGON text; a MULTIPOLYGON gives the rings of all its parts. Numbers beyond x and y are dropped."""
    inner = F.regexp_extract_all(text, F.lit(r"\(([^()]+)\)"), F.lit(1))
    return F.transform(inner, ring_from_text)


def ring_from_text(text: Column) -> Column:
    """Points of a text of numbers; those beyond x and y are dropped."""
    def one(p: Column) -> Column:
        return bound(F.split(F.trim(p), " "), lambda n: F.struct(F.get(n, F.lit(0)).try_cast("double").alias("x"), F.get(n, F.lit(1)).try_cast("double").alias("y")))

    # blanks are made one beforehand: a split at a single character needs no pattern for every point
    return F.transform(F.split(F.regexp_replace(text, r"\s+", " "), ","), one)


def multi_parts(text: Column) -> Column:
    """Outer ring of each part of a WKT (multi)polygon."""
    parts = F.split(F.regexp_replace(text, r"^\s*(MULTI)?POLYGON\s*", ""), r"\)\s*\)\s*,\s*\(\s*\(")
    return F.transform(parts, lambda p: ring_from_text(F.regexp_extract(F.regexp_replace(p, r"^[(\s]+", ""), r"^([^()]+)", 1)))


def _cross(a: Column, b: Column, c: Column) -> Column:
    return (b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"])


def ring_edges(ring: Column) -> Column:
    """Consecutive vertices as (a, b)."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return _pairs(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n))


def ray_hit(e: Column, p: Column) -> Column:
    """1 where the ray to the right of a point crosses an edge, else 0."""
    a, b = e["a"], e["b"]
    at = a["x"] + F.try_divide((p["y"] - a["y"]) * (b["x"] - a["x"]), b["y"] - a["y"])
    return F.when(((a["y"] > p["y"]) != (b["y"] > p["y"])) & (p["x"] < at), 1).otherwise(0)


def edge_distance(e: Column, p: Column) -> Column:
    a, b = e["a"], e["b"]
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    t = F.coalesce(F.try_divide((p["x"] - a["x"]) * dx + (p["y"] - a["y"]) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), t))
    return F.hypot(p["x"] - a["x"] - t * dx, p["y"] - a["y"] - t * dy)


def box_overlap(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Common area of two axis-aligned rectangles."""
    w = F.least(a["xmax"], b["xmax"]) - F.greatest(a["xmin"], b["xmin"])
    h = F.least(a["ymax"], b["ymax"]) - F.greatest(a["ymin"], b["ymin"])
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def ell(xmin: Column, ymin: Column, xmax: Column, ymax: Column, nx: Column, ny: Column) -> Column:
    """A rectangle without its corner beyond (nx, ny)."""
    return F.array(point(xmin, ymin), point(xmax, ymin), point(xmax, ny), point(nx, ny), point(nx, ymax), point(xmin, ymax), point(xmin, ymin))


def touch(s: Column, t: Column) -> Column:
    """Whether two segments have a common point, ends included."""

    def between(a: Column, b: Column, p: Column) -> Column:
        return (p["x"] >= F.least(a["x"], b["x"])) & (p["x"] <= F.greatest(a["x"], b["x"])) & (p["y"] >= F.least(a["y"], b["y"])) & (p["y"] <= F.greatest(a["y"], b["y"]))

    ends = [(s, t["a"]), (s, t["b"]), (t, s["a"]), (t, s["b"])]
    on = [(_cross(e["a"], e["b"], p) == 0) & between(e["a"], e["b"], p) for e, p in ends]
    cross = (_cross(s["a"], s["b"], t["a"]) * _cross(s["a"], s["b"], t["b"]) < 0) & (_cross(t["a"], t["b"], s["a"]) * _cross(t["a"], t["b"], s["b"]) < 0)
    return on[0] | on[1] | on[2] | on[3] | cross


@F.pandas_udf(T.BinaryType())
def to_wkb(rings: pd.Series) -> pd.Series:
    """Rings as a little-endian WKB polygon."""

    def one(polygon) -> bytes | None:
        if polygon is None:
            return None
        body = [struct.pack("<BII", 1, 3, len(polygon))]
        for ring in polygon:
            body.append(struct.pack("<I", len(ring)))
            body += [struct.pack("<dd", p["x"], p["y"]) for p in ring]
        return b"".join(body)

    return rings.map(one)


@F.pandas_udf(T.ArrayType(_RING))
def from_wkb(data: pd.Series) -> pd.Series:
    """Rings of a little-endian WKB polygon; other geometries are null."""

    def one(b: bytes | None):
        if b is None or b[0] != 1 or struct.unpack_from("<I", b, 1)[0] != 3:
            return None
        rings, at = [], 9
        for _ in range(struct.unpack_from("<I", b, 5)[0]):
            n = struct.unpack_from("<I", b, at)[0]
            values = struct.unpack_from(f"<{2 * n}d", b, at + 4)
            rings.append([{"x": x, "y": y} for x, y in zip(values[::2], values[1::2], strict=True)])
            at += 4 + 16 * n
        return rings

    return data.map(one)


#: The GRS80 ellipsoid and the origin of EPSG:3035.
_A, _F = 6378137.0, 1 / 298.257222101
_LAT0, _LON0, _X0, _Y0 = math.radians(52.0), math.radians(10.0), 4321000.0, 3210000.0
_E2 = _F * (2 - _F)
_E = math.sqrt(_E2)


def _q(sin: float) -> float:
    return (1 - _E2) * (sin / (1 - _E2 * sin * sin) - math.log((1 - _E * sin) / (1 + _E * sin)) / (2 * _E))


_QP = _q(1.0)
_B0 = math.asin(_q(math.sin(_LAT0)) / _QP)
_RQ = _A * math.sqrt(_QP / 2)
_D = _A * (math.cos(_LAT0) / math.sqrt(1 - _E2 * math.sin(_LAT0) ** 2)) / (_RQ * math.cos(_B0))


def to_lonlat(x: Column, y: Column) -> Column:
    """EPSG:3035 metres to degrees, by the inverse of the Lambert azimuthal equal-area projection.

    x and y occur many times, so they should be columns of the frame.
    """
    u, v = (x - _X0) / _D, _D * (y - _Y0)
    rho = F.hypot(u, v)
    c = 2 * F.asin(rho / (2 * _RQ))
    beta = F.when(rho == 0, F.lit(_B0)).otherwise(F.asin(F.cos(c) * math.sin(_B0) + F.try_divide(v * F.sin(c) * math.cos(_B0), rho)))
    lon = _LON0 + F.atan2((x - _X0) * F.sin(c), _D * rho * math.cos(_B0) * F.cos(c) - _D * _D * (y - _Y0) * math.sin(_B0) * F.sin(c))
    e4, e6 = _E2**2, _E2**3
    lat = beta + (_E2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta) + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta) + (761 * e6 / 45360) * F.sin(6 * beta)
    return F.struct(F.degrees(F.when(rho == 0, F.lit(_LON0)).otherwise(lon)).alias("lon"), F.degrees(lat).alias("lat"))


def to_laea(lon: Column, lat: Column) -> Column:
    """Degrees to EPSG:3035 metres."""
    s = F.sin(F.radians(lat))
    q = (1 - _E2) * (s / (1 - _E2 * s * s) - F.ln((1 - _E * s) / (1 + _E * s)) / (2 * _E))
    beta, d = F.asin(q / _QP), F.radians(lon) - _LON0
    b = _RQ * F.sqrt(2 / (1 + math.sin(_B0) * F.sin(beta) + math.cos(_B0) * F.cos(beta) * F.cos(d)))
    x = _X0 + b * _D * F.cos(beta) * F.sin(d)
    y = _Y0 + b / _D * (math.cos(_B0) * F.sin(beta) - math.sin(_B0) * F.cos(beta) * F.cos(d))
    return F.struct(x.alias("x"), y.alias("y"))


def cell(x: Column, size: float) -> Column:
    return F.floor(x / size).cast("long")


def curve_key(x: Column, y: Column, size: float) -> Column:
    """Place of a point's cell on a Z-shaped curve: bits of both cell numbers in turn, 31 of each; neighbours mostly have near keys."""

    def spread(v: Column) -> Column:
        v = (v + 2**30).bitwiseAND(F.lit(2**31 - 1))
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return spread(cell(x, size)).bitwiseOR(F.shiftleft(spread(cell(y, size)), 1))
