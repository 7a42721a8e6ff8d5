"""Geometry against shapes whose values are known."""

import math

import pytest
from pyspark.sql import functions as F

from cadastra.functions import geom, shape
from cadastra.functions.validity import ring_key, shape_key, validity
from cadastra.operators import units

SHAPES = {
    "square": "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))",
    "ell": "POLYGON ((0 0, 6 0, 6 2, 2 2, 2 6, 0 6, 0 0))",
    "triangle": "POLYGON ((0 0, 4 0, 0 4, 0 0))",
    "bow": "POLYGON ((0 0, 4 4, 4 0, 0 4, 0 0))",
    "open": "POLYGON ((0 0, 4 0, 4 4, 0 4))",
    "far": "POLYGON ((4000000 3000000, 4000003 3000000, 4000003 3000003, 4000000 3000003, 4000000 3000000))",
}


@pytest.fixture(scope="module")
def shapes(spark):
    rows = spark.createDataFrame(list(SHAPES.items()), "name string, wkt string")
    return rows.select("name", geom.from_wkt(F.col("wkt"))[0].alias("ring"))


def values(df, col):
    return {r[0]: r[1] for r in df.select("name", col).collect()}


def test_area_and_centroid(shapes):
    areas = values(shapes, geom.area(F.col("ring")))
    assert (areas["square"], areas["ell"], areas["triangle"], areas["far"]) == (16, 20, 8, 9)
    c = values(shapes, geom.centroid(F.col("ring")))
    assert (c["square"]["x"], c["square"]["y"]) == (2, 2)
    assert math.isclose(c["triangle"]["x"], 4 / 3)
    assert math.isclose(c["far"]["x"], 4000001.5)


def test_validity(shapes):
    v = values(shapes.cache(), validity(F.array("ring")))
    assert v == {"square": "valid", "ell": "valid", "triangle": "valid", "bow": "invalid", "open": "invalid", "far": "valid"}


FAULTS = {
    "spike": "POLYGON ((0 0, 4 0, 9 0, 4 0, 4 4, 0 4, 0 0))",
    "spike on a side": "POLYGON ((0 0, 4 0, 4 4, 2 4, 2 7, 2 4, 0 4, 0 0))",
    "vertex on an edge": "POLYGON ((0 0, 4 0, 4 4, 2 0, 0 4, 0 0))",
    "vertex on a slanted edge": "POLYGON ((0 0, 9 3, 9 9, 3 1, 0 9, 0 0))",
    "edge twice": "POLYGON ((0 0, 4 0, 4 4, 0 4, 4 4, 0 4, 0 0))",
    "eight": "POLYGON ((0 0, 2 2, 4 0, 4 4, 2 2, 0 4, 0 0))",
    "flat": "POLYGON ((0 0, 4 0, 2 0, 0 0))",
    "hole across": "POLYGON ((0 0, 9 0, 9 9, 0 9, 0 0), (5 5, 12 5, 12 6, 5 6, 5 5))",
    "hole along": "POLYGON ((0 0, 9 0, 9 9, 0 9, 0 0), (5 5, 9 5, 9 6, 5 6, 5 5))",
    "hole through corners": "POLYGON ((0 0, 4 4, 0 8, -4 4, 0 0), (-2 4, 4 4, 6 5, -2 4))",
}
SOUND = {
    "point twice": "POLYGON ((0 0, 4 0, 4 0, 4 4, 0 4, 0 0))",
    "straight on": "POLYGON ((0 0, 2 0, 4 0, 4 4, 0 4, 0 0))",
    "hole": "POLYGON ((0 0, 9 0, 9 9, 0 9, 0 0), (2 2, 7 2, 7 7, 2 7, 2 2))",
    "hole touches": "POLYGON ((0 0, 9 0, 9 9, 0 9, 0 0), (0 4, 2 2, 2 6, 0 4))",
    "parts": "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((5 5, 7 5, 7 7, 5 7, 5 5)))",
}


def test_faults(spark):
    rows = spark.createDataFrame([*FAULTS.items(), *SOUND.items(), ("none", None), ("empty", "POLYGON EMPTY")], "name string, wkt string")
    made = rows.select("name", F.when(F.col("name") == "empty", F.from_json(F.lit("[]"), "array<array<struct<x:double,y:double>>>")).otherwise(shape.from_wkt(F.col("wkt"))).alias("shape")).cache()
    assert values(made, validity(F.col("shape"))) == {k: "invalid" for k in FAULTS} | {k: "valid" for k in SOUND} | {"none": "null", "empty": "empty"}


def test_faults_of_long_rings():
    import time

    import numpy as np

    from cadastra.functions import validity as module

    def ring(n, teeth=40):
        t = np.linspace(0, 2 * math.pi, n, endpoint=False)
        r = 5000 * (1 + 0.4 * np.cos(teeth * t))
        v = np.stack([4e6 + r * np.cos(t), 3e6 + r * np.sin(t)], axis=1)
        return np.vstack([v, v[:1]])

    seconds = []
    for n in (20_000, 80_000):
        sound, touching, spiked = ring(n), ring(n), ring(n)
        # a vertex moved onto an edge far along the ring
        touching[100] = touching[n // 2]
        spiked[n // 3] = spiked[n // 3 + 2]
        began = time.process_time()
        assert module._simple([sound])
        seconds.append(time.process_time() - began)
        assert not module._simple([touching]) and not module._simple([spiked])
    assert seconds[1] < 10 * seconds[0] + 0.5
    # cells find the same pairs as all pairs do
    rng = np.random.default_rng(2)
    for _ in range(20):
        a, b = rng.uniform(0, 10, (200, 2)), rng.uniform(0, 10, (200, 2))
        b = a + (b - a) * rng.choice([0.02, 0.3, 1.0], (200, 1)) * rng.choice([0.0, 1.0, 1.0], (200, 2))
        i, j = module.near_pairs(a, b)
        near = set(zip(i.tolist(), j.tolist(), strict=True))
        x, y = np.triu_indices(200, 1)
        meet = (module._turn(a[x], b[x], a[y]) * module._turn(a[x], b[x], b[y]) <= 0) & (module._turn(a[y], b[y], a[x]) * module._turn(a[y], b[y], b[x]) <= 0)
        box = ((np.minimum(a[x], b[x]) <= np.maximum(a[y], b[y])) & (np.minimum(a[y], b[y]) <= np.maximum(a[x], b[x]))).all(axis=1)
        assert set(zip(x[meet & box].tolist(), y[meet & box].tolist(), strict=True)) <= near


def test_keys_of_equal_shapes(spark):
    same = ["POLYGON ((0 0, 6 0, 6 2, 2 2, 2 6, 0 6, 0 0))", "POLYGON ((2 2, 6 2, 6 0, -0 0, 0 6, 2 6, 2 2))", "POLYGON ((6 2, 2 2, 2 6, 0 6, 0 0, 6 0, 6 0, 6 2))"]
    rows = spark.createDataFrame([(t,) for t in [*same, SHAPES["square"], SHAPES["triangle"], None]], "t string").select("t", shape.from_wkt(F.col("t")).alias("s"))
    got = {r.t: r.k for r in rows.select("t", shape_key(F.col("s")).alias("k")).collect()}
    assert len({got[t] for t in same}) == 1 and len(set(got.values())) == 4 and got[None] is None
    assert rows.where("t is null").select(ring_key(F.col("s")[0])).first()[0] is None


def overlaps(spark, pairs, limits=("0", "0.2", "0.8")):
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string").repartition(2)
    made = rows.select("i", shape.from_wkt(F.col("a")).alias("a"), shape.from_wkt(F.col("b")).alias("b")).cache()
    found = made.select("i", shape.overlap(F.col("a"), F.col("b"), limits).alias("o"))
    return [r.o for r in sorted(found.collect())]


def test_overlap_of_non_convex(spark):
    got = overlaps(spark, [(SHAPES["ell"], SHAPES[n]) for n in ("ell", "square", "triangle")])
    assert [o.area for o in got] == pytest.approx([20, 12, 8])
    # a third of the triangle's hypotenuse lies outside of the notch
    assert [(o.larger, o.sides) for o in got] == [(0, [1, 1, 1]), (1, [1, 1, -1]), (1, [1, 1, 1])]


def shape_distance(spark, a, b):
    row = spark.createDataFrame([(a, b)], "a string, b string").select(shape.from_wkt(F.col("a")).alias("a"), shape.from_wkt(F.col("b")).alias("b"))
    return row.select(shape.distance(F.col("a"), F.col("b"))).first()[0]


COURT = "POLYGON ((0 0, 9 0, 9 9, 0 9, 0 0), (2 2, 7 2, 7 7, 2 7, 2 2))"


def test_courtyards_and_parts(spark):
    inside, across = "POLYGON ((3 3, 6 3, 6 6, 3 6, 3 3))", "POLYGON ((1 3, 8 3, 8 6, 1 6, 1 3))"
    parts = "MULTIPOLYGON (((3 3, 6 3, 6 6, 3 6, 3 3)), ((20 0, 20 4, 24 4, 24 0, 20 0), (21 1, 21 3, 23 3, 23 1, 21 1)))"
    backwards = "POLYGON ((0 0, 0 9, 9 9, 9 0, 0 0), (2 2, 7 2, 7 7, 2 7, 2 2))"
    got = overlaps(spark, [(COURT, inside), (COURT, across), (COURT, COURT), (backwards, COURT), (COURT, parts), (parts, "POLYGON ((19 2, 25 2, 25 5, 19 5, 19 2))"), (COURT, "POLYGON EMPTY")])
    assert [o.area for o in got] == pytest.approx([0, 6, 56, 56, 0, 6, 0])
    assert [o.sides[0] for o in got] == [0, 1, 1, 1, 0, 1, 0]
    one = spark.createDataFrame([(COURT, inside, across, parts)], "c string, i string, x string, p string").select(*[shape.from_wkt(F.col(c)).alias(c) for c in "cixp"])
    c, i, x, p = (F.col(n) for n in "cixp")
    row = one.select(shape.area(c), shape.centroid(c)["x"], shape.area(p), shape.intersects(c, i), shape.intersects(c, x), shape.intersects(c, p), shape.distance(c, i), shape.distance(c, p), shape.contains_point(c, geom.point(F.lit(4.5), F.lit(4.5))), shape.point_distance(c, geom.point(F.lit(4.5), F.lit(4.0)))).first()
    assert tuple(row) == (56.0, 4.5, 21.0, False, True, False, 1.0, 1.0, False, 2.0)


def turned(points, degrees, at=(4_321_000.5, 3_210_000.25)):
    """Points of a rectangle turned by a Pythagorean angle, in which all lengths stay exact multiples of 1/5."""
    c, s = {0: (1, 0), 53: (0.6, 0.8), 37: (0.8, 0.6)}[degrees]
    return "POLYGON ((" + ", ".join(f"{at[0] + c * x - s * y!r} {at[1] + s * x + c * y!r}" for x, y in points) + "))"


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


@pytest.mark.parametrize("degrees", [0, 53, 37])
def test_ties_at_the_limits(spark, degrees):
    from fractions import Fraction

    # a hundred steps of 1/128 about the common shares of 0.2 and 0.8 of a 10 x 10 box
    pairs = [(turned(box(0, 0, 10, 10), degrees, (4_321_000, 3_210_000)), turned(box(10 - w + d, 0, 20 - w + d, 10), degrees, (4_321_000, 3_210_000))) for w in (2, 8) for d in [k / 128 for k in range(-3, 4)] + [2.0**-32, -(2.0**-32), 2.0**-40]]
    for (a, b), o in zip(pairs, overlaps(spark, pairs), strict=True):
        rings = [[[{"x": float(x), "y": float(y)} for x, y in (p.split() for p in t[10:-2].split(", "))]] for t in (a, b)]
        common, one, two = shape.exact_areas(*rings)
        assert o.sides == [(common > x) - (common < x) for x in (Fraction(q) * min(one, two) for q in ("0", "0.2", "0.8"))]
        assert o.area == pytest.approx(float(common), abs=1e-6)
        assert o.larger == (one > two) - (one < two)


def test_exact_ties_in_matching(spark):
    from cadastra.operators import spatial

    # the slanted pair shares exactly 4 of 5: its corners are whole numbers
    a = boxed(spark, [("s", "POLYGON ((0 0, 40 30, 10 70, -30 40, 0 0))"), ("r", "POLYGON ((500 0, 510 0, 510 10, 500 10, 500 0))")])
    b = boxed(spark, [("t", "POLYGON ((8 6, 48 36, 18 76, -22 46, 8 6))"), ("u", "POLYGON ((508 0, 518 0, 518 10, 508 10, 508 0))"), ("v", "POLYGON ((502 20, 512 20, 512 10, 502 10, 502 20))")])
    got = {r.b_id: (r.status, r.ratio) for r in spatial.match_footprints(a, b).collect()}
    assert got == {"t": ("unsure", 0.8), "u": ("unsure", 0.2), "v": ("non-matching", None)}


def test_random_shapes_against_exact_areas(spark):
    import random

    rng = random.Random(7)

    def star(x, y):
        angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(rng.randint(3, 12)))
        radii = [rng.uniform(2, 9) for _ in angles]
        outer = [(x + r * math.cos(t), y + r * math.sin(t)) for r, t in zip(radii, angles, strict=True)]
        return "(" + ", ".join(f"{p!r} {q!r}" for p, q in [*outer, outer[0]]) + ")"

    pairs = [tuple(f"POLYGON ({star(4e6 + rng.uniform(0, 6), 3e6 + rng.uniform(0, 6))})" for _ in "ab") for _ in range(60)]
    for (a, b), o in zip(pairs, overlaps(spark, pairs), strict=True):
        rings = [[[dict(zip("xy", map(float, p.split()), strict=True)) for p in t[10:-2].split(", ")]] for t in (a, b)]
        assert o.area == pytest.approx(float(shape.exact_areas(*rings)[0]), abs=1e-7)


def test_points(shapes):
    ell = shapes.where("name = 'ell'").select(F.array("ring").alias("shape"))
    p = geom.point(F.lit(4.0), F.lit(4.0))
    row = ell.select(shape.contains_point(F.col("shape"), p), shape.point_distance(F.col("shape"), p)).first()
    assert tuple(row) == (False, 2.0)


def test_projection_sample_point(spark):
    row = spark.range(1).select(geom.to_laea(F.lit(5.0), F.lit(50.0)).alias("p")).first()["p"]
    assert (round(row["x"], 2), round(row["y"], 2)) == (3962799.45, 2999718.85)
    back = spark.range(1).select(geom.to_lonlat(F.lit(row["x"]), F.lit(row["y"])).alias("p")).first()["p"]
    assert (round(back["lon"], 6), round(back["lat"], 6)) == (5.0, 50.0)


def test_wkb_round_trip(shapes):
    back = shapes.select("name", geom.to_wkb(F.array("ring")).alias("b")).select("name", geom.from_wkb("b").alias("rings"))
    assert values(back, geom.area(F.col("rings")[0]))["ell"] == 20


def test_multi_parts(spark):
    text = "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((5 5, 7 5, 7 7, 5 7, 5 5)))"
    rows = spark.createDataFrame([(text,)], "t string").select(F.posexplode(geom.multi_parts(F.col("t"))).alias("i", "r"))
    assert [r[1] for r in rows.select("i", geom.area(F.col("r"))).orderBy("i").collect()] == [1, 4]


def boxed(spark, rows):
    from cadastra.operators import spatial

    return spatial.boxed(spark.createDataFrame(rows, "id string, wkt string").select("id", shape.from_wkt(F.col("wkt")).alias("shape")))


def test_disjoint_triangles_do_not_match(spark):
    from cadastra.operators import spatial

    # their boxes are the same
    a = boxed(spark, [("a", "POLYGON ((0 0, 4 0, 0 4, 0 0))")])
    b = boxed(spark, [("b", "POLYGON ((4 4, 4 1, 1 4, 4 4))"), ("c", "POLYGON ((0 0, 3 0, 0 4, 0 0))")])
    assert {r.b_id: (r.overlap, r.ratio) for r in spatial.overlap_pairs(a, b).collect()} == {"c": (6.0, 1.0)}
    assert {(r.b_id, r.status) for r in spatial.match_footprints(a, b).collect()} == {("b", "non-matching"), ("c", "matching")}
    assert [r.id for r in units.outside(b, a.withColumnRenamed("id", "unit"), "unit").select("id").collect()] == ["b"]
    assert [r.b_id for r in spatial.related_pairs(a, b, "contains").collect()] == ["c"]
    # candidates go by boxes
    assert {r.b_id: r.distance for r in spatial.near_pairs(a, b).collect()} == {"b": 0, "c": 0}
    assert shape_distance(spark, "POLYGON ((0 0, 4 0, 0 4, 0 0))", "POLYGON ((4 4, 4 1, 1 4, 4 4))") == pytest.approx(1 / math.sqrt(2))


def test_touching_footprints_intersect(spark):
    from cadastra.operators import spatial

    a, b = boxed(spark, [("a", "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))")]), boxed(spark, [("b", "POLYGON ((2 2, 4 2, 4 4, 2 4, 2 2))"), ("c", "POLYGON ((2.1 2.1, 4 2.1, 4 4, 2.1 2.1))")])
    assert [r.b_id for r in spatial.related_pairs(a, b).collect()] == ["b"]
    assert spatial.overlap_pairs(a, b).isEmpty()


def test_overlap_of_odd_shapes(spark):
    rows = [(None, "POLYGON ((0 0, 1 0, 1 1, 0 0))"), ("POLYGON ((0 0, 1 0, 1 1, 0 0))", "POLYGON ((0 0, 1 1, 1 0, 0 0))"), ("POLYGON ((0 0, 1 0, 1 1, 0 0))", "POLYGON ((0 0, 1 1, 0 1, 0 0))")]
    got = overlaps(spark, rows)
    assert got[0] is None and [(o.area, o.sides[0]) for o in got[1:]] == [(0.5, 1), (0.0, 0)]
    assert overlaps(spark, rows[:1])[0] is None


def test_union_of_overlapping_parts(spark):
    from cadastra.operators import spatial

    square = "((0 0, 4 0, 4 4, 0 4, 0 0))"
    texts = {
        24: f"MULTIPOLYGON ({square}, ((2 0, 6 0, 6 4, 2 4, 2 0)))",
        16: f"MULTIPOLYGON ({square}, {square}, ((1 1, 2 1, 2 2, 1 2, 1 1)))",
        28: f"MULTIPOLYGON ({square}, ((2 2, 6 2, 6 6, 2 6, 2 2)))",
        # a diamond over a square: its corners stick out by four triangles of area 1
        20: f"MULTIPOLYGON ({square}, ((2 -1, 5 2, 2 5, -1 2, 2 -1)))",
        56: COURT,
        57: "MULTIPOLYGON (((0 0, 9 0, 9 9, 0 9, 0 0), (2 2, 7 2, 7 7, 2 7, 2 2)), ((4 4, 5 4, 5 5, 4 5, 4 4)))",
    }
    rows = spark.createDataFrame([*texts.items(), (0, "POLYGON EMPTY")], "want int, t string").select("want", shape.from_wkt(F.col("t")).alias("s")).cache()
    assert {r.want: round(r.a, 9) for r in rows.select("want", shape.union_area(F.col("s")).alias("a")).collect()} == {k: float(k) for k in [*texts, 0]}
    parts = boxed(spark, [("a", f"POLYGON {square}"), ("b", "POLYGON ((2 0, 6 0, 6 4, 2 4, 2 0))")]).withColumn("k", F.lit(1))
    assert [(r.n_parts, r.area, r.overlapping) for r in spatial.dissolve(parts, "k").collect()] == [(2, 24.0, True)]


def test_building_in_a_courtyard_does_not_match(spark):
    from cadastra.operators import spatial

    a, b = boxed(spark, [("a", COURT)]), boxed(spark, [("in", "POLYGON ((3 3, 6 3, 6 6, 3 6, 3 3))"), ("on", "POLYGON ((0 0, 2 0, 2 9, 0 9, 0 0))")])
    assert {(r.b_id, r.status) for r in spatial.match_footprints(a, b).collect()} == {("in", "non-matching"), ("on", "matching")}
    assert [r.b_id for r in spatial.related_pairs(a, b, "contains").collect()] == ["on"]
    assert [r.id for r in units.outside(b, a.withColumnRenamed("id", "unit"), "unit").collect()] == ["in"]
    points = spark.createDataFrame([("p", 4.0, 4.0), ("q", 1.0, 1.0)], "id string, x double, y double")
    assert [r.a_id for r in spatial.points_within(points, a).collect()] == ["q"]
