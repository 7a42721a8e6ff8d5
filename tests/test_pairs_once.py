"""Pairs of footprints, and of footprints and units, are worked out once; units are cut by several tasks."""

import pytest
from pyspark.sql import functions as F

from cadastra.operators import spatial, units
from cadastra.plans.fixtures import shapes

FOLDER = "/root/testdata/sf0.001"
KIND = "array<array<struct<x:double,y:double>>>"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def block(x0, y0, x1, y1):
    return [[{"x": x, "y": y} for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]]


@pytest.fixture(scope="module")
def squares(spark):
    rows = [(f"u{i}{j}", block(i * 250.0, j * 250.0, i * 250.0 + 240, j * 250.0 + 240)) for i in range(4) for j in range(4)]
    return spatial.boxed(spark.createDataFrame(rows, f"unit string, shape {KIND}")).coalesce(1)


def test_matches_read_pairs_that_are_written(spark):
    found = spatial.match_footprints(shapes(spark, FOLDER, "fx_gov"), shapes(spark, FOLDER, "fx_osm"))
    assert plan(found).count("ArrowEvalPython") <= 1


def test_units_are_dealt_by_vertices(spark, squares, monkeypatch):
    monkeypatch.setattr(units, "TASK_VERTICES", 20, raising=False)
    cover = units.pieces(squares, "unit")
    assert len(cover.inputFiles()) > 1
    area = {r.unit: r.area for r in cover.groupBy("unit").agg(F.sum((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))).alias("area")).collect()}
    assert len(area) == 16 and set(area.values()) == {240.0 * 240}
    # every part of a rectangle is its box
    assert cover.where("not inner").count() == 0


def test_units_and_footprints_meet_once(spark, squares):
    rows = [("in", block(20.0, 20.0, 30.0, 28.0)), ("over", block(235.0, 20.0, 255.0, 30.0)), ("cells", block(238.0, 700.5, 239.5, 739.5)), ("none", block(241.0, 241.0, 249.0, 249.0))]
    # walls without width lie in a unit and have no area in common with it
    rows += [("flat", block(30.0, 20.0, 30.0, 50.0)), ("slant", [[{"x": 20 + v * 1.5, "y": 20 + v * 0.5} for v in (0, 1, 3, 2, 0)]]), ("empty", [])]
    built = spatial.boxed(spark.createDataFrame(rows, f"id string, shape {KIND}"))
    found = units.unit_overlaps(built, squares, "unit")
    assert plan(found).count("Join") == 1
    got = {(r.id, r.unit): r.overlap for r in found.collect()}
    assert got.keys() == {("in", "u00"), ("over", "u00"), ("over", "u10"), ("cells", "u02")}
    assert got["in", "u00"] == 80 and got["over", "u00"] == got["over", "u10"] == 50 and got["cells", "u02"] == 1.5 * 39


def test_boxes_are_told_from_other_outlines():
    import numpy as np

    def ring(*points):
        return [np.array([*points, points[0]], float)]

    assert units._is_box(ring((0, 0), (3, 0), (3, 2), (0, 2)))
    crossed, slanted, flat, folded = ring((0, 0), (3, 2), (3, 0), (0, 2)), ring((0, 0), (3, 0), (3, 2), (1e-9, 2)), ring((0, 0), (3, 0), (3, 0), (0, 0)), ring((0, 0), (3, 0), (3, 2), (3, 0))
    assert not any(map(units._is_box, (crossed, slanted, flat, folded, [*ring((0, 0), (3, 0), (3, 2), (0, 2))] * 2)))
