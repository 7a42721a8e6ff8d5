"""Spatial joins by grid cells: equi joins on cell keys, each pair kept in one cell.

Inputs have ``id``, the footprint in ``shape`` (see :mod:`cadastra.functions.shape`;
holes and parts count) and its box in xmin, ymin, xmax, ymax (see :func:`boxed`).
Boxes find pairs, shapes decide, and thresholds are decided exactly. A box is put into
all cells that it touches; a pair is kept in the cell of its (max xmin, max
ymin) corner, so nothing is counted twice. Cells should be about twice as wide
as a usual box.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geom, shape
from ..sources.tables import written

CELL = 60.0
BOX = ("xmin", "ymin", "xmax", "ymax")


def _celled(df: DataFrame, size: float, side: str, margin: float = 0.0) -> DataFrame:
    xs = F.sequence(geom.cell(F.col("xmin") - margin, size), geom.cell(F.col("xmax") + margin, size))
    ys = F.sequence(geom.cell(F.col("ymin") - margin, size), geom.cell(F.col("ymax") + margin, size))
    own = df.withColumns({"_cx": F.explode(xs), "_ys": ys}).withColumn("_cy", F.explode("_ys"))
    return own.select(F.col("_cx").alias("cx"), F.col("_cy").alias("cy"), *[F.col(c).alias(f"{side}_{c}") for c in df.columns])


def box_pairs(a: DataFrame, b: DataFrame, size: float = CELL, margin: float = 0.0) -> DataFrame:
    """Pairs of boxes at most ``margin`` apart along both axes, columns prefixed a_ and b_."""
    pairs = _celled(a, size, "a", margin).join(_celled(b, size, "b"), ["cx", "cy"])
    x, y = F.greatest(F.col("a_xmin") - margin, "b_xmin"), F.greatest(F.col("a_ymin") - margin, "b_ymin")
    near = (F.col("a_xmin") - margin <= F.col("b_xmax")) & (F.col("b_xmin") <= F.col("a_xmax") + margin)
    near &= (F.col("a_ymin") - margin <= F.col("b_ymax")) & (F.col("b_ymin") <= F.col("a_ymax") + margin)
    return pairs.where(near & (F.col("cx") == geom.cell(x, size)) & (F.col("cy") == geom.cell(y, size))).drop("cx", "cy")


def boxed(df: DataFrame) -> DataFrame:
    """The box columns of a shape."""
    return df.withColumn("_b", shape.bbox(F.col("shape"))).select(*df.columns, "_b.*")


def _overlapped(pairs: DataFrame, *limits: str) -> DataFrame:
    """``pairs`` with a common area: overlap, ratio to the smaller area, and the signs of :func:`shape.overlap` in larger and sides."""
    # boxes that only touch have no area in common
    met = pairs.where("a_xmin < b_xmax and b_xmin < a_xmax and a_ymin < b_ymax and b_ymin < a_ymax")
    found = met.withColumn("_o", shape.overlap(F.col("a_shape"), F.col("b_shape"), ("0", *limits))).where("_o.sides[0] > 0")
    return found.select(*pairs.columns, F.col("_o.area").alias("overlap"), F.col("_o.larger").alias("larger"), F.col("_o.sides").alias("sides"), F.try_divide("_o.area", "_o.smaller").alias("ratio"))


def overlap_pairs(a: DataFrame, b: DataFrame, size: float = CELL) -> DataFrame:
    """Pairs with a common area: overlap, and overlap by the smaller footprint's area as ratio."""
    return _overlapped(box_pairs(a, b, size)).drop("larger", "sides")


def related_pairs(a: DataFrame, b: DataFrame, how: str = "intersects", size: float = CELL) -> DataFrame:
    """Pairs whose footprints meet (borders count), or of which a is within b, or contains it."""
    if how == "intersects":
        return box_pairs(a, b, size).where(shape.intersects(F.col("a_shape"), F.col("b_shape")))
    # the smaller one lies in the other if all of its area is common
    fits = {"within": "larger <= 0", "contains": "larger >= 0"}[how]
    return _overlapped(box_pairs(a, b, size), "1").where(f"sides[1] = 0 and {fits}").drop("overlap", "larger", "sides", "ratio")


def match_footprints(a: DataFrame, b: DataFrame, hi: str = "0.8", lo: str = "0.2", size: float = CELL) -> DataFrame:
    """Rows of b, or pairs, by status; the limits are decimal numbers and strict.

    matching: a pair with a ratio above ``hi``; non-matching: a row of b whose
    largest ratio is below ``lo`` or that meets nothing; unsure: any other row of b.
    Pairs, without shapes, are written, as they are read twice.
    """
    pairs = written(_overlapped(box_pairs(a, b, size), hi, lo).select("a_id", "b_id", "ratio", F.col("sides")[1].alias("above"), F.col("sides")[2].alias("low")), "pairs")
    best = pairs.groupBy("b_id").agg(F.max("ratio").alias("best"), F.max("above").alias("above"), F.max("low").alias("low"))
    rows = b.select(F.col("id").alias("b_id")).join(best, "b_id", "left")
    status = F.when(F.coalesce("low", F.lit(-1)) < 0, "non-matching").otherwise("unsure")
    rest = rows.where(F.coalesce("above", F.lit(-1)) <= 0).select(F.lit(None).cast("string").alias("a_id"), "b_id", F.col("best").alias("ratio"), status.alias("status"))
    return pairs.where("above > 0").select("a_id", "b_id", "ratio", F.lit("matching").alias("status")).unionByName(rest)


def points_within(points: DataFrame, rows: DataFrame, size: float = CELL) -> DataFrame:
    """(a_, b_) pairs of points (id, x, y, ...) and the footprints that hold them; a box's upper border is excluded."""
    boxes = points.withColumns({"xmin": F.col("x"), "xmax": F.col("x"), "ymin": F.col("y"), "ymax": F.col("y")})
    inside = "a_x >= b_xmin and a_x < b_xmax and a_y >= b_ymin and a_y < b_ymax"
    return box_pairs(boxes, rows, size).where(inside).where(shape.contains_point(F.col("b_shape"), geom.point(F.col("a_x"), F.col("a_y"))))


def point_to_poly(points: DataFrame, rows: DataFrame, radius: float = 20.0, size: float = CELL) -> DataFrame:
    """(point_id, id, distance): each point its nearest footprint within ``radius``, then each footprint its nearest point."""
    boxes = points.withColumns({"xmin": F.col("x"), "xmax": F.col("x"), "ymin": F.col("y"), "ymax": F.col("y")})
    pairs = box_pairs(boxes, rows, size, radius)
    away = shape.point_distance(F.col("b_shape"), geom.point(F.col("a_x"), F.col("a_y")))
    near = pairs.withColumn("distance", away).where(F.col("distance") <= radius)
    for key, other in (("a_id", "b_id"), ("b_id", "a_id")):
        place = F.row_number().over(Window.partitionBy(key).orderBy("distance", other))
        near = near.withColumn("place", place).where("place = 1").drop("place")
    return near.select(F.col("a_id").alias("point_id"), F.col("b_id").alias("id"), "distance")


def near_pairs(a: DataFrame, b: DataFrame, k: int = 3, distance: float = 10.0, size: float = CELL) -> DataFrame:
    """Pairs among the k nearest footprints of either side, by the distance of their boxes, at most ``distance`` apart."""
    pairs = box_pairs(a, b, size, distance)
    gaps = [F.greatest(F.col(f"a_{c}min") - F.col(f"b_{c}max"), F.col(f"b_{c}min") - F.col(f"a_{c}max"), F.lit(0.0)) for c in "xy"]
    pairs = pairs.withColumn("distance", F.hypot(*gaps)).where(F.col("distance") <= distance)
    one = F.row_number().over(Window.partitionBy("a_id").orderBy("distance", "b_id"))
    two = F.row_number().over(Window.partitionBy("b_id").orderBy("distance", "a_id"))
    return pairs.withColumns({"from_a": one, "from_b": two}).where((F.col("from_a") <= k) | (F.col("from_b") <= k)).drop("from_a", "from_b")


def drop_overlapping(rows: DataFrame, limit: str = "0.25", size: float = CELL) -> DataFrame:
    """Rows without the smaller of each pair that overlaps by more than ``limit`` of the smaller area."""
    pairs = _overlapped(box_pairs(rows, rows, size).where("a_id <> b_id"), limit).where("sides[1] > 0")
    loses = (F.col("larger") < 0) | ((F.col("larger") == 0) & (F.col("a_id") > F.col("b_id")))
    return rows.join(pairs.where(loses).select(F.col("a_id").alias("id")), "id", "left_anti")


def grid_sum(points: DataFrame, value: str, size: float) -> DataFrame:
    return points.groupBy(geom.cell(F.col("x"), size).alias("cx"), geom.cell(F.col("y"), size).alias("cy")).agg(F.sum(value).alias(value))


def dissolve(parts: DataFrame, key: str) -> DataFrame:
    """(key, n_parts, area, shape, overlapping): parts of a key as one shape with the area that they cover together; flagged if two have a common area."""
    shapes = parts.groupBy(key).agg(F.flatten(F.collect_list("shape")).alias("shape"), F.count(F.lit(1)).alias("n_parts"), F.sum(shape.area(F.col("shape"))).alias("total"))
    pairs = overlap_pairs(parts, parts).where((F.col(f"a_{key}") == F.col(f"b_{key}")) & (F.col("a_id") < F.col("b_id")))
    flagged = shapes.join(pairs.select(F.col(f"a_{key}").alias(key), F.lit(True).alias("overlapping")).distinct(), key, "left")
    # only what overlaps needs the sweep
    swept = flagged.withColumn("covered", shape.union_area(F.when(F.col("overlapping"), F.col("shape"))))
    return swept.select(key, "n_parts", F.coalesce("covered", "total").alias("area"), "shape", F.coalesce("overlapping", F.lit(False)).alias("overlapping"))
