"""Costly parts of an expression occur once in the plan, however often their value is used."""

from pyspark.sql import functions as F

from cadastra.functions import geom
from cadastra.plans import release


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_texts_are_read_once(spark):
    rows = spark.createDataFrame([("POLYGON ((0 0,\t4  0, 4 4,0 4 , 0 0))",)], "t string").repartition(1)
    out = rows.select(geom.area(geom.from_wkt(F.col("t"))[0]).alias("area"))
    assert plan(out).count("regexp_extract_all") == 1 and out.first().area == 16
    centre = rows.select(geom.centroid(geom.from_wkt(F.col("t"))[0]).alias("c"))
    assert plan(centre).count("regexp_extract_all") == 1 and tuple(centre.first().c) == (2, 2)


def test_centroid_of_degrees_is_summed_once(spark):
    box = geom.rectangle(*[F.col("x") + v for v in (0, 0, 2, 2)])
    rows = spark.createDataFrame([(4_321_000.0,)], "x double").repartition(1).select(box.alias("geometry"), F.lit(1).alias("bbox"))
    out = release.lat_lon(rows.repartition(1)).select("footprint_area", "lat", "lon")
    # an area, and the area and two moments of the centroid
    assert plan(out).count("aggregate(") <= 4 and out.first().footprint_area == 4
