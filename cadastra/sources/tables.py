"""Readers and writers of building tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geom import curve_key

#: Rows of a row group: few, so that readers skip what a filter leaves out.
GROUP_ROWS = 10_000

FEATURES = "geometry struct<type:string,coordinates:array<array<array<double>>>>, properties struct<height:double,confidence:double>"


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, one of a local session; on a cluster that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir is not set: executors share no folder")
    return f"file://{tempfile.gettempdir()}/shared-{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again: cuts the plan, survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that are broadcast; more are shuffled.
BROADCAST_ROWS = 100_000


def sized(df: DataFrame) -> DataFrame:
    """A written frame, marked for broadcast if it has BROADCAST_ROWS or fewer."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def read_regions(spark: SparkSession, folder: str, prefix: str = "") -> DataFrame:
    """Parquet files, or folders of them, of regions whose name starts with ``prefix``, tagged with that name."""
    df = spark.read.parquet(f"{folder}/{prefix}*.parquet")
    return df.withColumn("region_id", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)\.parquet(/part-[^/]*)?$", 1))


def list_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Paths below ``folder`` whose file name matches a regular expression; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path").where(F.element_at(F.split("path", "/"), -1).rlike(pattern))


def read_wkt_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", "true").option("escape", '"').csv(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of features: properties flattened, the polygon as rings of points."""
    ring = F.transform("geometry.coordinates", lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return spark.read.schema(FEATURES).json(path).select("properties.*", ring.alias("geometry"))


def extract_xml(df: DataFrame, xml: str, single: dict[str, str], several: dict[str, str] | None = None) -> DataFrame:
    """Columns read from one XML element per row by paths; ``several`` gives all values."""
    def text(path: str) -> Column:
        return F.nullif(F.xpath_string(F.col(xml), F.lit(path)), F.lit(""))

    out = {name: text(path) for name, path in single.items()}
    out |= {name: F.xpath(F.col(xml), F.lit(path)) for name, path in (several or {}).items()}
    return df.withColumns(out)


def read_catalog(spark: SparkSession, path: str, variables: tuple[str, ...], lists: tuple[str, ...] = ()) -> DataFrame:
    """Parameter rows: 'None' as null, list literals as arrays, the variable columns as one map."""
    df = spark.read.option("header", "true").option("escape", '"').csv(path)
    df = df.select(*[F.nullif(F.col(f"`{c}`"), F.lit("None")).alias(c) for c in df.columns])
    df = df.withColumns({c: F.from_json(F.replace(F.col(c), F.lit("'"), F.lit('"')), "array<string>") for c in lists})
    pairs = [x for v in variables for x in (F.lit(v), F.col(v))]
    return df.withColumn("variables", F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())).drop(*variables)


#: Width of the cells that the curve goes through.
CURVE_CELL = 30.0


def write_release(df: DataFrame, folder: str, region: str = "region_id", order: tuple[str, ...] = ("geometry_source", "city_id", "id"), box: str | None = None, group_rows: int = GROUP_ROWS) -> None:
    """Zstd files by region, sorted so that filters on leading columns skip row groups; other regions stay.

    With ``box``, the name of a struct of xmin and ymin, rows lie along a space-filling curve within
    their region, so that a filter on a box reads the row groups near it. Rows are dealt by
    ranges of the order, so a large region is written by several tasks.
    """
    rows = df.withColumn("nuts_id", F.col(region))
    if box:
        rows, order = rows.withColumn("_z", curve_key(F.col(f"{box}.xmin"), F.col(f"{box}.ymin"), CURVE_CELL)), ("_z", *order)
    dealt = rows.repartitionByRange("nuts_id", *order).sortWithinPartitions("nuts_id", *order).drop("_z")
    out = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("nuts_id")
    out.option("compression", "zstd").option("parquet.block.row.count.limit", group_rows).parquet(folder)


def within_box(df: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float, box: str = "bbox") -> DataFrame:
    """Rows whose box lies inside of the limits, on fields that reach the reader's statistics."""
    return df.where((F.col(f"{box}.xmin") > xmin) & (F.col(f"{box}.xmax") < xmax) & (F.col(f"{box}.ymin") > ymin) & (F.col(f"{box}.ymax") < ymax))


def write_by_unit(geoms: DataFrame, attrs: DataFrame, folder: str, unit: str = "nuts3", id: str = "id") -> None:
    """Geometries with their attributes, a folder per unit."""
    geoms.join(attrs, id).write.mode("overwrite").partitionBy(unit).parquet(folder)


#: Folder of the marks of regions that are complete; readers skip names with an underscore.
DONE = "_done"


def write_regions(df: DataFrame, folder: str, region: str = "region_id") -> None:
    """The release of those regions that are not complete in ``folder`` yet, then a mark for each.

    A region cut off half-way has rows but no mark, so it is written again, in place
    of what there is of it; complete ones stay as they are.
    """
    rest = missing_regions(df, folder, region)
    codes = written(rest.select(region).distinct(), "regions")
    write_release(rest, folder)
    codes.write.mode("append").parquet(f"{folder}/{DONE}")


def done_regions(df: DataFrame, folder: str, region: str = "region_id") -> DataFrame:
    """(region): those with a mark in ``folder``; none where nothing was written."""
    try:
        return df.sparkSession.read.parquet(f"{folder}/{DONE}").select(region).distinct()
    except AnalysisException:
        # there is no such folder yet
        return df.select(region).where("false")


def missing_regions(df: DataFrame, folder: str, region: str = "region_id") -> DataFrame:
    """Rows of regions that are not complete in ``folder``."""
    return df.join(done_regions(df, folder, region), region, "left_anti")


def write_split(df: DataFrame, folder: str, attrs: tuple[str, ...], id: str = "id", geometry: str = "geometry") -> None:
    """Geometry and attributes as two tables with the same ids."""
    df.select(id, geometry).write.mode("overwrite").parquet(f"{folder}/geoms")
    df.select(id, *attrs).write.mode("overwrite").parquet(f"{folder}/attribs")


def read_partitions(spark: SparkSession, folder: str, prefix: str) -> DataFrame:
    """Hive partitions of regions that start with ``prefix``; others are not listed for reading."""
    return spark.read.parquet(folder).where(F.col("nuts_id").startswith(prefix))


def write_lat_lon(df: DataFrame, path: str) -> None:
    df.orderBy("geometry_source", "region_id", "city_id", "id").write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_globs(spark: SparkSession, globs: list[str]) -> DataFrame:
    return spark.read.load(globs)
