"""The published building table: attributes resolved by precedence, checked, typed and numbered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean, geom
from ..operators import dedup, merge

#: Codes that one dataset uses for several types.
AMBIGUOUS = ("Civile", "Civile1")
AMBIGUOUS_DATASET = "gov-italy-trentino-alto-adige"


def combine(conflated: DataFrame, predictions: DataFrame, id: str = "id") -> DataFrame:
    """Both tables on the building id, rows of either side kept."""
    return conflated.join(predictions, id, "full")


def plausible(df: DataFrame) -> DataFrame:
    """Implausible own and merged values as null; the ratio of floors to height is that of the own values.

    After the own pair is checked its bad values are null, so the merged pair is
    held to the ranges alone.
    """
    h, f = (F.col(c) for c in ("height", "floors"))
    own = clean.realistic(h, f, h, f)
    df = df.withColumns({"height": own[0], "floors": own[1]})
    no_ratio = F.lit(None).cast("double")
    osm = clean.realistic(F.col("osm_height_merged"), F.col("osm_floors_merged"), no_ratio, no_ratio)
    df = df.withColumns({"osm_height_merged": osm[0], "osm_floors_merged": osm[1]})
    ambiguous = F.col("type_source").isin(*AMBIGUOUS) & (F.col("source_dataset") == AMBIGUOUS_DATASET)
    df = df.withColumn("type", clean.clear_where(F.col("type"), ambiguous))
    years = {c: clean.release_year(F.col(c)) for c in ("age", "osm_age_merged")}
    return df.withColumns(years | {c: clean.release_floors(F.col(c)) for c in ("floors", "osm_floors_merged")})


def _one(col: str) -> Column:
    return F.array(F.col(col))


def resolved(df: DataFrame) -> DataFrame:
    """Columns height, floors, construction_year, type and subtype as structs (value, source, bounds, ids)."""
    own, osm, est = F.col("source_dataset"), F.lit("osm"), F.lit("estimated")

    def c(name: str) -> Column | None:
        return F.col(name) if name in df.columns else None

    def numeric(attr: str, name: str) -> list:
        tiers = [(own, F.col(attr), None, None, _one("id_source")), (osm, F.col(f"osm_{attr}_merged"), c(f"osm_{attr}_confidence_lower"), c(f"osm_{attr}_confidence_upper"), c(f"osm_{attr}_source_ids"))]
        if f"{name}_pred" in df.columns:
            tiers.append((est, F.col(f"{name}_pred"), c(f"{name}_confidence_lower"), c(f"{name}_confidence_upper"), None))
        return tiers

    from_msft = {"when": F.col("height_source") == "msft", "value": F.col("height_pred"), "source": est, "lower": F.col("height_confidence_lower"), "upper": F.col("height_confidence_upper")}
    no_farms = {"when": (F.col("type_source") == "31001_2000") & F.col("type_pred").isin("agricultural", "industrial"), "value": F.col("type_pred"), "source": est, "lower": F.col("type_confidence")}

    def kind(attr: str, osm_conf: str, conf: str) -> list:
        return [(own, F.col(attr), None, None, _one("id_source")), (osm, F.col(f"osm_{attr}_merged"), c(osm_conf), None, c(f"osm_{attr}_source_ids")), (est, F.col(f"{attr}_pred"), c(conf), None, None)]

    subtype = merge.resolve(kind("type", "osm_type_confidence", "type_confidence"), "string", [no_farms])
    detail = merge.resolve(kind("residential_type", "osm_residential_type_confidence", "residential_type_confidence"), "string")
    use = merge.resolve(kind("type", "osm_binary_type_confidence", "binary_type_confidence"), "string")
    # both are columns first, as the published subtype uses them many times
    return df.withColumns({"_subtype": subtype, "_detail": detail}).withColumns(
        {
            "r_height": merge.resolve(numeric("height", "height"), "double", [from_msft]),
            "r_floors": merge.resolve(numeric("floors", "floors"), "double"),
            "r_year": merge.resolve(numeric("age", "age"), "double"),
            "r_type": use,
            "r_subtype": merge.publish_subtype(F.col("_subtype"), F.col("_detail")),
        }
    ).drop("_subtype", "_detail")


def _decimal(value: Column, kind: str, places: int) -> Column:
    return F.round(value, places).try_cast(kind)


def released(df: DataFrame) -> DataFrame:
    """The published columns of a resolved table, in order and with their types; values that do not fit are null."""
    h, f, y, t, s = (F.col(f"r_{c}") for c in ("height", "floors", "year", "type", "subtype"))
    box = F.struct("xmin", "ymin", "xmax", "ymax")
    return df.select(
        "id", "region_id", F.col("LAU_ID").alias("city_id"),
        merge.binary_type(t["value"]).alias("type"), s["value"].alias("subtype"),
        _decimal(h["value"], "decimal(4,1)", 1).alias("height"), _decimal(f["value"], "decimal(4,1)", 1).alias("floors"), F.round(y["value"]).try_cast("smallint").alias("construction_year"),
        _decimal(t["lower"], "decimal(3,2)", 2).alias("type_confidence"), _decimal(s["confidence"], "decimal(3,2)", 2).alias("subtype_confidence"),
        *[_decimal(r[side], "decimal(4,1)", 1).alias(f"{n}_confidence_{side}") for n, r in (("height", h), ("floors", f)) for side in ("lower", "upper")],
        *[F.round(y[side]).try_cast("smallint").alias(f"construction_year_confidence_{side}") for side in ("lower", "upper")],
        F.col("source_dataset").alias("geometry_source"),
        t["source"].alias("type_source"), s["source"].alias("subtype_source"), h["source"].alias("height_source"), f["source"].alias("floors_source"), y["source"].alias("construction_year_source"),
        F.col("id_source").alias("geometry_source_id"),
        *[r["ids"].alias(f"{n}_source_ids") for n, r in (("type", t), ("subtype", s), ("height", h), ("floors", f), ("construction_year", y))],
        F.col("type_source").alias("subtype_raw"), geom.rectangle(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")]).alias("geometry"), box.alias("bbox"),
    )


def with_ids(release: DataFrame, block: str = "block_id", order: tuple[str, ...] = ("geometry_source_id",)) -> DataFrame:
    """The published table with ids of its own: the block and a running number in it; null where a row has no block."""
    numbered = dedup.numbered(release, [block], order, "_number")
    return numbered.withColumn("id", F.concat(F.col(block), F.lit("-"), F.col("_number"))).drop("_number")


def lat_lon(release: DataFrame) -> DataFrame:
    """The published table without geometry, with footprint area and the centroid in degrees."""
    centred = release.withColumns({"footprint_area": geom.area(F.col("geometry")), "_c": geom.centroid(F.col("geometry"))})
    # the angles come from columns, not from the sums that they are made of, as they use them many times
    centred = centred.withColumns({"_x": F.col("_c.x"), "_y": F.col("_c.y")})
    degrees = geom.to_lonlat(F.col("_x"), F.col("_y"))
    return centred.withColumns({"lat": degrees["lat"], "lon": degrees["lon"]}).drop("geometry", "bbox", "_c", "_x", "_y")
