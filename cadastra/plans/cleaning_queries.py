"""Queries over attribute cleaning, filters, ids and de-duplication."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean
from ..operators import dedup
from ..sources import tables
from .catalog import query
from .fixtures import ctes, fixture

NUM = "TRY_CAST(nullif(regexp_extract({0}, '(\\d+(\\.\\d+)?)', 1), '') AS DOUBLE)"


@query("p01_p02_select_rename", ctes("fx_osm_raw") + "SELECT id, height AS height, start_date AS age, CAST(NULL AS VARCHAR) AS floors, CAST(NULL AS VARCHAR) AS type FROM fx_osm_raw")
def select_rename(spark: SparkSession, d: str) -> DataFrame:
    return clean.rename_map(fixture(spark, d, "fx_osm_raw"), {"id": "id", "height": "height", "start_date": "age"}, ("floors", "type"))


@query(
    "p03_missing_markers",
    ctes("fx_osm_raw") + "SELECT id, CASE WHEN trim(height) NOT IN ('','None','nan','NaN') THEN height END AS height, coalesce(start_date, '') AS start_date, coalesce(amenity, '') AS amenity FROM fx_osm_raw",
)
def missing_markers(spark, d):
    return fixture(spark, d, "fx_osm_raw").select("id", clean.missing_to_null(F.col("height")).alias("height"), clean.null_to_empty(F.col("start_date")).alias("start_date"), clean.null_to_empty(F.col("amenity")).alias("amenity"))


@query("p04_extract_number", ctes("fx_osm_raw") + f"SELECT id, {NUM.format('height')} AS height FROM fx_osm_raw")
def extract_number(spark, d):
    return fixture(spark, d, "fx_osm_raw").select("id", clean.extract_number(F.col("height")).alias("height"))


@query("p05_has_type", ctes("fx_osm_raw") + "SELECT id, nullif(building,'yes') AS building, nullif(amenity,'yes') AS amenity, coalesce(nullif(building,'yes'), nullif(amenity,'yes')) IS NOT NULL AS has_type FROM fx_osm_raw")
def has_type(spark, d):
    b, a = (clean.yes_to_null(F.col(c)) for c in ("building", "amenity"))
    return fixture(spark, d, "fx_osm_raw").select("id", b.alias("building"), a.alias("amenity"), clean.has_type(b, a).alias("has_type"))


KIND = "CASE event_id % 5 WHEN 0 THEN 'POINT (1 2)' WHEN 1 THEN 'LINESTRING (0 0, 1 1)' WHEN 2 THEN ' multipolygon (((0 0, 1 0, 1 1, 0 0)))' ELSE 'POLYGON ((0 0, 1 0, 1 1, 0 0))' END"


@query("p06_p17_filters", ctes("fx_osm_raw") + f"SELECT r.id, building FROM fx_osm_raw r JOIN (SELECT event_id, {KIND} AS wkt FROM events) e ON e.event_id = r.id WHERE building IS NOT NULL AND coalesce(amenity, '') <> 'yes' AND wkt ILIKE '%POLYGON%'")
def filters(spark, d):
    """Rows tagged as buildings, without a raw value, whose geometry is a polygon."""
    shapes = spark.read.parquet(f"{d}/events.parquet").select(F.col("event_id").alias("id"), F.expr(KIND).alias("wkt"))
    rows = fixture(spark, d, "fx_osm_raw").join(shapes, "id").where(clean.is_polygon(F.col("wkt")))
    return rows.where("building is not null").where(F.coalesce("amenity", F.lit("")) != "yes").select("id", "building")


@query("p07_numeric_failures", ctes("fx_osm_raw") + "SELECT count(*) AS n, count(TRY_CAST(height AS DOUBLE)) AS n_numeric, count(*) FILTER (WHERE height IS NOT NULL AND TRY_CAST(height AS DOUBLE) IS NULL) AS n_failed FROM fx_osm_raw")
def numeric_failures(spark, d):
    return fixture(spark, d, "fx_osm_raw").agg(F.count("*").alias("n"), F.count(clean.to_numeric(F.col("height"))).alias("n_numeric"), clean.numeric_failures(F.col("height")).alias("n_failed"))


@query(
    "p08_p09_height_floors",
    ctes("fx_gov")
    + """SELECT id, height AS height_raw, CASE WHEN coalesce(floors > height/1.5 AND floors < 30, false) THEN NULL WHEN height > 0 THEN height END AS height,
  CASE WHEN floors > 0 THEN floors END AS floors FROM fx_gov""",
)
def height_floors(spark, d):
    return fixture(spark, d, "fx_gov").select("id", F.col("height").alias("height_raw"), clean.clean_height(F.col("height"), F.col("floors")).alias("height"), clean.clean_floors(F.col("floors")).alias("floors"))


@query("p10_msft_height", ctes("fx_msft") + "SELECT id, height AS height_raw, CASE WHEN height > 0 THEN height END AS height FROM fx_msft")
def msft_height(spark, d):
    return fixture(spark, d, "fx_msft").select("id", F.col("height").alias("height_raw"), clean.clean_msft_height(F.col("height")).alias("height"))


@query("p11_year", ctes("fx_osm_raw") + "SELECT id, CASE WHEN TRY_CAST(substr(start_date,1,4) AS DOUBLE) >= 1000 THEN TRY_CAST(substr(start_date,1,4) AS DOUBLE) END AS age FROM fx_osm_raw")
def year(spark, d):
    return fixture(spark, d, "fx_osm_raw").select("id", clean.extract_year(F.col("start_date")).alias("age"))


@query("p12_p13_source_dataset", ctes("fx_gov") + "SELECT id, CAST(type_source AS VARCHAR) AS type_source, 'gov-' || lower(right(source_file,1)) AS source_dataset FROM fx_gov")
def source_dataset(spark, d):
    gov = fixture(spark, d, "fx_gov")
    regions = gov.select("source_file").distinct().withColumn("region", F.lower(F.expr("right(source_file, 1)")))
    return gov.join(F.broadcast(regions), "source_file").select("id", F.col("type_source").cast("string").alias("type_source"), clean.source_dataset(F.lit("gov"), F.col("region")).alias("source_dataset"))


@query(
    "p14_drop_non_buildings",
    ctes("fx_gov", "fx_crosswalk") + "SELECT id, type_source FROM fx_gov WHERE NOT coalesce(type_source IN (SELECT type_source FROM fx_crosswalk WHERE remove), false) AND NOT coalesce(starts_with(type_source, 'FURNITURE_1'), false)",
)
def drop_non_buildings(spark, d):
    gov, flagged = fixture(spark, d, "fx_gov"), fixture(spark, d, "fx_crosswalk").where("remove").select("type_source")
    return gov.join(F.broadcast(flagged), "type_source", "left_anti").where(~F.coalesce(F.col("type_source").startswith("FURNITURE_1"), F.lit(False))).select("id", "type_source")


@query("p15_undo_derived", ctes("fx_release") + "SELECT id, CASE WHEN height_source = 'estimated' THEN NULL ELSE height END AS height FROM fx_release")
def undo_derived(spark, d):
    return fixture(spark, d, "fx_release").select("id", clean.clear_where(F.col("height"), F.col("height_source") == "estimated").alias("height"))


@query("p16_elevation_difference", "SELECT l_orderkey AS k, l_linenumber AS n, round(avg(TRY_CAST(replace(replace(CAST(l_extendedprice AS VARCHAR),'.',','),',','.') AS DOUBLE) - l_quantity), 4) AS height FROM lineitem GROUP BY 1, 2")
def elevation_difference(spark, d):
    rows = spark.read.parquet(f"{d}/lineitem.parquet")
    top = F.replace(F.col("l_extendedprice").cast("string"), F.lit("."), F.lit(","))
    h = clean.elevation_difference(top, F.col("l_quantity").cast("string"))
    return rows.groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).agg(F.round(F.avg(h), 4).alias("height"))


@query("p18_p33_base_name", r"SELECT page_id AS id, regexp_extract(url, '([^/.]*)(\.[^/]*)?$', 1) AS base, regexp_extract(url, '([^/_,]*)$', 1) AS last_part, right(regexp_extract(url, '([^/.]*)(\.[^/]*)?$', 1), 4) AS code FROM pages")
def base_name(spark, d):
    base = clean.base_name(F.col("url"))
    return spark.read.parquet(f"{d}/pages.parquet").select(F.col("page_id").alias("id"), base.alias("base"), clean.last_part(F.col("url"), "/_,").alias("last_part"), F.right(base, F.lit(4)).alias("code"))


@query(
    "p19_unrealistic",
    ctes("fx_gov") + """SELECT id, CASE WHEN coalesce(floors > height/1.5, false) OR coalesce(height <= 0 OR height > 350, false) THEN NULL ELSE height END AS height,
  CASE WHEN coalesce(floors > height/1.5, false) OR coalesce(floors <= 0 OR floors > 100, false) THEN NULL ELSE floors END AS floors FROM fx_gov""",
)
def unrealistic(spark, d):
    h, f = clean.realistic(*[F.col(c) for c in ("height", "floors", "height", "floors")])
    return fixture(spark, d, "fx_gov").select("id", h.alias("height"), f.alias("floors"))


@query("p20_p21_release_year_floors", ctes("fx_gov") + "SELECT id, CASE WHEN age >= 1000 AND least(age, 2030) <> 2030 THEN age END AS construction_year, CASE WHEN floors < 1 THEN 1 ELSE floors END AS floors FROM fx_gov")
def release_year_floors(spark, d):
    return fixture(spark, d, "fx_gov").select("id", clean.release_year(F.col("age").cast("int")).alias("construction_year"), clean.release_floors(F.col("floors")).alias("floors"))


@query("p22_ambiguous_subtype", ctes("fx_gov") + "SELECT id, CASE WHEN coalesce(type_source IN ('BUILDING_1','MACHINERY_2') AND source_file = 'src_F', false) THEN NULL ELSE type_source END AS subtype FROM fx_gov")
def ambiguous_subtype(spark, d):
    bad = F.col("type_source").isin("BUILDING_1", "MACHINERY_2") & (F.col("source_file") == "src_F")
    return fixture(spark, d, "fx_gov").select("id", clean.clear_where(F.col("type_source"), bad).alias("subtype"))


@query(
    "p29_derived_columns",
    ctes("fx_release")
    + """SELECT id, substr(region_id,1,2) AS country, substr(region_id,1,3) AS nuts1, split_part(id || '-0','-',1) AS block_id, coalesce(height_source = geometry_source, false) AS authoritative,
  coalesce(height_source = 'estimated', false) AS estimated, height IS NOT NULL AND height_source IS DISTINCT FROM geometry_source AND height_source IS DISTINCT FROM 'estimated' AS merged FROM fx_release""",
)
def derived_columns(spark, d):
    own, source = F.col("geometry_source"), F.col("height_source")
    return fixture(spark, d, "fx_release").select(
        "id", F.substring("region_id", 1, 2).alias("country"), F.substring("region_id", 1, 3).alias("nuts1"), F.split_part(F.concat("id", F.lit("-0")), F.lit("-"), F.lit(1)).alias("block_id"),
        F.coalesce(source == own, F.lit(False)).alias("authoritative"), F.coalesce(source == "estimated", F.lit(False)).alias("estimated"),
        (F.col("height").isNotNull() & ~source.eqNullSafe(own) & ~source.eqNullSafe(F.lit("estimated"))).alias("merged"),
    )


@query(
    "p30_confidence_filters",
    ctes("fx_release") + "SELECT id, height FROM fx_release WHERE geometry_source NOT IN ('msft') AND coalesce(height_source <> 'estimated', true) AND coalesce(type_confidence,1) > 0.8 AND coalesce(height_confidence_upper-height_confidence_lower,0) < 2",
)
def confidence_filters(spark, d):
    return fixture(spark, d, "fx_release").where("geometry_source not in ('msft') and coalesce(height_source <> 'estimated', true) and coalesce(type_confidence, 1) > 0.8 and coalesce(height_confidence_upper - height_confidence_lower, 0) < 2").select("id", "height")


@query("p31_o02_limit", ctes("fx_release") + "SELECT id, height FROM fx_release WHERE region_id LIKE 'AT%' AND height > 30 ORDER BY height DESC, id LIMIT 10")
def limited(spark, d):
    return fixture(spark, d, "fx_release").where("region_id like 'AT%' and height > 30").orderBy(F.desc("height"), "id").limit(10).select("id", "height")


@query("p32_bbox_range", ctes("fx_release") + "SELECT id FROM fx_release WHERE xmin > 300 AND xmax < 1500 AND ymin > 100 AND ymax < 900")
def bbox_range(spark, d):
    """The release written along a curve and read by a box: row groups elsewhere are not read."""
    path = f"{tables.shared_folder(spark)}/release-{uuid.uuid4().hex}"
    rows = fixture(spark, d, "fx_release").select("id", "region_id", "city_id", "geometry_source", F.struct("xmin", "ymin", "xmax", "ymax").alias("bbox"))
    tables.write_release(rows, path, box="bbox", group_rows=500)
    return tables.within_box(spark.read.parquet(path), 300, 100, 1500, 900).select("id")


@query("p33_code_name", "SELECT p_partkey AS id, CAST(p_partkey AS VARCHAR) AS code, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_type END AS name FROM part")
def code_name(spark, d):
    text = F.when(F.col("p_partkey") % 3 == 0, F.col("p_partkey").cast("string")).otherwise(F.concat_ws(" - ", F.col("p_partkey").cast("string"), "p_type"))
    return spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), clean.code_name(text).alias("c")).select("id", "c.*")


@query("p34_keyword_flag", "SELECT p_partkey AS id, coalesce(regexp_matches(lower(p_type), 'steel|brass|small'), false) AS flag FROM part")
def keyword_flag(spark, d):
    return spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), clean.keyword_flag(F.col("p_type"), ["steel", "brass", "small"]).alias("flag"))


@query("p35_p36_codes", "SELECT c_custkey AS k, lpad(CAST(c_nationkey AS VARCHAR),2,'0') || lpad(CAST(c_custkey % 1000 AS VARCHAR),3,'0') AS code, 'b' || CAST(c_nationkey AS VARCHAR) AS parent FROM customer")
def codes(spark, d):
    full = F.concat_ws("-", F.concat(F.lit("b"), F.col("c_nationkey").cast("string")), F.col("c_custkey").cast("string"))
    return spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("k"), clean.padded_code((F.col("c_nationkey"), 2), (F.col("c_custkey") % 1000, 3)).alias("code"), clean.parent_id(full).alias("parent"))


@query("p37_literal_list", "SELECT n_nationkey AS k, unnest(CASE WHEN n_nationkey % 2 = 0 THEN ['X' || n_name, 'Y' || n_name] ELSE [n_name] END) AS code FROM nation")
def literal_list(spark, d):
    text = F.expr("case when n_nationkey % 2 = 0 then concat(\"['X\", n_name, \"','Y\", n_name, \"']\") else n_name end")
    return spark.read.parquet(f"{d}/nation.parquet").select(F.col("n_nationkey").alias("k"), F.explode(clean.literal_list(text)).alias("code"))


LINES = "SELECT l_orderkey AS id, l_linenumber AS n, l_partkey AS part, l_suppkey AS supp, CASE WHEN l_quantity > 25 THEN l_quantity END AS height, CASE WHEN l_discount > 0.05 THEN l_discount END AS age, CASE WHEN l_tax > 0.04 THEN l_tax END AS type, l_extendedprice AS price FROM lineitem"


def _lines(spark, d):
    spark.read.parquet(f"{d}/lineitem.parquet").createOrReplaceTempView("lineitem")
    return spark.sql(LINES)


NULLS = "(CASE WHEN height IS NULL THEN 1 ELSE 0 END + CASE WHEN age IS NULL THEN 1 ELSE 0 END + CASE WHEN type IS NULL THEN 1 ELSE 0 END)"


@query(
    "w01_fewest_nulls",
    f"""WITH l AS ({LINES}), a AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {NULLS}, n, part, supp, price) AS r FROM l),
b AS (SELECT *, row_number() OVER (PARTITION BY part, supp ORDER BY {NULLS}, id, n, part, supp, price) AS q FROM a WHERE r = 1) SELECT id, n, part, supp, price FROM b WHERE q = 1""",
)
def fewest_nulls(spark, d):
    rows = _lines(spark, d)
    nulls = ("height", "age", "type")
    first = dedup.fewest_nulls(rows, "id", ["id"], nulls, ("n", "part", "supp", "price"))
    return dedup.fewest_nulls(first, "id", ["part", "supp"], nulls, ("id", "n", "part", "supp", "price")).select("id", "n", "part", "supp", "price")


@query(
    "w02_w03_numbered_ids",
    ctes("fx_release") + """SELECT id AS old_id, city_id || '-' || CAST(row_number() OVER (PARTITION BY city_id ORDER BY k) - 1 AS VARCHAR) AS id,
  'v1-' || region_id || '-' || CAST(row_number() OVER (PARTITION BY region_id ORDER BY k) - 1 AS VARCHAR) AS merge_id FROM fx_release""",
)
def numbered_ids(spark, d):
    rows = fixture(spark, d, "fx_release")
    rows = dedup.numbered(dedup.numbered(rows.select("id", "k", "city_id", "region_id"), ["city_id"], ["k"], "in_city"), ["region_id"], ["k"], "in_region")
    return rows.select(F.col("id").alias("old_id"), F.concat_ws("-", "city_id", "in_city").alias("id"), F.concat_ws("-", F.lit("v1"), "region_id", "in_region").alias("merge_id"))


@query("w04_running_ids", ctes("fx_gov") + "SELECT id AS old_id, source_file || '_' || CAST(row_number() OVER (PARTITION BY source_file ORDER BY k) - 1 AS VARCHAR) AS id FROM fx_gov")
def running_ids(spark, d):
    """Ids of datasets without any: the source file and a running number."""
    rows = fixture(spark, d, "fx_gov")
    rows = dedup.numbered(rows.select("id", "k", "source_file"), ["source_file"], ["k"])
    return rows.select(F.col("id").alias("old_id"), F.concat_ws("_", "source_file", "n").alias("id"))


@query("w05_duplicate_counts", "SELECT (SELECT count(*) FROM lineitem) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem)) AS n_distinct, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS n_keys")
def duplicate_counts(spark, d):
    return dedup.duplicate_counts(spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber"])


@query(
    "w06_keep_largest",
    f"WITH l AS ({LINES}) SELECT id, max(price) AS largest, min(price) AS smallest FROM l GROUP BY id",
)
def keep_largest(spark, d):
    rows = _lines(spark, d)
    most = dedup.keep_largest(rows, ["id"], "price", ["n", "part"]).select("id", F.col("price").alias("largest"))
    return most.join(dedup.keep_smallest(rows, ["id"], "price", ["n", "part"]).select("id", F.col("price").alias("smallest")), "id")


@query(
    "w07_unique_ids",
    f"""WITH l AS ({LINES}), a AS (SELECT DISTINCT CAST(id AS VARCHAR) AS id, n, part, supp, price FROM l), b AS (SELECT *, count(*) OVER (PARTITION BY id) AS c, row_number() OVER (PARTITION BY id ORDER BY n, part, supp, price) - 1 AS k FROM a)
SELECT CASE WHEN c > 1 THEN id || '_' || CAST(k AS VARCHAR) ELSE id END AS id, n, part, price FROM b""",
)
def unique_ids(spark, d):
    rows = _lines(spark, d).select(F.col("id").cast("string").alias("id"), "n", "part", "supp", "price").distinct()
    return dedup.unique_ids(rows, "id", ["n", "part", "supp", "price"]).select("id", "n", "part", "price")


@query(
    "w08_dissolve",
    f"WITH l AS ({LINES}) SELECT id, min(height) AS height, count(*) AS n_parts FROM l GROUP BY id",
)
def dissolve(spark, d):
    out = dedup.dissolve(_lines(spark, d), "id", ["height", "n", "part"], ["height"])
    return out.select("id", "height", "n_parts")


@query("w09_a14_most_frequent", "SELECT c_nationkey AS k, c_mktsegment AS category FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_mktsegment) AS r FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2)) WHERE r = 1")
def most_frequent(spark, d):
    from ..operators.merge import most_frequent as most

    return most(spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_nationkey").alias("k"), F.col("c_mktsegment").alias("category")), "k", "category")


@query("w12_duplicate_members", "SELECT l_orderkey AS id, l_linenumber AS n, l_partkey AS part FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS c FROM lineitem) WHERE c > 1")
def duplicate_members(spark, d):
    return dedup.duplicate_members(spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("part")), ["id", "n"])


@query("w13_unique_by_area", "SELECT DISTINCT l_orderkey AS id, round(l_quantity) AS area FROM lineitem")
def unique_by_area(spark, d):
    return spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_orderkey").alias("id"), F.round("l_quantity").alias("area")).dropDuplicates(["id", "area"])


@query("w14_share_of_group", f"WITH l AS ({LINES}) SELECT id, n, part, price, round(coalesce(CAST(price AS DOUBLE)/nullif(sum(CAST(price AS DOUBLE)) OVER (PARTITION BY id),0), CAST(count(*) OVER (PARTITION BY id) AS DOUBLE)), 6) AS share FROM l")
def share_of_group(spark, d):
    rows = _lines(spark, d)
    return rows.select("id", "n", "part", "price", F.round(dedup.share_of_group(rows, "id", "price"), 6).alias("share"))


@query("o01_sorted_release", ctes("fx_release") + "SELECT geometry_source, region_id, city_id, id FROM fx_release ORDER BY 1, 2, 3, 4")
def sorted_release(spark, d):
    return fixture(spark, d, "fx_release").select("geometry_source", "region_id", "city_id", "id").orderBy("geometry_source", "region_id", "city_id", "id")


@query("o03_random_sample", ctes("fx_release") + "SELECT id, height FROM fx_release ORDER BY md5(id || '7'), id LIMIT 20")
def random_sample(spark, d):
    """A sample that a seed repeats: the least hashes."""
    return fixture(spark, d, "fx_release").orderBy(F.md5(F.concat("id", F.lit("7"))), "id").limit(20).select("id", "height")


@query("a06_o04_country_counts", ctes("fx_release") + "SELECT substr(region_id,1,2) AS country, count(*) AS n FROM fx_release WHERE geometry_source <> 'msft' GROUP BY 1 ORDER BY 2 DESC, 1")
def country_counts(spark, d):
    return fixture(spark, d, "fx_release").where("geometry_source <> 'msft'").groupBy(F.substring("region_id", 1, 2).alias("country")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "country")


@query(
    "a15_duplicate_means",
    f"WITH l AS ({LINES}) SELECT id, round(avg(height), 6) AS height, round(avg(age), 6) AS age, array_to_string(list_sort(list(CAST(supp AS VARCHAR))), ',') AS sources FROM l GROUP BY id",
)
def duplicate_means(spark, d):
    return _lines(spark, d).groupBy("id").agg(F.round(F.avg("height"), 6).alias("height"), F.round(F.avg("age"), 6).alias("age"), F.array_join(F.sort_array(F.collect_list(F.col("supp").cast("string"))), ",").alias("sources"))


@query(
    "a16_top_values",
    "SELECT c_nationkey AS region, c_mktsegment AS value, n, round(n / total, 6) AS share, n > 100 AS frequent FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_mktsegment) AS r, sum(n) OVER (PARTITION BY c_nationkey) AS total FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2)) WHERE r <= 50",
)
def top_values(spark, d):
    from pyspark.sql import Window

    counts = spark.read.parquet(f"{d}/customer.parquet").groupBy(F.col("c_nationkey").alias("region"), F.col("c_mktsegment").alias("value")).agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("region").orderBy(F.desc("n"), "value"))
    share = F.round(F.col("n") / F.sum("n").over(Window.partitionBy("region")), 6)
    return counts.withColumns({"place": place, "share": share}).where("place <= 50").select("region", "value", "n", "share", (F.col("n") > 100).alias("frequent"))


@query("a17_type_coverage", ctes("fx_gov") + "SELECT source_file, count(*) AS n, count(type_source) AS counted, count(*) - count(type_source) AS missing, round(count(*) FILTER (WHERE starts_with(type_source,'HOUSEHOLD')) / count(type_source), 6) AS residential FROM fx_gov GROUP BY 1")
def type_coverage(spark, d):
    return fixture(spark, d, "fx_gov").groupBy("source_file").agg(
        F.count("*").alias("n"), F.count("type_source").alias("counted"), (F.count("*") - F.count("type_source")).alias("missing"), F.round(F.count_if(F.col("type_source").startswith("HOUSEHOLD")) / F.count("type_source"), 6).alias("residential")
    )
