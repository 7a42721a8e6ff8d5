"""Building tables derived from the given tables; the SQL runs in Spark and DuckDB alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geom

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages")

VIEWS = {
    "fx_base": """SELECT o.o_orderkey AS k, o.o_custkey AS c, o.o_orderkey % 128 AS gx,
       CAST(floor(o.o_orderkey / 128.0) AS BIGINT) AS gy, o.o_totalprice AS price,
       o.o_orderpriority AS prio, o.o_orderstatus AS status, year(o.o_orderdate) AS yr, cu.c_mktsegment AS seg
  FROM orders o JOIN customer cu ON o.o_custkey = cu.c_custkey""",
    "fx_gov": """SELECT 'g' || CAST(k AS STRING) AS id, k,
       CAST(gx*30 + c%5 AS DOUBLE) AS xmin, CAST(gy*30 + c%7 AS DOUBLE) AS ymin,
       CAST(gx*30 + c%5 + 8 + c%9 AS DOUBLE) AS xmax, CAST(gy*30 + c%7 + 6 + c%11 AS DOUBLE) AS ymax,
       CASE WHEN c%3=0 THEN NULL ELSE CAST(3 + k%40 AS DOUBLE) END AS height,
       CASE WHEN c%4=0 THEN NULL ELSE CAST(1 + k%12 AS DOUBLE) END AS floors,
       CASE WHEN c%5=0 THEN NULL ELSE CAST(yr AS DOUBLE) END AS age,
       CASE WHEN c%6=0 THEN NULL ELSE seg || '_' || substr(prio,1,1) END AS type_source,
       'src_' || status AS source_file FROM fx_base WHERE k % 10 < 6""",
    "fx_osm": """SELECT 'o' || CAST(k AS STRING) AS id, k,
       CAST(gx*30 + (c*7)%13 AS DOUBLE) AS xmin, CAST(gy*30 + (c*5)%11 AS DOUBLE) AS ymin,
       CAST(gx*30 + (c*7)%13 + 7 + (c*3)%10 AS DOUBLE) AS xmax, CAST(gy*30 + (c*5)%11 + 6 + c%8 AS DOUBLE) AS ymax,
       CASE WHEN c%2=0 THEN NULL ELSE CAST(4 + k%30 AS DOUBLE) END AS height,
       CASE WHEN c%3=1 THEN NULL ELSE CAST(1 + k%9 AS DOUBLE) END AS floors,
       CASE WHEN c%7=0 THEN NULL ELSE CAST(yr - 20 AS DOUBLE) END AS age,
       seg || '_' || substr(prio,1,1) AS type_source, 'osm' AS source_file FROM fx_base WHERE k % 10 > 1
UNION ALL
SELECT 'p' || CAST(k AS STRING), k, CAST(gx*30 AS DOUBLE), CAST(gy*30 + c%4 AS DOUBLE),
       CAST(gx*30 + 5 + c%4 AS DOUBLE), CAST(gy*30 + c%4 + 9 AS DOUBLE),
       CAST(5 + k%20 AS DOUBLE), CAST(2 + k%5 AS DOUBLE), CAST(yr AS DOUBLE),
       seg || '_' || substr(prio,1,1), 'osm' FROM fx_base WHERE k % 4 = 0
UNION ALL
SELECT 'q' || CAST(k AS STRING), k, gx*30 + c%5 + CAST(1.375 AS DOUBLE), gy*30 + c%7 + CAST(1.5 AS DOUBLE),
       gx*30 + c%5 + CAST(1.875 AS DOUBLE), gy*30 + c%7 + CAST(2 AS DOUBLE),
       CAST(2 AS DOUBLE), CAST(1 AS DOUBLE), CAST(yr AS DOUBLE),
       seg || '_' || substr(prio,1,1), 'osm' FROM fx_base WHERE k % 10 = 1""",
    "fx_msft": """SELECT 'm' || CAST(k AS STRING) AS id, k,
       CAST(gx*30 + c%10 AS DOUBLE) AS xmin, CAST(gy*30 + c%9 AS DOUBLE) AS ymin,
       CAST(gx*30 + c%10 + 9 AS DOUBLE) AS xmax, CAST(gy*30 + c%9 + 9 AS DOUBLE) AS ymax,
       CASE WHEN c%8=0 THEN CAST(-1 AS DOUBLE) ELSE CAST(k%25 AS DOUBLE) END AS height FROM fx_base""",
    "fx_lau": """SELECT DISTINCT substr('ATCHDEFRIT', 1 + 2*(CAST(floor(gy/8.0) AS INT) % 5), 2)
         || lpad(CAST(CAST(floor(gx/8.0) AS INT) AS STRING), 2, '0') || lpad(CAST(CAST(floor(gy/8.0) AS INT) AS STRING), 3, '0') AS LAU_ID,
       substr('ATCHDEFRIT', 1 + 2*(CAST(floor(gy/8.0) AS INT) % 5), 2) || lpad(CAST(CAST(floor(gx/32.0) AS INT) AS STRING), 3, '0') AS NUTS_ID_3,
       floor(gx/8.0)*240.0 + 10 AS xmin, floor(gy/8.0)*240.0 + 10 AS ymin,
       floor(gx/8.0)*240.0 + 250 AS xmax, floor(gy/8.0)*240.0 + 250 AS ymax FROM fx_base""",
    "fx_crosswalk": """SELECT DISTINCT seg || '_' || substr(prio,1,1) AS type_source,
       CASE WHEN prio='5-LOW' THEN 'gov-A,osm' ELSE 'gov-A,gov-B,osm' END AS source_datasets,
       CASE seg WHEN 'AUTOMOBILE' THEN 'industrial' WHEN 'BUILDING' THEN 'commercial'
                WHEN 'FURNITURE' THEN 'public' WHEN 'HOUSEHOLD' THEN 'residential' ELSE 'agricultural' END AS type,
       CASE WHEN seg <> 'HOUSEHOLD' THEN NULL WHEN prio='1-URGENT' THEN 'apartment block'
            WHEN prio='2-HIGH' THEN 'terraced house' WHEN prio='3-MEDIUM' THEN 'semi-detached duplex house'
            ELSE 'detached single-family house' END AS residential_type,
       (seg='MACHINERY' AND prio='5-LOW') AS remove FROM fx_base""",
    "fx_pred": """SELECT 'g' || CAST(k AS STRING) AS id,
       CAST(5 + k%35 AS DOUBLE) AS height_pred, CAST(4 + k%35 AS DOUBLE) AS height_confidence_lower, CAST(7 + k%35 AS DOUBLE) AS height_confidence_upper,
       CAST(1 + k%10 AS DOUBLE) AS floors_pred, CAST(1 + k%9 AS DOUBLE) AS floors_confidence_lower, CAST(2 + k%11 AS DOUBLE) AS floors_confidence_upper,
       CASE c%4 WHEN 0 THEN 'residential' WHEN 1 THEN 'industrial' WHEN 2 THEN 'agricultural' ELSE 'commercial' END AS type_pred,
       CAST((50 + c%50)/100.0 AS DOUBLE) AS type_confidence, CAST((60 + c%40)/100.0 AS DOUBLE) AS binary_type_confidence,
       CASE c%3 WHEN 0 THEN 'apartment block' ELSE 'terraced house' END AS residential_type_pred,
       CAST((40 + c%60)/100.0 AS DOUBLE) AS residential_type_confidence,
       CASE WHEN c%3=0 THEN NULL ELSE CAST(3 + k%40 AS DOUBLE) END AS height_true,
       CASE WHEN c%9=0 THEN NULL ELSE CAST(k%25 AS DOUBLE) END AS bldg_msft_height,
       CASE WHEN c%4=0 THEN NULL ELSE CAST(1 + k%12 AS DOUBLE) END AS floors_true,
       CASE WHEN c%6=0 THEN NULL WHEN c%2=0 THEN 'residential' ELSE 'industrial' END AS type_true,
       substr('ATCHDEFRIT', 1 + 2*(CAST(floor(gy/8.0) AS INT) % 5), 2) AS region_id
  FROM fx_base WHERE k % 10 < 6""",
    "fx_osm_raw": """SELECT event_id AS id,
       CASE WHEN event_id%4=0 THEN NULL WHEN event_id%4=1 THEN CAST(user_id AS STRING) || '.5 m'
            WHEN event_id%4=2 THEN 'ca. ' || CAST(user_id AS STRING) ELSE 'tall' END AS height,
       CASE WHEN event_id%3=0 THEN NULL ELSE CAST(1900 + user_id%130 AS STRING) || '-05-01' END AS start_date,
       CASE event_type WHEN 'view' THEN 'yes' WHEN 'error' THEN NULL ELSE event_type END AS building,
       CASE WHEN event_id%5=0 THEN 'yes' WHEN event_id%5=1 THEN 'school' ELSE NULL END AS amenity FROM events""",
    # two sites of one building each, with the unit that holds them, as a published table
    "fx_release": """SELECT g.id, g.k, g.xmin, g.ymin, g.xmax, g.ymax, g.height, g.floors, g.age AS construction_year,
       CASE WHEN x.type IS NULL THEN NULL WHEN x.type = 'residential' THEN 'residential' ELSE 'non-residential' END AS type,
       CASE WHEN x.type = 'residential' THEN CASE x.residential_type WHEN 'semi-detached duplex house' THEN 'semi-detached'
            WHEN 'detached single-family house' THEN 'detached' WHEN 'terraced house' THEN 'terraced' ELSE 'apartment' END ELSE x.type END AS subtype,
       CASE g.k % 3 WHEN 0 THEN 'gov-a' WHEN 1 THEN 'osm' ELSE 'msft' END AS geometry_source,
       CASE WHEN g.height IS NULL THEN NULL WHEN g.k % 4 = 0 THEN 'estimated' WHEN g.k % 4 = 1 THEN 'osm' ELSE 'gov-a' END AS height_source,
       CASE WHEN g.floors IS NULL THEN NULL WHEN g.k % 5 = 0 THEN 'estimated' WHEN g.k % 5 < 3 THEN 'osm' ELSE 'gov-a' END AS floors_source,
       CASE WHEN g.age IS NULL OR g.k % 7 = 0 THEN NULL WHEN g.k % 5 = 1 THEN 'osm' ELSE 'gov-a' END AS construction_year_source,
       CASE WHEN x.type IS NULL THEN NULL WHEN g.k % 6 = 0 THEN 'estimated' WHEN g.k % 6 < 4 THEN 'osm' ELSE 'gov-a' END AS type_source,
       CASE WHEN x.type IS NULL THEN NULL WHEN g.k % 6 = 0 THEN 'estimated' WHEN g.k % 6 < 3 THEN 'osm' ELSE 'gov-a' END AS subtype_source,
       CASE WHEN g.k % 4 = 0 THEN CAST((50 + g.k % 50) / 100.0 AS DOUBLE) ELSE NULL END AS type_confidence,
       CASE WHEN g.k % 4 = 0 THEN g.height - 1 ELSE NULL END AS height_confidence_lower,
       CASE WHEN g.k % 4 = 0 THEN g.height + g.k % 3 ELSE NULL END AS height_confidence_upper,
       substr('ATCHDEFRIT', 1 + 2*(CAST(floor(g.ymin/240.0) AS INT) % 5), 2) || lpad(CAST(CAST(floor(g.xmin/960.0) AS INT) AS STRING), 3, '0') AS region_id,
       'c' || CAST(CAST(floor(g.xmin/240.0) AS INT) AS STRING) || '_' || CAST(CAST(floor(g.ymin/240.0) AS INT) AS STRING) AS city_id
  FROM fx_gov g LEFT JOIN fx_crosswalk x ON g.type_source = x.type_source""",
}


# footprints: some lack their corner beyond (nx, ny), some have a courtyard (cx0, cy0, cx1, cy1), in which a shed of another
# source may stand, some a second part, a square of side ``wing`` from (ax, ymin) on; wx is where all of it ends. Quarters keep borders apart from centres
_PARTS = {"fx_gov": ("k % 3 = 0", "k % 5 = 1", "k % 7 = 2"), "fx_osm": ("k % 3 = 1", "k % 11 = 3 AND xmax - xmin >= 5", "k % 13 = 5")}
for _name in ("fx_gov", "fx_osm", "fx_msft", "fx_lau"):
    _ell, _court, _wing = _PARTS.get(_name, ("false", "false", "false"))
    VIEWS[_name] = f"""SELECT *, CASE WHEN {_ell} THEN xmin + floor((xmax - xmin) / 2) + 0.25 ELSE xmax END AS nx,
       CASE WHEN {_ell} THEN ymin + floor((ymax - ymin) / 2) + 0.25 ELSE ymax END AS ny,
       CASE WHEN {_court} THEN xmin + 1.25 ELSE xmin END AS cx0, CASE WHEN {_court} THEN ymin + 1.25 ELSE ymin END AS cy0,
       CASE WHEN {_court} THEN xmin + 2 ELSE xmin END AS cx1, CASE WHEN {_court} THEN ymin + 2.25 ELSE ymin END AS cy1,
       CASE WHEN {_wing} THEN xmax + 1 ELSE xmin END AS ax, CAST(CASE WHEN {_wing} THEN 2 ELSE 0 END AS DOUBLE) AS wing,
       CASE WHEN {_wing} THEN xmax + 3 ELSE xmax END AS wx FROM ({VIEWS[_name]})"""

# the units, and those of one country once more where no building stands
VIEWS["fx_units"] = """SELECT * FROM fx_lau UNION ALL
SELECT LAU_ID || 'S', NUTS_ID_3 || 'S', xmin, ymin + 10000000, xmax, ymax + 10000000, nx, ny + 10000000, cx0, cy0 + 10000000, cx1, cy1 + 10000000, ax, wing, wx
  FROM fx_lau WHERE substr(LAU_ID, 1, 2) = 'IT'"""

#: Columns of a footprint's outline.
OUTLINE = "xmin, ymin, xmax, ymax, nx, ny, cx0, cy0, cx1, cy1, ax, wing, wx"


def ctes(*names: str) -> str:
    """WITH clause for the views named and those they stand on."""
    wanted: list[str] = []
    for name in VIEWS:
        if any(name == n or name in VIEWS[n] or (name == "fx_base" and n.startswith("fx_")) for n in names) or any(name in VIEWS[w] for w in names if w in VIEWS):
            wanted.append(name)
    need = set(wanted)
    for name in list(need):
        need |= {v for v in VIEWS if v in VIEWS[name]}
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS[v]})" for v in VIEWS if v in need) + "\n"


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table as a DataFrame."""
    used = ctes(name)
    for table in TABLES:
        if table in used:
            spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    return spark.sql(f"{used} SELECT * FROM {name}")


def shapes(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of footprints as shapes with their boxes."""
    box = [F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")]
    main = F.when(F.col("nx") < F.col("xmax"), geom.ell(*box, F.col("nx"), F.col("ny"))).otherwise(geom.rectangle(*box))
    court = F.reverse(geom.rectangle(*[F.col(c) for c in ("cx0", "cy0", "cx1", "cy1")]))
    wing = geom.rectangle(F.col("ax"), F.col("ymin"), F.col("ax") + F.col("wing"), F.col("ymin") + F.col("wing"))
    none = F.slice(F.array(court), 1, 0)
    shape = F.concat(F.array(main), F.when(F.col("cx0") < F.col("cx1"), F.array(court)).otherwise(none), F.when(F.col("wing") > 0, F.array(wing)).otherwise(none))
    return fixture(spark, sf_dir, name).withColumn("shape", shape).withColumn("xmax", F.col("wx")).drop("nx", "ny", "cx0", "cy0", "cx1", "cy1", "ax", "wing", "wx")
