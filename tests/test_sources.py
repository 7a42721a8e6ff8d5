"""Readers and writers on a temporary folder."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from cadastra.sources import tables


def test_regions_and_files(spark, tmp_path):
    for name in ("AT1", "AT2", "DE1"):
        spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/{name}")
        part = next((tmp_path / name).glob("part-*.parquet"))
        part.rename(tmp_path / f"{name}.parquet")
    spark.range(2).write.parquet(f"{tmp_path}/AT3.parquet")
    files = [r.path.rsplit("/", 1)[1] for r in tables.list_files(spark, str(tmp_path), r"^AT\d\.parquet$").collect()]
    assert sorted(files) == ["AT1.parquet", "AT2.parquet"]
    rows = tables.read_regions(spark, str(tmp_path), "AT")
    assert {r.region_id for r in rows.select("region_id").distinct().collect()} == {"AT1", "AT2", "AT3"}


def test_release_is_resumed(spark, tmp_path):
    rows = spark.range(40).select(F.col("id"), F.concat(F.lit("R"), F.col("id") % 4).alias("region_id"), F.lit("c").alias("city_id"), F.lit("g").alias("geometry_source"))
    out = f"{tmp_path}/out"
    assert tables.missing_regions(rows, out).count() == 40
    tables.write_regions(rows.where("region_id in ('R0', 'R1')"), out)
    # cut off half-way: rows of R2 and R3 are there without a mark
    tables.write_release(rows.where("region_id in ('R2', 'R3') and id < 20"), out)
    assert {r.region_id for r in tables.missing_regions(rows, out).collect()} == {"R2", "R3"}
    before = sorted(p.name for p in (tmp_path / "out" / "nuts_id=R1").glob("part-*"))
    tables.write_regions(rows, out)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(40))
    assert sorted(p.name for p in (tmp_path / "out" / "nuts_id=R1").glob("part-*")) == before
    assert tables.missing_regions(rows, out).isEmpty()
    assert tables.read_partitions(spark, out, "R1").count() == 10


def test_lat_lon_is_sorted(spark, tmp_path):
    rows = spark.range(10).select(F.col("id"), F.lit("r").alias("region_id"), (10 - F.col("id")).alias("city_id"), F.lit("g").alias("geometry_source"))
    tables.write_lat_lon(rows, f"{tmp_path}/ll")
    assert [r.city_id for r in spark.read.parquet(f"{tmp_path}/ll").coalesce(1).collect()] == list(range(1, 11))


def test_a_box_reads_few_row_groups(spark, tmp_path):
    x, y = (F.col("id") * 7919 % 20_011).cast("double"), (F.col("id") * 104_729 % 20_021).cast("double")
    rows = spark.range(20_000).select("id", F.lit("R").alias("region_id"), F.lit("c").alias("city_id"), F.lit("g").alias("geometry_source"), F.struct(x.alias("xmin"), y.alias("ymin"), (x + 9).alias("xmax"), (y + 9).alias("ymax")).alias("bbox"))
    tables.write_release(rows, f"{tmp_path}/curve", box="bbox", group_rows=500)
    tables.write_release(rows, f"{tmp_path}/plain", group_rows=500)
    read = {}
    for name in ("curve", "plain"):
        found = tables.within_box(spark.read.parquet(f"{tmp_path}/{name}"), 5000, 5000, 8000, 8000)
        ids = sorted(r.id for r in found.select("id").collect())
        plan = found.select("id")._jdf.queryExecution().toString()
        assert "PushedFilters: [" in plan and "IsNotNull(bbox.xmin)" in plan
        groups = [(g.column(i).statistics for i in range(g.num_columns) if g.column(i).path_in_schema in ("bbox.xmin", "bbox.ymin")) for f in (tmp_path / name).rglob("part-*.parquet") for g in map(pq.ParquetFile(f).metadata.row_group, range(pq.ParquetFile(f).metadata.num_row_groups))]
        spans = [tuple(groups_) for groups_ in groups]
        read[name] = (sum(sx.max > 5000 and sx.min < 8000 and sy.max > 5000 and sy.min < 8000 for sx, sy in spans), len(spans), ids)
    assert read["curve"][2] == read["plain"][2] == sorted(i for i in range(20_000) if 5000 < i * 7919 % 20_011 < 7991 and 5000 < i * 104_729 % 20_021 < 7991)
    assert read["plain"][0] == read["plain"][1] >= 40 and read["curve"][0] < 0.2 * read["curve"][1]
