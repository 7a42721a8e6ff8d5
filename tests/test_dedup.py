"""Splits and numbers of whole tables over many partitions."""

from collections import Counter

from pyspark.sql import functions as F

from cadastra.operators import dedup


def test_parts_of_many_partitions(spark, tmp_path):
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 24)
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        rows = spark.range(40_000).select("id", F.repeat(F.md5(F.col("id").cast("string")), 16).alias("wide"))
        out = dedup.split_parts(rows, 7, ["id"], f"{tmp_path}/parts")
        ids = [(r.part, r.id) for r in out.select("part", "id").collect()]
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert sorted(i for _, i in ids) == list(range(40_000)) and out.columns == ["id", "wide", "part"]
    sizes = [n for _, n in sorted(Counter(p for p, _ in ids).items())]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)
    assert [i for _, i in sorted(ids)] == list(range(40_000))


def test_few_and_no_rows(spark, tmp_path):
    assert [r.part for r in dedup.split_parts(spark.range(3), 7, ["id"], f"{tmp_path}/few").orderBy("id").collect()] == [0, 1, 2]
    assert dedup.split_parts(spark.range(0), 7, ["id"], f"{tmp_path}/none").count() == 0


def test_row_numbers(spark):
    rows = dedup.row_numbers(spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")), ["k"])
    assert all(r.k == r.n for r in rows.collect()) and rows.count() == 1000


def test_numbers_within_groups_of_any_size(spark):
    # one group holds most rows, one is null, one has a single row
    group = F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 == 7, F.lit(None)).when(F.col("id") == 8, "one").otherwise(F.concat(F.lit("g"), (F.col("id") % 500).cast("string")))
    rows = spark.range(20_000).select("id", group.alias("g"), (F.col("id") * 7919 % 20_011).alias("k"), F.lit("clash").alias("n")).repartition(5)
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 24)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        out = dedup.numbered(rows, ["g"], ["k"])
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert out.columns == ["id", "g", "k", "n"]
    by: dict = {}
    for r in rows.collect():
        by.setdefault(r.g, []).append((r.k, r.id))
    want = {i: n for members in by.values() for n, (_, i) in enumerate(sorted(members))}
    assert {r.id: r.n for r in out.collect()} == want
    # the big group was numbered in many ranges, each read from a file of its own
    files = spark.read.parquet(*[f for f in out.inputFiles() if "/ranges-" in f]).where("g = 'big'").select("_p").distinct()
    assert files.count() > 12
    assert dedup.numbered(rows.where("false"), ["g"], ["k"]).count() == 0


def test_duplicates_are_counted_in_small_parts(spark, monkeypatch):
    monkeypatch.setattr(dedup, "COUNTED_ROWS", 100)
    rows = spark.range(1000).select((F.col("id") % 300).alias("k"), (F.col("id") % 500).alias("v")).unionByName(spark.createDataFrame([(None, 1), (None, 1)], "k long, v long"))
    out = dedup.duplicate_counts(rows, ["k"])
    assert "hashpartitioning(k" in (plan := out._jdf.queryExecution().executedPlan().toString()) and ", 11)" in plan
    assert tuple(out.first()) == (1002, len({(i % 300, i % 500) for i in range(1000)}) + 1, 301)
