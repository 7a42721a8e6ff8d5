"""The stages in order on the smallest table."""

import corpus_pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert out.columns == docs.columns
            docs = out
        counts.append(out.count())
    assert counts[0] > counts[1] >= counts[2] == counts[3] == counts[4] <= counts[5]
    assert out.where(F.col("length") > 2048).isEmpty()
    assert out.select("doc_id").distinct().count() == counts[4]


def test_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeats", "mixing", "packing"]


def test_sequences_follow_the_mix(spark):
    # sources in proportion 4 : 1 are mixed 2 : 1 while both last
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 16_000, "large").otherwise("small").alias("source"))
    docs = rows.select("doc_id", F.repeat(F.lit("some words "), (F.col("doc_id") * 7 % 90 + 10).cast("int")).alias("text"), F.lit("en").alias("lang"), "source", F.lit(1).cast("long").alias("n_chars"))
    out = corpus_pipeline.packing(spark, corpus_pipeline.mixing(spark, docs, SF), SF).join(rows, "doc_id").toPandas().sort_values("sequence_id")
    assert len(out) == 20_000
    for at in range(0, 8000, 4000):
        assert abs((out.source[at : at + 4000] == "small").mean() - 1 / 3) < 0.03
    assert (out.source[-4000:] == "large").mean() > 0.95
