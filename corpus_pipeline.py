"""Corpus pipeline: toxicity, near duplicates, repeats, source mixing, packing.

Each stage takes (spark, docs, sf_dir), ``docs`` being what the stage before
kept, and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm.jaccard_join import text_components
from cadastra.llm.mixing import mix
from cadastra.llm.packing import pack, pieces
from cadastra.llm.queries import word_vocabulary
from cadastra.llm.storage import shared_dir, sized, text_key, written
from cadastra.llm.substring_dedup import remove_repeats
from cadastra.llm.toxicity import held_out, score, train

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not predict to be toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out("doc_id"))
    model = train(docs.select("doc_id", "text"), labels)
    return score(docs.select(*COLUMNS), model, keep_text=True).where("predicted = 0").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each near-duplicate group, and all without words."""
    classes = text_components(docs.select("doc_id", "text")).where("class is not null").select("key", "class")
    rows = docs.select(*COLUMNS, text_key("text").alias("_key"))
    held = rows.select("doc_id", F.col("_key").alias("key")).join(classes, "key").groupBy("class", "doc_id", "key").agg(F.count(F.lit(1)).alias("n"))
    held = written(held, "held")
    first = held.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("m"))
    first = first.select("class", F.col("m.doc_id").alias("first_id"), F.col("m.key").alias("first_key"))
    ranked = held.join(first, "class").withColumn("chosen", F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("key") == F.col("first_key")))
    ranked = written(ranked.where("not chosen or n > 1").select(F.col("doc_id").alias("_id"), F.col("key").alias("_row"), "chosen"), "ranked")
    same = (F.col("_key") == F.col("_row")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    out = rows.join(sized(ranked), same, "left_anti")
    if not (again := ranked.where("chosen")).isEmpty():
        # rows that are there several times stay once
        out = out.unionByName(rows.join(sized(again), same, "left_semi").dropDuplicates(["doc_id", "_key"]))
    return out.select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages; a document without one keeps its text as it is."""
    out = remove_repeats(docs.select(*COLUMNS))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return out.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of the mixed sequence."""
    return mix(docs.select(*COLUMNS)).orderBy("position", "place").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences, which are numbered along the mixed order."""
    # the mix depends on ids and sources alone, so it is the one that the stage before wrote
    rank = (F.col("position") * 2**32 + F.col("place")).alias("rank")
    ranks = mix(docs.select("doc_id", "source")).select("doc_id", "source", rank).groupBy("doc_id", "source").agg(F.min("rank").alias("rank"))
    ranks = sized(written(ranks.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), "rank"), "ranks"))
    own = written(pieces(docs.select("doc_id", "source", "text"), word_vocabulary()), "own")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source"))
    out = pack(own.join(ranks, same).drop("_id", "_source", "source"), order="rank")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("mixing", mixing),
    ("packing", packing),
]

#: Neither the classifier nor the packing can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
