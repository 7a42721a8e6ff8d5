"""Written intermediate tables in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, one of a local session; on a cluster that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir is not set: executors share no folder")
    return f"file://{tempfile.gettempdir()}/shared-{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet and read again: cuts lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """As :func:`written`, in spark.sql.shuffle.partitions buckets of ``key``: joins on it do not move these rows."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("compression", "zstd").option("path", f"{shared_dir(spark)}/{table}")
    writer.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).saveAsTable(table)
    return spark.table(table)


#: Rows of texts that go to a Python worker at once.
BATCH_ROWS = 1000


def text_batches(df: DataFrame) -> None:
    """Make the session's Arrow batches small, if larger: rows here hold whole texts, and workers share an executor's memory.

    The setting is read when a frame runs, so it stays until the caller changes it.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(name)) <= BATCH_ROWS:
        df.sparkSession.conf.set(name, BATCH_ROWS)


#: Rows of ids or keys that are broadcast; more are shuffled. Their hash table takes up to some 130 bytes a row in the driver.
BROADCAST_ROWS = 500_000


def sized(df: DataFrame) -> DataFrame:
    """A written frame of short rows, marked for broadcast if it has BROADCAST_ROWS or fewer."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def bounded(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A written frame of short rows that a join may broadcast only if it has BROADCAST_ROWS or fewer; ``rows``: their number, if known.

    Spark takes the compressed size of the columns read for the size of a written
    table. For numbers that rise by one that is a thirtieth of the hash table,
    which the driver builds, so tables of millions of rows would be broadcast.
    """
    return unbroadcast(df) if (df.count() if rows is None else rows) > BROADCAST_ROWS else df


def unbroadcast(df: DataFrame) -> DataFrame:
    """The frame with a mark that joins with it, or with what is selected from it, move both sides."""
    return df.hint("merge")


def distinct_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per distinct non-null text: key (MD5, 16 bytes), text, copies.

    Copies are combined before the shuffle, so a text that holds a third of all
    rows costs one row per input partition. Callers hand on all three columns:
    Spark then sees the same exchange each time and runs it once.
    """
    own = docs.select(F.col(text).cast("string").alias("text")).where(F.col("text").isNotNull())
    return (
        own.withColumn("key", text_key("text"))
        # joins on the key put this condition under the exchange; where all plans have it they share one
        .where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    )


def text_key(text: str):
    return F.unhex(F.md5(F.col(text).cast("binary")))
