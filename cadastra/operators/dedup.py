"""Ids, de-duplication and ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import sized, written


def _first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column | str]) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def fewest_nulls(df: DataFrame, id: str, geometry: Sequence[str], attrs: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """One row per id, then one per geometry: the one with the fewest nulls in ``attrs``."""
    nulls = sum(F.col(c).isNull().cast("int") for c in attrs)
    order = [nulls, *[F.col(t) for t in tie]]
    return _first(_first(df, [id], order), geometry, order)


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "n") -> DataFrame:
    """Column ``name``: the running number from 0 within the group, in order; a null group is one, too.

    Rows are written by ranges of group and order, so a group of any size lies in
    many ranges. Each range counts its rows by group; a group's earlier ranges
    give where its numbers begin in the next. No task holds a whole group.
    Rows that are equal in group and order are numbered as they come.
    """
    columns = [c for c in df.columns if c != name]
    key = F.to_json(F.struct(*group)) if group else F.lit("")
    keyed = df.repartitionByRange(*group, *order).withColumns({"_p": F.spark_partition_id(), "_g": key})
    ranged = written(keyed, "ranges")
    counts = ranged.groupBy("_g", "_p").agg(F.count(F.lit(1)).alias("_c"))
    # a row for each range that a group is in, no more than there are shuffle partitions
    before = F.sum("_c").over(Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    starts = written(counts.select("_g", "_p", F.coalesce(before, F.lit(0)).alias("_b")), "starts")
    place = F.row_number().over(Window.partitionBy("_p", "_g").orderBy(*order)) - 1
    out = ranged.withColumn("_at", place).join(sized(starts), ["_p", "_g"])
    return out.select(*columns, (F.col("_b") + F.col("_at")).alias(name))


def keep_largest(df: DataFrame, key: Sequence[str], value: str, tie: Sequence[str]) -> DataFrame:
    return _first(df, list(key), [F.desc(value), *tie])


def keep_smallest(df: DataFrame, key: Sequence[str], value: str, tie: Sequence[str]) -> DataFrame:
    return _first(df, list(key), [F.asc(value), *tie])


def unique_ids(df: DataFrame, id: str, order: Sequence[str]) -> DataFrame:
    """Ids that occur more than once get '_' and a running number from 0."""
    n = F.count(F.lit(1)).over(Window.partitionBy(id))
    k = F.row_number().over(Window.partitionBy(id).orderBy(*order)) - 1
    return df.withColumns({"_n": n, "_k": k}).withColumn(id, F.when(F.col("_n") > 1, F.concat_ws("_", id, "_k")).otherwise(F.col(id).cast("string"))).drop("_n", "_k")


def duplicate_members(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of groups of more than one."""
    return df.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys))).where("_n > 1").drop("_n")


#: Rows that a task counts.
COUNTED_ROWS = 500_000


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, rows after dropping identical ones, and rows after dropping repeated keys.

    Rows are dealt by key to partitions of about COUNTED_ROWS, so the memory of a task
    does not grow with the table; only a key of more rows than that goes beyond it.
    """
    dealt = df.repartition(df.count() // COUNTED_ROWS + 1, *keys)
    grouped = dealt.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    keyed = grouped.groupBy(*keys).agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("kept"))
    return keyed.agg(F.sum("rows").alias("n_rows"), F.sum("kept").alias("n_distinct"), F.count(F.lit(1)).alias("n_keys"))


def dissolve(df: DataFrame, id: str, order: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """One row per id: each attribute's first value that is not null, in the order given."""
    return df.groupBy(id).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c) for c in attrs], F.count(F.lit(1)).alias("n_parts"))


def share_of_group(df: DataFrame, group: str, value: str) -> Column:
    """Share of the group's total; the group's size where that is 0."""
    w = Window.partitionBy(group)
    return F.coalesce(F.try_divide(F.col(value).cast("double"), F.sum(value).over(w)), F.count(F.lit(1)).over(w).cast("double"))


def split_parts(df: DataFrame, n: int, order: Sequence[str], folder: str) -> DataFrame:
    """Column ``part`` of n runs of rows in order, sizes at most one apart, the remainder to the first ones.

    Rows are written to ``folder`` by ranges, with their partition's number, and
    read from there, so that counts and rows agree; no task holds all of them.
    """
    df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()).write.parquet(folder)
    ranged = df.sparkSession.read.parquet(folder)
    counts = {r[0]: r[1] for r in ranged.groupBy("_p").agg(F.count(F.lit(1))).collect()}  # a row per partition
    before, total = [], 0
    for p in sorted(counts):
        before.append((p, total))
        total += counts[p]
    starts = df.sparkSession.createDataFrame(before, "_p int, _b long")
    small, extra = divmod(total, n)
    at = F.col("_b") + F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1
    part = F.when(at < extra * (small + 1), F.floor(at / (small + 1))).otherwise(extra + F.floor((at - extra * (small + 1)) / max(small, 1)))
    return ranged.join(F.broadcast(starts), "_p").withColumn("part", part.cast("int")).select(*df.columns, "part")


def row_numbers(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Column ``n``: the row's number from 0 in the whole table, which no task holds."""
    return numbered(df, [], order)
