"""Consistency between tables and stages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.validity import validity


def stacked(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def cover_faults(units: DataFrame, masks: DataFrame, *keys: str) -> DataFrame:
    """Units that masks name more than once, or not at all: (keys, n).

    All of ``keys`` together tell units apart, as codes may repeat; null is equal to null there.
    """
    named = masks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    # a row per key of either side, counted without a join, so that null keys meet
    sides = units.select(*keys, F.lit(0).cast("long").alias("n")).distinct().unionByName(named)
    return sides.groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 1")


def differing_rows(a: DataFrame, b: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Rows of one table only, tagged; fails where the lengths differ by ``tolerance`` or more."""
    n, m = a.count(), b.count()
    if abs(n - m) >= tolerance * max(n, 1):
        raise ValueError(f"{n} and {m} rows")
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def reassembly(geoms: DataFrame, attrs: DataFrame, id: str) -> DataFrame:
    """Lengths, repeated ids and ids of one side only."""
    sides = [df.agg(F.count(F.lit(1)).alias(f"n_{s}"), (F.count(F.lit(1)) - F.countDistinct(id)).alias(f"repeated_{s}")) for s, df in (("geoms", geoms), ("attrs", attrs))]
    alone = geoms.select(id).join(attrs, id, "left_anti").union(attrs.select(id).join(geoms, id, "left_anti")).agg(F.count(F.lit(1)).alias("unmatched"))
    one = F.lit(1).alias("one")
    joined = sides[0].select(one, "*").join(sides[1].select(one, "*"), "one").join(alone.select(one, "*"), "one")
    return joined.drop("one")


def unequal(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Keys whose value differs between two ways of working it out."""
    both = a.select(key, F.col(value).alias("left")).join(b.select(key, F.col(value).alias("right")), key, "full")
    return both.where(~F.col("left").eqNullSafe(F.col("right")))


def one_to_one(a: DataFrame, b: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """A join that fails where a side repeats a key."""
    for side in (a, b):
        if not side.groupBy(key).count().where("count > 1").isEmpty():
            raise ValueError(f"{key} is not unique")
    return a.join(b, key, how)


def loss(before: DataFrame, after: DataFrame, key: str, tolerance: float = 0.01) -> DataFrame:
    """Rows lost between stages, absolute and relative, and whether that is tolerated."""
    n = before.groupBy(key).agg(F.count(F.lit(1)).alias("n_before"))
    m = after.groupBy(key).agg(F.count(F.lit(1)).alias("n_after"))
    out = n.join(m, key, "left").withColumn("n_after", F.coalesce("n_after", F.lit(0)))
    lost = F.col("n_before") - F.col("n_after")
    return out.withColumns({"lost": lost, "lost_share": lost / F.col("n_before"), "accepted": lost / F.col("n_before") <= tolerance})


def counts_by(tables: dict[str, DataFrame], keys: DataFrame, key: str) -> DataFrame:
    """Rows of each table for every key, 0 where absent."""
    out = keys.select(key).distinct()
    for name, df in tables.items():
        out = out.join(df.groupBy(key).agg(F.count(F.lit(1)).alias(name)), key, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out


def mask_units(units: DataFrame, id: str, rules: DataFrame, levels: tuple[str, ...]) -> DataFrame:
    """Units of each mask: those that a 'keep' rule names at any level, without those that a 'drop' rule names.

    ``rules`` has mask, level, code and rule; the level 'rest' keeps what no
    other mask has. A row per mask and unit, with all columns of the units.
    """
    coded = units.select(id, F.explode(F.array(*[F.struct(F.lit(c).alias("level"), F.col(c).alias("code")) for c in levels])).alias("c")).select(id, "c.level", "c.code")
    named = coded.join(rules, ["level", "code"]).select("mask", id, "rule").distinct()
    held = named.where("rule = 'keep'").drop("rule").join(named.where("rule = 'drop'").drop("rule"), ["mask", id], "left_anti")
    rest = rules.where("level = 'rest'").select("mask", F.lit(1).alias("one"))
    left = units.select(id, F.lit(1).alias("one")).join(held.select(id), id, "left_anti").join(rest, "one").select("mask", id)
    return held.unionByName(left).join(units, id)


def prefix_join(rows: DataFrame, code: str, prefixes: DataFrame, prefix: str) -> DataFrame:
    """Rows with each prefix that their code starts with: an equi join on the lengths that prefixes have."""
    lengths = prefixes.select(F.length(prefix).alias("l")).distinct()
    lengths = F.array(*[F.lit(r[0]) for r in lengths.orderBy("l").collect()])  # no more than a code has characters
    own = rows.select("*", F.explode(F.array_distinct(F.transform(lengths, lambda n: F.left(F.col(code), n)))).alias(prefix))
    return own.join(prefixes, prefix)


def kept_geometries(rows: DataFrame, id: str, shape: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a valid shape, and of the others (status, n, ids)."""
    judged = rows.withColumn("status", validity(F.col(shape)))
    bad = judged.where("status <> 'valid'").groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(id)).alias("ids"))
    return judged.where("status = 'valid'").drop("status"), bad


def geometry_audit(rows: DataFrame, dataset: str, id: str, shape: str, row: list[str]) -> DataFrame:
    """Counts by dataset of null, empty and invalid shapes, of rows repeated in the columns ``row``, and of repeated ids."""
    judged = rows.withColumn("status", validity(F.col(shape)))
    kinds = [F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("null", "empty", "invalid")]
    repeated = [(F.count(F.lit(1)) - F.countDistinct(*c)).alias(n) for n, c in (("n_repeated_rows", row), ("n_repeated_ids", [id]))]
    return judged.groupBy(dataset).agg(F.count(F.lit(1)).alias("n"), *kinds, *repeated)


def empty_units(units: DataFrame, held: DataFrame, unit: str, by: list[str]) -> DataFrame:
    """By group of ``by``: n_units, n_empty (no row of ``held``: unit, n), n_buildings, and zero, whether that sum is zero."""
    rows = units.join(held.select(unit, "n"), unit, "left").groupBy(*by)
    out = rows.agg(F.count(F.lit(1)).alias("n_units"), F.count_if(F.col("n").isNull()).alias("n_empty"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_buildings"))
    return out.withColumn("zero", F.col("n_buildings") == 0)
