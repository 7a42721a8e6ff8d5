"""Carrying attributes across sources, and resolving them by precedence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geom import bound
from ..sources.tables import written
from .spatial import match_footprints

#: The published non-residential classes.
NON_RESIDENTIAL = ("industrial", "commercial", "public", "agricultural", "others")
#: Residential details and the names they are published under.
RESIDENTIAL = {
    "semi-detached duplex house": "semi-detached",
    "detached single-family house": "detached",
    "terraced house": "terraced",
    "apartment block": "apartment",
}


def most_frequent(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value): the commonest non-null value, ties to the smallest."""
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(key).agg(F.min(F.struct(-F.col("n"), F.col(value).alias("value"))).alias("m")).select(key, F.col("m.value").alias(value))


def fill_missing(a: DataFrame, b: DataFrame, matches: DataFrame, modes: Sequence[str] = ("type",), means: Sequence[str] = ("height", "age")) -> DataFrame:
    """Nulls of a filled from matched rows of b (a_id, b_id), by mode or mean, with filled_ flags."""
    known = matches.select("a_id", F.col("b_id").alias("id")).join(b.select("id", *modes, *means), "id")
    values = known.groupBy("a_id").agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(f"_{c}") for c in means]).drop("_n")
    for c in modes:
        values = values.join(most_frequent(known, "a_id", c).withColumnRenamed(c, f"_{c}"), "a_id", "left")
    out = a.join(values.withColumnRenamed("a_id", "id"), "id", "left")
    flags = {f"filled_{c}": F.col(c).isNull() & F.col(f"_{c}").isNotNull() for c in (*modes, *means)}
    filled = {c: F.coalesce(c, f"_{c}") for c in (*modes, *means)}
    return out.withColumns(flags).withColumns(filled).drop(*[f"_{c}" for c in (*modes, *means)])


def merge_sources(sources: Sequence[DataFrame], modes: Sequence[str] = (), means: Sequence[str] = (), filling: int = 1) -> DataFrame:
    """Sources in order of rank as one table of footprints.

    Each next source adds the footprints that match nothing; uncertain ones are left
    out. The first ``filling`` of them also fill gaps of what there is where footprints match.
    Matches and each step's table are written, as later steps read them several times.
    """
    out = sources[0]
    for i, b in enumerate(sources[1:]):
        found = written(match_footprints(out, b), "matches")
        if i < filling:
            filled = fill_missing(out, b, found.where("status = 'matching'"), modes, means).drop(*[f"filled_{c}" for c in (*modes, *means)])
        else:
            filled = out
        new = b.join(found.where("status = 'non-matching'").select(F.col("b_id").alias("id")), "id", "left_semi")
        out = written(filled.unionByName(new, allowMissingColumns=True), "merged")
    return out


def source_values(df: DataFrame, source: DataFrame, attr: str, ids: str) -> DataFrame:
    """(id, ids, values): values of the listed source rows that have one, ordered by source id."""
    listed = df.select("id", F.explode(ids).alias("source_id"))
    known = source.select(F.col("id").alias("source_id"), F.col(attr).alias("value")).where("source_id is not null and value is not null")
    rows = listed.join(known, "source_id").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("source_id", "value"))).alias("l"))
    return rows.select("id", F.col("l.source_id").alias("source_ids"), F.col("l.value").alias("source_values"))


def merge_weighted(pairs: DataFrame) -> DataFrame:
    """Area-weighted mean of matched values.

    ``pairs``: id, source_id, value (not null), overlap, area (of id's footprint).
    Returns merged, confidence (sum of overlap shares, not clipped) and the lists
    ordered by source id. Without any overlap each value weighs the group's size.
    """
    group = Window.partitionBy("id")
    weight = F.coalesce(F.try_divide("overlap", F.sum("overlap").over(group)), F.count(F.lit(1)).over(group).cast("double"))
    rows = pairs.withColumn("weight", weight)
    lists = F.sort_array(F.collect_list(F.struct("source_id", "value")))
    out = rows.groupBy("id").agg(F.sum(F.col("value") * F.col("weight")).alias("merged"), F.sum(F.try_divide("overlap", "area")).alias("confidence"), lists.alias("l"))
    return out.select("id", "merged", "confidence", F.col("l.source_id").alias("source_ids"), F.col("l.value").alias("source_values"))


def merge_dominant(pairs: DataFrame) -> DataFrame:
    """Category with the largest share of overlap, ties to the first by name; nulls take no part.

    ``pairs``: id, source_id, value, overlap, area. Confidence is clipped to [0, 1]. The
    lists hold the sources of that category, by source id, and their values.
    """
    lists = F.sort_array(F.collect_list(F.struct("source_id", "value")))
    by = pairs.where("value is not null").groupBy("id", "value").agg(F.try_divide(F.sum("overlap"), F.max("area")).alias("share"), lists.alias("l"))
    best = by.groupBy("id").agg(F.min(F.struct((-F.col("share")).alias("less"), "value", "l")).alias("b"))
    share = F.least(F.greatest(-F.col("b.less"), F.lit(0.0)), F.lit(1.0))
    return best.select("id", F.col("b.value").alias("merged"), share.alias("confidence"), F.col("b.l.source_id").alias("source_ids"), F.col("b.l.value").alias("source_values"))


def merge_residential(pairs: DataFrame, detail: str = "detail") -> DataFrame:
    """The dominant residential detail of those ids whose dominant category is residential; as :func:`merge_dominant`.

    ``pairs`` as there, with the category in value and the detail in a column of its own.
    """
    residential = merge_dominant(pairs).where("merged = 'residential'").select("id")
    return merge_dominant(pairs.withColumn("value", F.col(detail)).join(residential, "id", "left_semi"))


def as_binary(value: Column) -> Column:
    return F.when(value == "residential", "residential").when(value.isNotNull(), "non-residential")


Tier = tuple[Column, Column, Column | None, Column | None, Column | None]


def resolve(tiers: Sequence[Tier], kind: str, overrides: Sequence[dict] = ()) -> Column:
    """The first tier (source, value, lower, upper, ids) with a value, as a struct; overrides replace the parts they name."""
    none = F.lit(None)

    def tier(source: Column, value: Column, lo: Column | None, hi: Column | None, ids: Column | None) -> Column:
        return F.struct(
            value.cast(kind).alias("value"),
            source.cast("string").alias("source"),
            (none if lo is None else lo).cast("double").alias("lower"),
            (none if hi is None else hi).cast("double").alias("upper"),
            (none if ids is None else ids).cast("array<string>").alias("ids"),
        )

    def overridden(chosen: Column) -> Column:
        for o in overrides:
            new = {k: o.get(k, chosen[k]) for k in ("value", "source", "lower", "upper", "ids")}
            changed = tier(new["source"], new["value"], new["lower"], new["upper"], new["ids"])
            chosen = F.when(F.coalesce(o["when"], F.lit(False)), changed).otherwise(chosen)
        return chosen

    chosen = F.coalesce(*[F.when(t[1].isNotNull(), tier(*t)) for t in tiers], tier(none, none, none, none, none))
    # only overrides read the chosen tier several times
    return bound(chosen, overridden) if overrides else chosen


def publish_subtype(subtype: Column, detail: Column) -> Column:
    """The subtype with its residential detail: value, source, confidence and ids."""
    is_res = F.coalesce(subtype["value"] == "residential", F.lit(False))
    value = F.when(is_res, detail["value"]).otherwise(subtype["value"])
    names = F.create_map(*[F.lit(x) for kv in RESIDENTIAL.items() for x in kv])
    shown = F.when(value.isin(*NON_RESIDENTIAL), value).otherwise(F.element_at(names, value))
    confidence = F.when(is_res, F.coalesce(subtype["lower"], F.lit(1.0)) * detail["lower"]).otherwise(subtype["lower"])
    return F.struct(shown.alias("value"), F.when(is_res, detail["source"]).otherwise(subtype["source"]).alias("source"), confidence.alias("confidence"), F.when(is_res, detail["ids"]).otherwise(subtype["ids"]).alias("ids"))


def binary_type(value: Column) -> Column:
    """Non-residential for its five classes; everything else, null too, is residential."""
    return F.when(value.isin(*NON_RESIDENTIAL), "non-residential").otherwise("residential")


def source_bounds(values: Column) -> tuple[Column, Column]:
    return F.array_min(values), F.array_max(values)
