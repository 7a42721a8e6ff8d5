"""City, regional and country statistics, and quality of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.validity import validity
from .merge import RESIDENTIAL

ATTRIBUTES = ("type", "subtype", "height", "floors", "construction_year")
TYPES = ("residential", "non-residential")
SUBTYPES = ("commercial", "industrial", "agricultural", "public", "others", "detached", "semi-detached", "terraced", "apartment")
#: Lower limits of half-open bins; the last has no upper limit. Years and areas have no lower one either.
BINS = {"height": (0, 5, 10, 20, 50), "floors": (0, 2, 4, 7), "construction_year": (0, 1900, 1970, 2000), "area": (0, 25, 100, 500)}
OPEN_BELOW = ("construction_year", "area")


def _name(value: str) -> str:
    return value.replace("-", "_")


def measures() -> dict[str, Column]:
    """All measures of a group of buildings, by name."""
    area, floor_area = F.col("area"), F.col("area") * F.coalesce(F.col("floors").cast("double"), F.lit(1.0))
    geometry = F.col("geometry_source")
    sources = {"gov": geometry.contains("gov"), "osm": geometry == "osm", "msft": geometry == "msft"}
    groups = {s: c for s, c in sources.items()}
    groups |= {f"type_{_name(t)}": F.col("type") == t for t in TYPES}
    groups |= {f"subtype_{_name(t)}": F.col("subtype") == t for t in SUBTYPES}
    out = {"n": F.count("area")}
    out |= {f"n_{g}": F.count_if(c) for g, c in groups.items()}
    for a in ATTRIBUTES:
        source = F.col(f"{a}_source")
        out[f"n_gt_{a}"] = F.count_if(source == geometry)
        # a value without a source counts as merged
        out[f"n_merged_{a}"] = F.count_if(F.col(a).isNotNull() & ~source.eqNullSafe(geometry) & ~source.eqNullSafe(F.lit("estimated")))
        if a != "construction_year":
            out[f"n_estimated_{a}"] = F.count_if(source == "estimated")
    for a, limits in BINS.items():
        for low, high in zip(limits, (*limits[1:], None), strict=True):
            inside = F.lit(True) if low == 0 and a in OPEN_BELOW else F.col(a) >= low
            inside = inside & (F.col(a) < high) if high is not None else inside & F.col(a).isNotNull()
            out[f"n_{a}_{low}_{'inf' if high is None else high}"] = F.count_if(inside)
    for what, value in (("area", area), ("floor_area", floor_area)):
        out[what] = F.sum(value)
        out |= {f"{what}_{g}": F.sum(F.when(c, value).otherwise(0.0)) for g, c in groups.items()}
    return out


def city_statistics(buildings: DataFrame) -> DataFrame:
    """One row per (city_id, region_id, country); all measures cut to whole numbers."""
    named = buildings.withColumn("country", F.substring("region_id", 1, 2))
    return named.groupBy("city_id", "region_id", "country").agg(*[c.cast("long").alias(n) for n, c in measures().items()])


def roll_up(stats: DataFrame, *keys: str) -> DataFrame:
    """Sums of the whole numbers of finer groups."""
    values = [c for c in stats.columns if c not in ("city_id", "region_id", "country")]
    return stats.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in values])


def with_shares(stats: DataFrame, part: dict[str, str], total: str) -> DataFrame:
    """Columns part / total, rounded to two places."""
    return stats.withColumns({name: F.round(F.try_divide(F.col(c), F.col(total)), 2) for name, c in part.items()})


def regression_metrics(pred: DataFrame, truth: str, value: str, by: str, bins: tuple[tuple[float, float], ...] = (), cover: float = 0.01) -> DataFrame:
    """MAE, RMSE and R2 per group, also within (a, b] of the truth; groups with less truth than ``cover`` are left out."""
    t, p = F.col(truth), F.col(value)
    both = t.isNotNull() & p.isNotNull()

    def over(name: str, ok: Column) -> list[Column]:
        e, y = F.when(ok, p - t), F.when(ok, t)
        sst = F.sum(y * y) - F.count(y) * F.avg(y) * F.avg(y)
        return [
            F.count(y).alias(f"n{name}"),
            F.avg(F.abs(e)).alias(f"mae{name}"),
            F.sqrt(F.avg(e * e)).alias(f"rmse{name}"),
            (1 - F.try_divide(F.sum(e * e), F.when(F.abs(sst) > 1e-9, sst))).alias(f"r2{name}"),
        ]

    cols = over("", both)
    for a, b in bins:
        cols += over(f"_{a:g}_{b:g}", both & (t > a) & (t <= b))
    out = pred.groupBy(by).agg(F.count(F.lit(1)).alias("_all"), *cols)
    return out.where(F.col("n") >= cover * F.col("_all")).drop("_all")


def _class_counts(pred: DataFrame, truth: str, value: str, by: str) -> DataFrame:
    """(by, class, true, predicted, hit) from counts of (truth, prediction)."""
    cells = pred.where(F.col(truth).isNotNull() & F.col(value).isNotNull()).groupBy(by, F.col(truth).alias("t"), F.col(value).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(by, F.col("t").alias("class"), "n", F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).alias("hit"), F.lit(1).alias("side"))
    sides = sides.union(cells.select(by, F.col("p").alias("class"), "n", F.lit(0).alias("hit"), F.lit(0).alias("side")))
    return sides.groupBy(by, "class").agg(F.sum(F.when(F.col("side") == 1, F.col("n")).otherwise(0)).alias("true"), F.sum(F.when(F.col("side") == 0, F.col("n")).otherwise(0)).alias("predicted"), F.sum("hit").alias("hit"))


def class_f1(pred: DataFrame, truth: str, value: str, by: str) -> DataFrame:
    """F1 of each class, under its published name."""
    names = F.create_map(*[F.lit(x) for kv in RESIDENTIAL.items() for x in kv])
    f1 = 2 * F.col("hit") / (F.col("true") + F.col("predicted"))
    return _class_counts(pred, truth, value, by).select(by, F.coalesce(F.element_at(names, F.col("class")), "class").alias("class"), f1.alias("f1"))


def classification_metrics(pred: DataFrame, truth: str, value: str, by: str) -> DataFrame:
    """F1 macro and micro and Cohen's kappa per group."""
    classes = _class_counts(pred, truth, value, by)
    out = classes.groupBy(by).agg(F.sum("true").alias("n"), F.avg(2 * F.col("hit") / (F.col("true") + F.col("predicted"))).alias("f1_macro"), F.sum("hit").alias("hits"), F.sum(F.col("true") * F.col("predicted")).alias("chance"))
    expected = F.col("chance") / (F.col("n") * F.col("n"))
    micro = F.col("hits") / F.col("n")
    return out.select(by, "n", "f1_macro", micro.alias("f1_micro"), F.try_divide(micro - expected, 1 - expected).alias("kappa"))


def interval(df: DataFrame, by: str, value: str, t: float = 2.262) -> DataFrame:
    """Mean and t * s / sqrt(n) around it."""
    out = df.groupBy(by).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("s"), F.count(value).alias("n"))
    half = t * F.col("s") / F.sqrt("n")
    return out.select(by, "n", "mean", (F.col("mean") - half).alias("lower"), (F.col("mean") + half).alias("upper"))


def parse_report(df: DataFrame, by: str, attrs: tuple[str, ...], types: str, id: str, shape: str) -> DataFrame:
    """Rows, non-empty values of each attribute with their share, the set of types, and ids of null, empty and invalid shapes."""
    filled = {a: F.count_if(F.col(a).isNotNull() & (F.col(a).cast("string") != "")) for a in attrs}
    judged = df.withColumn("_status", validity(F.col(shape)))
    bad = [F.sort_array(F.collect_list(F.when(F.col("_status") == s, F.col(id)))).alias(f"{s}_ids") for s in ("null", "empty", "invalid")]
    return judged.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), *[c.alias(f"n_{a}") for a, c in filled.items()], *[(c / F.count(F.lit(1))).alias(f"frac_{a}") for a, c in filled.items()], F.sort_array(F.collect_set(types)).alias("types"), *bad
    )


def combine_reports(reports: DataFrame, by: str, attrs: tuple[str, ...]) -> DataFrame:
    """Sums of part reports, with shares worked out anew, and the union of their types."""
    types = F.sort_array(F.array_distinct(F.flatten(F.collect_list("types")))).alias("types")
    return reports.groupBy(by).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_files"), *[F.sum(f"n_{a}").alias(f"n_{a}") for a in attrs], *[F.try_divide(F.sum(f"n_{a}"), F.sum("n")).alias(f"frac_{a}") for a in attrs], types)


def setup_report(before: DataFrame, after: DataFrame, by: str, id: str) -> DataFrame:
    """Rows and repeated ids of each group before and after a step."""
    sides = [df.groupBy(by).agg(F.count(F.lit(1)).alias(f"n_{s}"), (F.count(F.lit(1)) - F.countDistinct(id)).alias(f"repeated_{s}")) for s, df in (("start", before), ("end", after))]
    return sides[0].join(sides[1], by, "left").fillna(0, ["n_end", "repeated_end"])
