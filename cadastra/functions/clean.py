"""Attribute cleaning as column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ids that stand for a missing value in text columns.
MISSING = ("", "None", "nan", "NaN")


def missing_to_null(col: Column) -> Column:
    """Text markers of a missing value as null."""
    return F.when(~F.trim(col).isin(*MISSING), col)


def null_to_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def extract_number(col: Column) -> Column:
    """The first ``digits[.digits]`` of a text; null without one."""
    return F.nullif(F.regexp_extract(col, r"(\d+(\.\d+)?)", 1), F.lit("")).try_cast("double")


def yes_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit("yes"))


def has_type(*cols: Column) -> Column:
    return F.coalesce(*cols).isNotNull()


def to_numeric(col: Column) -> Column:
    return col.try_cast("double")


def numeric_failures(col: Column) -> Column:
    """Aggregate: values that are there but are no number."""
    return F.count_if(col.isNotNull() & to_numeric(col).isNull())


def positive(col: Column) -> Column:
    """Negative numbers and zero as null."""
    return F.when(col > 0, col)


def clean_height(height: Column, floors: Column) -> Column:
    """Height above 0 that fits the floors, at least 1.5 m each for up to 29."""
    h = positive(to_numeric(height))
    f = to_numeric(floors)
    return F.when(~F.coalesce((f > h / 1.5) & (f < 30), F.lit(False)), h)


def clean_floors(floors: Column) -> Column:
    return positive(to_numeric(floors))


def clean_msft_height(height: Column) -> Column:
    h = to_numeric(height)
    return positive(F.when(h != -1, h))


def extract_year(col: Column) -> Column:
    """The first four characters as a year from 1000 on."""
    y = F.substring(col.cast("string"), 1, 4).try_cast("double")
    return F.when(y >= 1000, y)


def release_year(col: Column) -> Column:
    """Year within 0 to 2030, the limits themselves being missing."""
    y = F.least(F.greatest(extract_year(col), F.lit(0.0)), F.lit(2030.0))
    return F.when(col.isNotNull() & ~y.isin(0.0, 2030.0), y)


def release_floors(col: Column) -> Column:
    return F.when(col < 1, 1.0).otherwise(col)


def elevation_difference(top: Column, bottom: Column) -> Column:
    """Difference of two numbers that may have a decimal comma."""
    number = [F.replace(c, F.lit(","), F.lit(".")).try_cast("double") for c in (top, bottom)]
    return number[0] - number[1]


def base_name(path: Column) -> Column:
    """File name before its first dot."""
    return F.regexp_extract(path, r"([^/.]*)(\.[^/]*)?$", 1)


def source_dataset(dataset: Column, region: Column) -> Column:
    return F.when(dataset == "gov", F.concat(F.lit("gov-"), region)).otherwise(dataset)


def realistic(height: Column, floors: Column, own_height: Column, own_floors: Column) -> tuple[Column, Column]:
    """Height within (0, 350] and floors within (0, 100]; both null if the own floors exceed the own height / 1.5."""
    ratio = F.coalesce(own_floors > own_height / 1.5, F.lit(False))
    bad_height = F.coalesce((height <= 0) | (height > 350), F.lit(False))
    bad_floors = F.coalesce((floors <= 0) | (floors > 100), F.lit(False))
    return F.when(~(ratio | bad_height), height), F.when(~(ratio | bad_floors), floors)


def clear_where(col: Column, condition: Column) -> Column:
    """Null where the condition holds."""
    return F.when(~F.coalesce(condition, F.lit(False)), col)


def last_part(col: Column, separators: str) -> Column:
    """What follows the last of the separators."""
    return F.regexp_extract(col, f"([^{separators}]*)$", 1)


def keyword_flag(col: Column, words: list[str]) -> Column:
    return F.coalesce(F.lower(col).rlike("|".join(words)), F.lit(False))


def padded_code(*parts: tuple[Column, int]) -> Column:
    return F.concat(*[F.lpad(c.cast("string"), n, "0") for c, n in parts])


def parent_id(col: Column) -> Column:
    """Id without its trailing '-number'."""
    return F.regexp_replace(col, r"-\d+$", "")


def literal_list(col: Column) -> Column:
    """A list literal, or one value, as an array."""
    listed = F.from_json(F.replace(col, F.lit("'"), F.lit('"')), "array<string>")
    return F.when(F.trim(col).startswith("["), listed).otherwise(F.array(col))


def rename_map(df: DataFrame, names: dict[str, str], standard: tuple[str, ...] = ()) -> DataFrame:
    """Mapped columns under their standard names, and standard columns that are absent as null."""
    out = df.select(*[F.col(source).alias(name) for source, name in names.items()])
    return reduce(lambda d, c: d.withColumn(c, F.lit(None).cast("string")), [c for c in standard if c not in names.values()], out)


def is_polygon(wkt: Column) -> Column:
    """Whether a geometry text is a polygon or multipolygon."""
    return F.coalesce(wkt.rlike(r"(?i)^\s*(MULTI)?POLYGON\b"), F.lit(False))


def code_name(col: Column) -> Column:
    """'code - name' as its two parts; a text without a dash is a code."""
    return F.struct(F.trim(F.regexp_extract(col, r"^([^-]*)", 1)).alias("code"), F.nullif(F.trim(F.regexp_extract(col, r"-(.*)$", 1)), F.lit("")).alias("name"))
