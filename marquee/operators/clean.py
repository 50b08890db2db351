"""Cleaning steps, each ``DataFrame -> DataFrame`` and composable with
``df.transform``.  Each step is a single ``select``/``filter`` so the
analyzed plan stays small; Catalyst collapses the projections into one
whole-stage-codegen span.

Order matters and is kept: flatten, then type, then null rules, then
dedupe on id, then the id/title and released filters, then the non-null
count, then the final projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.config import DEFAULTS, Settings
from marquee.functions.columns import (
    empty_to_null, joined_names, joined_strings, non_null_count, nonzero,
    placeholder_to_null, role_names, size_or_zero, to_finite, to_whole,
)

_NAME_FIELD = {
    "genres": "name",
    "spoken_languages": "english_name",
    "production_countries": "name",
    "production_companies": "name",
    "cast": "name",
}


def hoist_credits(df: DataFrame) -> DataFrame:
    """``credits.cast`` / ``credits.crew`` become the top-level arrays.

    When ``credits`` is present it wins over any top-level value, and a
    missing inner array becomes ``[]``; ``credits`` is then dropped.
    """
    if "credits" not in df.columns:
        return df
    has = F.col("credits").isNotNull()
    inner = df.schema["credits"].dataType
    out = []
    for c in df.columns:
        if c == "credits":
            continue
        if c in ("cast", "crew") and c in inner.fieldNames():
            typ = inner[c].dataType
            out.append(F.when(has, F.coalesce(F.col(f"credits.{c}"), F.array().cast(typ)))
                       .otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def drop_irrelevant(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return df.drop(*[c for c in settings.drop_columns if c in df.columns])


def flatten_nested(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Nested fields become flat strings (joined with ``|``) and sizes.

    Only columns that exist are touched; ``crew`` is replaced by
    ``crew_size`` and ``director``; ``cast`` gains ``cast_size``.
    """
    sep = settings.separator
    out = []
    for c in df.columns:
        dtype = df.schema[c].dataType
        if c == "belongs_to_collection":
            if isinstance(dtype, T.StructType) and "name" in dtype.fieldNames():
                out.append(F.col("belongs_to_collection.name").alias(c))
            else:
                out.append(F.col(c).cast("string").alias(c))
        elif c in _NAME_FIELD and isinstance(dtype, T.ArrayType):
            if c == "cast":
                out.append(size_or_zero(c).alias("cast_size"))
            elem = dtype.elementType
            if isinstance(elem, T.StructType):
                out.append(joined_names(c, _NAME_FIELD[c], sep).alias(c))
            else:
                out.append(joined_strings(c, sep).alias(c))
        elif c == "crew" and isinstance(dtype, T.ArrayType):
            out.append(size_or_zero(c).alias("crew_size"))
            out.append(role_names(c, settings.director_job, sep).alias("director"))
        elif c == "origin_country" and isinstance(dtype, T.ArrayType):
            out.append(joined_strings(c, sep).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


_TYPES = {
    "budget": "double", "revenue": "double", "id": "bigint", "popularity": "double",
    "vote_count": "bigint", "vote_average": "double", "runtime": "bigint",
}


def convert_types(df: DataFrame) -> DataFrame:
    """Safe conversions of numbers or their text: a value that is no finite
    number becomes null instead of failing the job under ANSI mode."""
    out = []
    for c in df.columns:
        if c in _TYPES:
            convert = to_whole if _TYPES[c] == "bigint" else to_finite
            out.append(convert(c, df.schema[c].dataType).alias(c))
        elif c == "release_date":
            if isinstance(df.schema[c].dataType, T.DateType):
                out.append(F.col(c))
            else:
                out.append(F.try_to_date(F.col(c).cast("string")).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def nullify(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Zero budget/revenue/runtime -> null; money to millions; rating
    without votes -> null; placeholder text and empty strings -> null."""
    cols = set(df.columns)
    out = []
    for c in df.columns:
        if c in ("budget", "revenue"):
            out.append((nonzero(c) / 1_000_000).alias(f"{c}_musd"))
        elif c == "runtime":
            out.append(nonzero(c).alias(c))
        elif c == "vote_average" and "vote_count" in cols:
            out.append(F.when(F.col("vote_count") == 0, F.lit(None))
                       .otherwise(F.col(c)).alias(c))
        elif c in settings.placeholder_columns:
            out.append(placeholder_to_null(c, settings.null_placeholders).alias(c))
        elif c in settings.empty_as_null:
            out.append(empty_to_null(c).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def dedupe_by_id(df: DataFrame, prefer=None) -> DataFrame:
    """One row per id; null ids count as equal.

    ``prefer=None`` keeps an arbitrary survivor, as ``dropDuplicates`` does,
    but takes ``first`` of the whole row packed in one struct: every column
    of the survivor comes from the same row, and one aggregate buffer per
    key is cheaper than one per column.  With ``prefer`` (column names or
    Column expressions, compared ascending; to prefer larger numbers pass
    their negation, or map categories to ranks with ``when``) the survivor
    is the smallest by ``prefer`` and then by the whole row, so it is
    deterministic.  Both are aggregates with a map-side partial step, so a
    hot id is collapsed before the shuffle and never lands whole in one
    task.
    """
    rest = [c for c in df.columns if c != "id"]
    row = F.struct(*[F.col(c) for c in rest])
    if prefer is None:
        picked = F.first(row)
    else:
        prefer = [prefer] if isinstance(prefer, str) or not hasattr(prefer, "__iter__") else prefer
        key = F.struct(*[F.col(p) if isinstance(p, str) else p for p in prefer], row.alias("_all"))
        picked = F.min_by(row, key)
    return (df.groupBy("id").agg(picked.alias("_row"))
            .select("id", *[F.col(f"_row.{c}").alias(c) for c in rest]))


def require_id_title(df: DataFrame) -> DataFrame:
    return df.filter(F.col("id").isNotNull() & F.col("title").isNotNull())


def released_only(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    if "status" not in df.columns:
        return df
    return df.filter(F.col("status") == settings.released_status).drop("status")


def min_non_null(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Keep rows with at least ``min_non_null`` non-null values over the
    columns present at this point."""
    return df.filter(non_null_count(df.columns) >= settings.min_non_null)


def reorder(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return df.select(*[c for c in settings.column_order if c in df.columns])
