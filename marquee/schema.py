"""Declared schemas: the raw title document and the clean title table."""

from __future__ import annotations

from pyspark.sql import types as T

_NAME = T.StructType([T.StructField("name", T.StringType())])
_GENRE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
])
_LANGUAGE = T.StructType([T.StructField("english_name", T.StringType())])
_CREW = T.StructType([
    T.StructField("job", T.StringType()),
    T.StructField("name", T.StringType()),
])
_COLLECTION = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
])
CREDITS = T.StructType([
    T.StructField("cast", T.ArrayType(_NAME)),
    T.StructField("crew", T.ArrayType(_CREW)),
])

# Raw title document. Reading JSON under this schema parses only these fields
# (nested schema pruning); undeclared fields are never materialised.
RAW_FIELDS = [
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("overview", T.StringType()),
    T.StructField("tagline", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("original_language", T.StringType()),
    T.StructField("poster_path", T.StringType()),
    T.StructField("release_date", T.StringType()),
    T.StructField("budget", T.LongType()),
    T.StructField("revenue", T.LongType()),
    T.StructField("runtime", T.LongType()),
    T.StructField("vote_count", T.LongType()),
    T.StructField("vote_average", T.DoubleType()),
    T.StructField("popularity", T.DoubleType()),
    T.StructField("belongs_to_collection", _COLLECTION),
    T.StructField("genres", T.ArrayType(_GENRE)),
    T.StructField("spoken_languages", T.ArrayType(_LANGUAGE)),
    T.StructField("production_countries", T.ArrayType(_NAME)),
    T.StructField("production_companies", T.ArrayType(_NAME)),
    T.StructField("cast", T.ArrayType(_NAME)),
    T.StructField("crew", T.ArrayType(_CREW)),
    T.StructField("origin_country", T.ArrayType(T.StringType())),
]
RAW_SCHEMA = T.StructType(RAW_FIELDS)
# Payload form as landed by the extractor before the credits hoist.
PAYLOAD_SCHEMA = T.StructType(RAW_FIELDS + [T.StructField("credits", CREDITS)])
# Documents as read from JSON: numbers are taken as their text, so a value
# written as 1500000.0 or "1500000" is converted later instead of spoiling
# the document.
NUMERIC_FIELDS = ("id", "budget", "revenue", "runtime", "vote_count", "vote_average", "popularity")
DOCUMENT_SCHEMA = T.StructType([
    T.StructField(f.name, T.StringType() if f.name in NUMERIC_FIELDS else f.dataType)
    for f in PAYLOAD_SCHEMA.fields])
CORRUPT_COLUMN = "_corrupt_record"
# Order of arrival of a document read from files.
ARRIVAL_COLUMN = "_arrival"


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType())])


CLEAN_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("tagline", T.StringType()),
    T.StructField("release_date", T.DateType()),
    T.StructField("genres", T.StringType()),
    T.StructField("belongs_to_collection", T.StringType()),
    T.StructField("original_language", T.StringType()),
    T.StructField("budget_musd", T.DoubleType()),
    T.StructField("revenue_musd", T.DoubleType()),
    T.StructField("production_companies", T.StringType()),
    T.StructField("production_countries", T.StringType()),
    T.StructField("vote_count", T.LongType()),
    T.StructField("vote_average", T.DoubleType()),
    T.StructField("popularity", T.DoubleType()),
    T.StructField("runtime", T.LongType()),
    T.StructField("overview", T.StringType()),
    T.StructField("spoken_languages", T.StringType()),
    T.StructField("poster_path", T.StringType()),
    T.StructField("cast", T.StringType()),
    T.StructField("cast_size", T.IntegerType()),
    T.StructField("director", T.StringType()),
    T.StructField("crew_size", T.IntegerType()),
])
