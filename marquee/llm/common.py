"""Helpers shared by the operators of this subpackage.

Rules all operators follow: a null text counts as the empty text; rows are
read by named columns only, so further columns, whatever their names, never
meet the operators' own; intermediate tables are written to the session's
shared folder (``spark.checkpoint.dir``), never to a machine-local one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.plans.storage import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: A word: a run of characters other than space and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(c, UPPER, LOWER)


def word_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet under the shared folder and read back.

    Cuts lineage, survives lost executors, and the files go when the
    driver's JVM ends.
    """
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
