"""The corpus pipeline: toxicity filter, exact and near deduplication, mixing
to target weights and byte-level BPE encoding with decoding.

Each stage takes the documents its predecessor kept, written as Parquet under
the session's shared folder and read again; all but the last return rows with
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from marquee.llm.common import documents, labels, stage


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 stay; the model is fitted on labelled rows."""
    return toxicity.clean_rows(docs, toxicity.fit(docs, labels(spark, sf_dir)))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal normalised texts the smallest identifier stays."""
    return exact_dedup.exact_dedup(docs, keep="min")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 the smallest identifier stays."""
    return near_dedup.near_dedup(docs, shingle=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix to target weights takes them."""
    return mixing.mix(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the bytes decoded from them."""
    return bpe.token_digests(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_dedup_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("mixing to target weights", mixing_stage),
    ("byte-level BPE", bpe_stage),
]

#: SQL expresses neither the fitted toxicity model nor BPE; tests compare
#: with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = documents(spark, sf_dir)
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return docs
