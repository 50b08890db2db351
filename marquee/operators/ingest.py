"""Ingest rules over landed payloads (the extractor's data logic as Spark
jobs; the HTTP client itself is out of scope).

All steps are joins and partial aggregations keyed by id, so a repeated id
collapses map-side and no id is gathered whole into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import to_id
from marquee.schema import CORRUPT_COLUMN


class ExtractionError(Exception):
    """Nothing usable to request or nothing extracted."""


def request_list(ids: DataFrame) -> DataFrame:
    """Unique requested ids that are > 0."""
    return ids.select(F.col("id").cast("long").alias("id")).filter(F.col("id") > 0).distinct()


def request_summary(ids: DataFrame) -> DataFrame:
    """requested, unique, valid and removed counts in one aggregate pass
    over the per-id counts (one shuffle, partial counts map-side)."""
    per_id = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.sum("n").alias("requested"),
        F.count(F.lit(1)).alias("unique_ids"),
        F.count_if(F.col("id") > 0).alias("valid_ids")).select(
        "requested", "unique_ids", "valid_ids",
        (F.col("requested") - F.col("valid_ids")).alias("removed"))


def first_copy_per_id(payloads: DataFrame, order_col: str = "_arrival",
                      require=("id",), keep_order: bool = False) -> DataFrame:
    """Payloads with the required fields present, one per id: the first
    by ``order_col`` (arrival order, which must be there: row order after a
    read or a shuffle says nothing).  The least struct that begins with the
    order is a partial aggregate, so duplicates of a hot id combine before the
    shuffle, and the order is in it once (``min_by`` keeps it beside the row).
    A copy without an order counts only where none has one, as empty.
    ``keep_order`` keeps ``order_col``, for a later merge with further copies."""
    if order_col not in payloads.columns:
        raise ValueError(f"payloads need an order of arrival in column {order_col}")
    cond = F.lit(True)
    for c in require:
        cond = cond & F.col(c).isNotNull()
    p = payloads.filter(cond)
    rest = [c for c in p.columns if c not in ("id", order_col)]
    out = [c for c in p.columns if c != "id" and (keep_order or c != order_col)]
    row = F.when(F.col(order_col).isNotNull(), F.struct(order_col, *rest))
    return (p.groupBy("id").agg(F.min(row).alias("_row"))
            .select("id", *[F.col(f"_row.{c}").alias(c) for c in out]))


def outcomes(requested: DataFrame, fetched: DataFrame) -> DataFrame:
    """Per valid requested id: ``extracted`` or ``failed``."""
    got = fetched.select("id").distinct().withColumn("_got", F.lit(True))
    return (request_list(requested).join(got, "id", "left")
            .select("id", F.when(F.col("_got"), F.lit("extracted"))
                    .otherwise(F.lit("failed")).alias("outcome")))


def failed_ids(requested: DataFrame, fetched: DataFrame) -> DataFrame:
    return request_list(requested).join(fetched.select("id"), "id", "left_anti")


def outcome_summary(requested: DataFrame, fetched: DataFrame) -> DataFrame:
    """valid requested, extracted, failed and success rate (percent)."""
    o = outcomes(requested, fetched)
    return o.agg(F.count(F.lit(1)).alias("valid_requested"),
                 F.count_if(F.col("outcome") == "extracted").alias("extracted"),
                 F.count_if(F.col("outcome") == "failed").alias("failed")).select(
        "valid_requested", "extracted", "failed",
        F.round(F.try_divide(F.col("extracted") * 100.0, F.col("valid_requested")), 2)
        .alias("success_rate"))


def check_requests(ids: DataFrame) -> None:
    """Raise when the request list is empty or has no valid id."""
    s = request_summary(ids).first()
    if s is None or not s["requested"]:
        raise ExtractionError("the request list has no rows")
    if not s["valid_ids"]:
        raise ExtractionError(f"none of the {s['requested']} requested ids is above 0")


def check_extracted(requested: DataFrame, fetched: DataFrame) -> None:
    s = outcome_summary(requested, fetched).first()
    if s is None or not s["extracted"]:
        raise ExtractionError("no requested title has a landed document")


def quarantine_reason(docs: DataFrame):
    """Why a document cannot be used, or null: ``malformed`` (the text is no
    JSON object) or ``bad id`` (the id is there but is no whole number)."""
    whole = to_id("id", docs.schema["id"].dataType)
    reason = F.when(F.col("id").isNotNull() & whole.isNull(), F.lit("bad id"))
    if CORRUPT_COLUMN in docs.columns:
        reason = F.when(F.col(CORRUPT_COLUMN).isNotNull() & F.col("id").isNull(), F.lit("malformed")).otherwise(reason)
    return reason


def split_corrupt(docs: DataFrame):
    """(good, quarantined): quarantined rows carry their ``reason``; good
    rows lose ``_corrupt_record``.  A document with one value of an
    unexpected form is good; that value is null."""
    reason = quarantine_reason(docs)
    good = docs.filter(reason.isNull())
    if CORRUPT_COLUMN in docs.columns:
        good = good.drop(CORRUPT_COLUMN)
    return good, docs.withColumn("reason", reason).filter(F.col("reason").isNotNull())
