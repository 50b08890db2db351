"""Derived per-title metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marquee.functions.columns import profit, roi


def with_metrics(df: DataFrame) -> DataFrame:
    """Add ``profit`` and ``roi`` (only those not already present)."""
    out = df
    if "profit" not in df.columns:
        out = out.withColumn("profit", profit())
    if "roi" not in df.columns:
        out = out.withColumn("roi", roi())
    return out
