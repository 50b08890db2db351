"""Grouped KPI reports.

All are one ``groupBy().agg()`` (partial aggregation on the map side, so
hot groups such as the two franchise categories cost one small row per
task before the shuffle), optionally followed by a top-k
(``TakeOrderedAndProject``).  Ties in a top-k are broken by the group key.
Sums and means are exact (decimal) and then rounded to 2 places, so the
reported values do not depend on the partitioning.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.config import DEFAULTS, Settings, resolve_top_n
from marquee.functions.columns import category, exact_avg, exact_sum
from marquee.operators.metrics import with_metrics
from marquee.operators.stats import aggregated_with_median

def r2(c):
    return F.round(c, 2)


def _explode_tokens(df: DataFrame, column: str, sep: str) -> DataFrame:
    # a name that occurs twice in one title counts once for it
    return df.withColumn(column, F.explode(F.array_distinct(F.split(F.col(column), re.escape(sep)))))


def franchise_vs_standalone(df: DataFrame, median: bool = True, approx: bool = False) -> DataFrame:
    """Franchise vs standalone: count and means (2 decimals).

    ``mean_roi`` is the mean the source pipeline reports under the name
    ``median_roi``; ``median_roi`` here is the true median (exact and
    distributed by default; ``approx=True`` uses ``percentile_approx``).
    """
    m = with_metrics(df).withColumn("category", category())
    aggs = [
        F.count(F.lit(1)).alias("movie_count"),
        exact_avg("revenue_musd").alias("mean_revenue"),
        exact_avg("budget_musd").alias("mean_budget"),
        exact_avg("profit").alias("mean_profit"),
        exact_avg("roi").alias("mean_roi"),
        exact_avg("popularity").alias("mean_popularity"),
        exact_avg("vote_average").alias("mean_rating"),
    ]
    if median and approx:
        aggs.append(r2(F.percentile_approx("roi", 0.5)).alias("median_roi"))
    if median and not approx:
        return aggregated_with_median(m, "roi", ["category"], aggs, "median_roi").withColumn("median_roi", r2("median_roi"))
    return m.groupBy("category").agg(*aggs)


def top_franchises(df: DataFrame, top_n=None, settings: Settings = DEFAULTS) -> DataFrame:
    n = resolve_top_n(top_n, settings)
    m = with_metrics(df).filter(F.col("belongs_to_collection").isNotNull())
    return (m.groupBy("belongs_to_collection").agg(
        F.count(F.lit(1)).alias("total_movies"),
        exact_sum("budget_musd").alias("total_budget"),
        exact_avg("budget_musd").alias("mean_budget"),
        exact_sum("revenue_musd").alias("total_revenue"),
        exact_avg("revenue_musd").alias("mean_revenue"),
        exact_avg("vote_average").alias("mean_rating"))
        .orderBy(F.col("total_revenue").desc(), F.col("belongs_to_collection").asc())
        .limit(n))


def top_directors(df: DataFrame, top_n=None, by: str = "string",
                  settings: Settings = DEFAULTS) -> DataFrame:
    """``by='string'`` groups by the joined director string (co-directors
    form their own group); ``by='person'`` credits each director."""
    n = resolve_top_n(top_n, settings)
    m = with_metrics(df).filter(F.col("director").isNotNull() & (F.col("director") != ""))
    if by == "person":
        m = _explode_tokens(m, "director", settings.separator)
    elif by != "string":
        raise ValueError(f"by must be 'string' or 'person', got {by!r}")
    return (m.groupBy("director").agg(
        F.count(F.lit(1)).alias("total_movies"),
        exact_sum("revenue_musd").alias("total_revenue"),
        exact_avg("revenue_musd").alias("avg_revenue"),
        exact_avg("vote_average").alias("mean_rating"))
        .orderBy(F.col("total_revenue").desc(), F.col("director").asc())
        .limit(n))


def genre_kpis(df: DataFrame, by: str = "combination", top_n=None,
               settings: Settings = DEFAULTS) -> DataFrame:
    """``by='combination'`` groups by the joined genre string (as the source
    does); ``by='genre'`` explodes it so each genre is credited."""
    n = resolve_top_n(top_n, settings)
    m = with_metrics(df).filter(F.col("genres").isNotNull())
    if by == "genre":
        m = _explode_tokens(m, "genres", settings.separator)
    elif by != "combination":
        raise ValueError(f"by must be 'combination' or 'genre', got {by!r}")
    return (m.groupBy("genres").agg(
        F.count(F.lit(1)).alias("movie_count"),
        exact_avg("revenue_musd").alias("avg_revenue"),
        exact_avg("budget_musd").alias("avg_budget"),
        exact_avg("vote_average").alias("avg_rating"),
        exact_avg("popularity").alias("avg_popularity"))
        .orderBy(F.col("avg_revenue").desc_nulls_last(), F.col("genres").asc())
        .limit(n))


def _fmt(x: float) -> str:
    return f"{x:g}"


def budget_band(edges) -> "F.Column":
    """Band label for ``budget_musd``: ``<e0``, ``e0-e1``, ..., ``>=ek``."""
    edges = sorted(float(e) for e in edges)
    b = F.col("budget_musd")
    expr = F.when(b < edges[0], F.lit(f"<{_fmt(edges[0])}"))
    for lo, hi in zip(edges, edges[1:]):
        expr = expr.when(b < hi, F.lit(f"{_fmt(lo)}-{_fmt(hi)}"))
    return expr.otherwise(F.lit(f">={_fmt(edges[-1])}"))


def band_index(edges) -> "F.Column":
    edges = sorted(float(e) for e in edges)
    b = F.col("budget_musd")
    expr = F.when(b < edges[0], F.lit(0))
    for i, hi in enumerate(edges[1:], start=1):
        expr = expr.when(b < hi, F.lit(i))
    return expr.otherwise(F.lit(len(edges)))


def budget_band_kpis(df: DataFrame, edges=None, median: bool = True, approx: bool = False,
                     settings: Settings = DEFAULTS) -> DataFrame:
    """KPIs per budget band (titles with a known budget); ``median_roi`` is
    exact and distributed, or ``percentile_approx`` with ``approx=True``."""
    edges = edges or settings.budget_band_edges
    m = (with_metrics(df).filter(F.col("budget_musd").isNotNull())
         .withColumn("band", budget_band(edges)).withColumn("band_index", band_index(edges)))
    aggs = [
        F.count(F.lit(1)).alias("movie_count"),
        exact_avg("budget_musd").alias("mean_budget"),
        exact_avg("revenue_musd").alias("mean_revenue"),
        exact_avg("profit").alias("mean_profit"),
        exact_avg("roi").alias("mean_roi"),
        exact_avg("vote_average").alias("mean_rating"),
        exact_avg("popularity").alias("mean_popularity"),
    ]
    if median and approx:
        aggs.append(r2(F.percentile_approx("roi", 0.5)).alias("median_roi"))
    if median and not approx:
        return (aggregated_with_median(m, "roi", ["band_index", "band"], aggs, "median_roi")
                .withColumn("median_roi", r2("median_roi")))
    return m.groupBy("band_index", "band").agg(*aggs)
