"""Chart data computed on the cluster.

The source pipeline collected whole columns to the driver and plotted
them.  Here every chart is a DataFrame: point sets stay distributed (and
have a binned grid form for very large inputs), and histograms, medians
and counts are aggregates, so only small results ever leave the cluster.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.config import DEFAULTS, Settings
from marquee.operators.metrics import with_metrics
from marquee.operators.stats import aggregated_with_median


def revenue_budget_points(df: DataFrame) -> DataFrame:
    return (df.filter(F.col("budget_musd").isNotNull() & F.col("revenue_musd").isNotNull())
            .select("id", "title", "budget_musd", "revenue_musd"))


def break_even(df: DataFrame) -> DataFrame:
    """Extent of the y = x line: max over both axes of the plotted points."""
    p = revenue_budget_points(df)
    return p.agg(F.count(F.lit(1)).alias("points"),
                 F.greatest(F.max("budget_musd"), F.max("revenue_musd")).alias("max_value"))


def popularity_rating_points(df: DataFrame) -> DataFrame:
    return (df.filter(F.col("popularity").isNotNull() & F.col("vote_average").isNotNull())
            .select("id", "title", "popularity", "vote_average"))


def grid_counts(points: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """Equal-width 2-D bin counts over the points' extent: the scatter for
    inputs too large to draw point by point.  The extent is a one-row
    aggregate joined back by broadcast (its size is fixed at one row)."""
    ext = points.agg(F.min(x).alias("_x0"), F.max(x).alias("_x1"),
                     F.min(y).alias("_y0"), F.max(y).alias("_y1"))

    def cell(v, lo, hi):
        width = F.col(hi) - F.col(lo)
        raw = F.when(width > 0, F.floor((F.col(v) - F.col(lo)) / width * bins)).otherwise(F.lit(0))
        return F.least(raw, F.lit(bins - 1)).cast("int")

    return (points.select(x, y, F.lit(1).alias("_k"))
            .join(F.broadcast(ext.withColumn("_k", F.lit(1))), "_k")
            .select(cell(x, "_x0", "_x1").alias("x_bin"), cell(y, "_y0", "_y1").alias("y_bin"))
            .groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).alias("points")))


def roi_values(df: DataFrame) -> DataFrame:
    m = with_metrics(df)
    return m.filter(F.col("roi").isNotNull() & (F.col("roi") > 0) & (F.col("roi") < 100)).select("roi")


def roi_histogram(df: DataFrame, max_bins: int = 30) -> DataFrame:
    """Histogram of 0 < roi < 100 with ``min(max_bins, n)`` equal-width bins
    over [min, max] (last bin closed; min = max widened by 0.5 each side);
    every bin is returned, empty ones with count 0.  Fewer than two values
    give no rows.  The range is computed first (one small job).  Bin assignment follows numpy's rule: a first guess from
    the scaled offset, then corrected against the computed edges.
    """
    v = roi_values(df)
    spark = df.sparkSession
    r = v.agg(F.count(F.lit(1)).alias("n"), F.min("roi").alias("mn"), F.max("roi").alias("mx")).first()
    n, mn, mx = r["n"], r["mn"], r["mx"]
    if n < 2:
        return spark.createDataFrame([], "bin int, lower double, upper double, count long")
    if mn == mx:
        mn, mx = mn - 0.5, mx + 0.5
    bins = min(n, max_bins)
    step = (mx - mn) / bins

    def edge(i):
        return F.when(i >= bins, F.lit(mx)).otherwise(F.lit(mn) + i * F.lit(step))

    g = F.least(F.floor((F.col("roi") - F.lit(mn)) * F.lit(bins / (mx - mn))), F.lit(bins - 1)).cast("int")
    x = v.withColumn("_g", g)
    x = x.withColumn("_g", F.when(F.col("roi") < edge(F.col("_g")), F.col("_g") - 1).otherwise(F.col("_g")))
    x = x.withColumn("_g", F.when((F.col("roi") >= edge(F.col("_g") + 1)) & (F.col("_g") != bins - 1),
                                  F.col("_g") + 1).otherwise(F.col("_g")))
    counts = x.groupBy(F.col("_g").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    edges = [(i, mn if i == 0 else mn + i * (mx - mn) / bins,
              mx if i + 1 == bins else mn + (i + 1) * (mx - mn) / bins) for i in range(bins)]
    all_bins = spark.createDataFrame(edges, "bin int, lower double, upper double")
    return (all_bins.join(counts, "bin", "left")
            .select("bin", "lower", "upper", F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


def roi_median(df: DataFrame, decimals: int = 6) -> DataFrame:
    """Exact median of the histogram's values (none below two values)."""
    m = aggregated_with_median(roi_values(df), "roi", [], [F.count(F.lit(1)).alias("n_values")], "median_roi")
    return m.filter("n_values >= 2").select("n_values", F.round("median_roi", decimals).alias("median_roi"))


FRANCHISE_CHART_METRICS = ("mean_revenue", "mean_budget", "mean_popularity", "mean_rating")


def franchise_comparison_series(franchise_report: DataFrame) -> DataFrame:
    """(category, metric, value) for the charted franchise metrics."""
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                     for m in FRANCHISE_CHART_METRICS if m in franchise_report.columns])
    return franchise_report.select("category", F.explode(rows).alias("r")).select("category", "r.*")


def top_franchise_series(top_franchises_report: DataFrame) -> DataFrame:
    return top_franchises_report.select("belongs_to_collection", "total_revenue", "mean_rating")


def genre_distribution(df: DataFrame, top: int = 15, settings: Settings = DEFAULTS) -> DataFrame:
    """Occurrences of each genre in the joined strings, most frequent first
    (ties by name), top ``top``.  Map-side partial counts keep the shuffle
    to one row per genre per task."""
    g = (df.filter(F.col("genres").isNotNull())
         .select(F.explode(F.split(F.col("genres"), re.escape(settings.separator))).alias("genre")))
    return (g.groupBy("genre").agg(F.count(F.lit(1)).alias("movies"))
            .orderBy(F.col("movies").desc(), F.col("genre").asc()).limit(top))
