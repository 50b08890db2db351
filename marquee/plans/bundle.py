"""The grouped reports of the bundle from one scan of the clean table.

A title takes part in several groupings: its category, collection, director,
genre combination, budget band and single genres.  It becomes one row for each
grouping it belongs to (grouping sets without the sets a title has no key for),
and one aggregate with shared partial sums serves them all: one scan, one
shuffle of (grouping, key).  The result, a row a group, is written to the
shared folder, and every report is a filter and a projection of it.  The
medians' sketches come from the same pass; their bounds need one more scan, of
the columns that make up the return on investment.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.config import DEFAULTS, Settings
from marquee.functions.columns import category, exact_avg, exact_sum
from marquee.operators import charts, cohorts
from marquee.operators.metrics import with_metrics
from marquee.operators.stats import aggregated_with_median
from marquee.plans.storage import scratch_path

GROUPINGS = ("category", "collection", "director", "genres", "band", "genre")
_MEANS = ("revenue_musd", "budget_musd", "profit", "roi", "popularity", "vote_average")
#: Groupings whose report has a median: two categories, one group a band.
WITH_MEDIAN = ("category", "band")


def group_rows(clean: DataFrame, settings: Settings = DEFAULTS, edges=None, groupings=GROUPINGS) -> DataFrame:
    """Each title once for each grouping it belongs to: grouping, key, place and its numbers."""
    edges = edges or settings.budget_band_edges
    m = with_metrics(clean)

    def entry(name, key, place=None):
        return F.struct(F.lit(name).alias("grouping"), key.alias("key"),
                        (F.lit(None) if place is None else place).cast("int").alias("place"))

    director = F.col("director")
    known = {
        "category": entry("category", category()),
        "collection": F.when(F.col("belongs_to_collection").isNotNull(), entry("collection", F.col("belongs_to_collection"))),
        "director": F.when(director.isNotNull() & (director != ""), entry("director", director)),
        "genres": F.when(F.col("genres").isNotNull(), entry("genres", F.col("genres"))),
        "band": F.when(F.col("budget_musd").isNotNull(), entry("band", cohorts.budget_band(edges), cohorts.band_index(edges))),
    }
    sets = F.array_compact(F.array(*[e for name, e in known.items() if name in groupings]))
    if "genre" in groupings:
        single = F.transform(F.split("genres", re.escape(settings.separator)), lambda g: entry("genre", g))
        sets = F.concat(sets, F.coalesce(single, F.array().cast("array<struct<grouping:string,key:string,place:int>>")))
    return m.select(F.explode(sets).alias("_e"), *_MEANS).select("_e.*", *_MEANS)


def grouped(clean: DataFrame, settings: Settings = DEFAULTS, edges=None) -> DataFrame:
    """One row a group of every grouping with all sums and means, written once."""
    aggs = [F.count(F.lit(1)).alias("n"), exact_sum("revenue_musd").alias("sum_revenue_musd"),
            exact_sum("budget_musd").alias("sum_budget_musd"), *[exact_avg(c).alias(f"mean_{c}") for c in _MEANS]]
    rows = group_rows(clean, settings, edges)
    # only the groupings with a median have values to sketch
    rows = rows.withColumn("_roi", F.when(F.col("grouping").isin(*WITH_MEDIAN), F.col("roi")))
    table = aggregated_with_median(rows, "_roi", ["grouping", "key", "place"], aggs, "median_roi")
    path = scratch_path(clean.sparkSession, "groups")
    table.write.parquet(path)
    return clean.sparkSession.read.schema(table.schema).parquet(path)


def reports(groups: DataFrame, settings: Settings = DEFAULTS) -> dict:
    """name -> report, each from the rows of its grouping."""
    def of(grouping, key, *columns):
        return groups.filter(F.col("grouping") == grouping).select(F.col("key").alias(key), *columns)

    n, rating = F.col("n").alias("movie_count"), F.col("mean_vote_average").alias("mean_rating")
    revenue, budget = F.col("mean_revenue_musd").alias("mean_revenue"), F.col("mean_budget_musd").alias("mean_budget")
    profit, roi = F.col("mean_profit"), F.col("mean_roi")
    popularity, total = F.col("mean_popularity"), F.col("n").alias("total_movies")
    revenues = F.col("sum_revenue_musd").alias("total_revenue")
    median = F.round("median_roi", 2).alias("median_roi")
    franchise = of("category", "category", n, revenue, budget, profit, roi, popularity, rating, median)
    collections = (of("collection", "belongs_to_collection", total, F.col("sum_budget_musd").alias("total_budget"), budget,
                      revenues, revenue, rating)
                   .orderBy(F.col("total_revenue").desc(), "belongs_to_collection").limit(settings.top_n))
    directors = (of("director", "director", total, revenues, revenue.alias("avg_revenue"), rating)
                 .orderBy(F.col("total_revenue").desc(), "director").limit(settings.top_n))
    genres = (of("genres", "genres", n, revenue.alias("avg_revenue"), budget.alias("avg_budget"), rating.alias("avg_rating"),
                 popularity.alias("avg_popularity"))
              .orderBy(F.col("avg_revenue").desc_nulls_last(), "genres").limit(settings.top_n))
    bands = of("band", "band", F.col("place").alias("band_index"), n, budget, revenue, profit, roi, rating, popularity, median)
    single = (of("genre", "genre", F.col("n").alias("movies"))
              .orderBy(F.col("movies").desc(), "genre").limit(settings.genre_chart_top))
    return {
        "franchise_comparison": franchise, "top_franchises": collections, "top_directors": directors, "genre_kpis": genres,
        "budget_band_kpis": bands, "chart_franchise_comparison": charts.franchise_comparison_series(franchise),
        "chart_top_franchises": charts.top_franchise_series(collections), "chart_genre_distribution": single,
    }
