"""The report bundle: rankings, searches, grouped reports and chart data
over one clean table, each isolated from the others' failures."""

from __future__ import annotations

import logging
from threading import Lock

from pyspark.sql import DataFrame

from marquee.config import (DEFAULTS, SEARCH_CAST, SEARCH_GENRES, SEARCH_PAIR_CAST, SEARCH_PAIR_DIRECTOR,
                            Settings)
from marquee.operators import charts, rankings, search
from marquee.plans import bundle

log = logging.getLogger(__name__)

# Report data sets that the source pipeline writes: ten rankings and three
# grouped reports.  The job here writes all of ``report_builders``.
SAVED_REPORTS = tuple(f"ranking_{n}" for n in rankings.RANKING_NAMES) + (
    "franchise_comparison", "top_franchises", "top_directors")


def report_builders(clean: DataFrame, settings: Settings = DEFAULTS,
                    genres=SEARCH_GENRES, cast=SEARCH_CAST, pair_cast=SEARCH_PAIR_CAST,
                    pair_director=SEARCH_PAIR_DIRECTOR) -> dict:
    """name -> zero-argument builder of a lazy frame.  The grouped reports share
    one pass over the table, taken when the first of them is built."""
    b = {}
    lock, shared = Lock(), {}

    def grouped_report(name):
        with lock:
            if "reports" not in shared:
                shared["reports"] = bundle.reports(bundle.grouped(clean, settings), settings)
        return shared["reports"][name]

    for name, *_ in rankings.ranking_specs(settings):
        b[f"ranking_{name}"] = (lambda n=name: rankings.ranking(clean, n, settings=settings))
    b["search_genres_cast"] = lambda: search.search_genres_cast(clean, genres, cast)
    b["search_cast_director"] = lambda: search.search_cast_director(clean, pair_cast, pair_director)
    b["franchise_comparison"] = lambda: grouped_report("franchise_comparison")
    b["top_franchises"] = lambda: grouped_report("top_franchises")
    b["top_directors"] = lambda: grouped_report("top_directors")
    b["genre_kpis"] = lambda: grouped_report("genre_kpis")
    b["budget_band_kpis"] = lambda: grouped_report("budget_band_kpis")
    b["chart_revenue_budget"] = lambda: charts.revenue_budget_points(clean)
    b["chart_break_even"] = lambda: charts.break_even(clean)
    b["chart_roi_histogram"] = lambda: charts.roi_histogram(clean, settings.histogram_max_bins)
    b["chart_roi_median"] = lambda: charts.roi_median(clean)
    b["chart_revenue_budget_grid"] = lambda: charts.grid_counts(
        charts.revenue_budget_points(clean), "budget_musd", "revenue_musd", settings.grid_bins)
    b["chart_popularity_rating_grid"] = lambda: charts.grid_counts(
        charts.popularity_rating_points(clean), "vote_average", "popularity", settings.grid_bins)
    b["chart_franchise_comparison"] = lambda: grouped_report("chart_franchise_comparison")
    b["chart_top_franchises"] = lambda: grouped_report("chart_top_franchises")
    b["chart_popularity_rating"] = lambda: charts.popularity_rating_points(clean)
    b["chart_genre_distribution"] = lambda: grouped_report("chart_genre_distribution")
    return b


def _run_one(name, build, action):
    try:
        n = action(name, build())
        return (name, "ok", int(n) if n is not None else None, None)
    except Exception as e:  # noqa: BLE001 - isolation is the point
        log.error("report %s failed: %s", name, e)
        return (name, "failed", None, f"{type(e).__name__}: {e}")


def written_to(spark, root: str):
    """An action that writes a report under ``root`` and returns its rows.
    Writing computes every column; a count would let Spark skip them."""
    def write(name, df):
        path = f"{root.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path).count()
    return write


def run_isolated(builders: dict, action, parallelism: int = 1) -> list:
    """Build each report and run ``action(name, frame)`` on it; a failure is
    recorded with its whole message and the other reports still run.  Returns rows (report, status, rows, error) in the
    builders' order.

    With ``parallelism > 1`` reports are submitted from that many driver
    threads, so several small report jobs share the cluster at once (Spark
    schedules concurrent jobs; each thread keeps its own job group).
    """
    items = list(builders.items())
    if parallelism <= 1 or len(items) <= 1:
        return [_run_one(n, b, action) for n, b in items]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        futures = [pool.submit(_run_one, n, b, action) for n, b in items]
        return [f.result() for f in futures]
