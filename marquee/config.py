"""Run parameters as one frozen dataclass.

The defaults below are fixed values: they must equal the source pipeline's
configuration for results to match, so they are stated here plainly and
together.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# --- fixed values (must equal the source pipeline's configuration) ---------
DROP_COLUMNS = ("adult", "imdb_id", "original_title", "video", "homepage")
NULL_PLACEHOLDERS = ("No Data", "", "N/A", "no data", "NA")
MIN_NON_NULL = 10
CLEAN_COLUMNS = (
    "id", "title", "tagline", "release_date", "genres",
    "belongs_to_collection", "original_language", "budget_musd",
    "revenue_musd", "production_companies", "production_countries",
    "vote_count", "vote_average", "popularity", "runtime",
    "overview", "spoken_languages", "poster_path", "cast",
    "cast_size", "director", "crew_size",
)
MIN_BUDGET_FOR_ROI = 10
MIN_VOTES_FOR_RATING = 10
TOP_N = 10
SEPARATOR = "|"
DIRECTOR_JOB = "Director"
RELEASED = "Released"
# (name, metric, ascending, extra filter kind) for the ten rankings
RANKING_TABLE = (
    ("highest_revenue", "revenue_musd", False, None),
    ("highest_budget", "budget_musd", False, None),
    ("highest_profit", "profit", False, None),
    ("lowest_profit", "profit", True, None),
    ("highest_roi", "roi", False, "min_budget"),
    ("lowest_roi", "roi", True, "min_budget"),
    ("most_voted", "vote_count", False, None),
    ("highest_rated", "vote_average", False, "min_votes"),
    ("lowest_rated", "vote_average", True, "min_votes"),
    ("most_popular", "popularity", False, None),
)
# needles of the two searches
SEARCH_GENRES = ("Science Fiction", "Action")
SEARCH_CAST = ("Bruce Willis",)
SEARCH_PAIR_CAST = ("Uma Thurman",)
SEARCH_PAIR_DIRECTOR = ("Quentin Tarantino",)
# columns whose empty string becomes null after flattening
EMPTY_AS_NULL = (
    "genres", "belongs_to_collection", "director", "cast",
    "production_companies", "production_countries", "spoken_languages",
)
# columns whose placeholder text becomes null
PLACEHOLDER_COLUMNS = ("overview", "tagline")
# ---------------------------------------------------------------------------

# Budget bands are not defined by the source pipeline (only promised in its
# documents); these edges, in million USD, are our own default.
BUDGET_BAND_EDGES = (10.0, 50.0, 100.0, 200.0)


@dataclass(frozen=True)
class Settings:
    drop_columns: tuple = DROP_COLUMNS
    null_placeholders: tuple = NULL_PLACEHOLDERS
    min_non_null: int = MIN_NON_NULL
    column_order: tuple = CLEAN_COLUMNS
    min_budget_for_roi: float = MIN_BUDGET_FOR_ROI
    min_votes_for_rating: int = MIN_VOTES_FOR_RATING
    top_n: int = TOP_N
    separator: str = SEPARATOR
    director_job: str = DIRECTOR_JOB
    released_status: str = RELEASED
    empty_as_null: tuple = EMPTY_AS_NULL
    placeholder_columns: tuple = PLACEHOLDER_COLUMNS
    budget_band_edges: tuple = BUDGET_BAND_EDGES
    # chart data
    histogram_max_bins: int = 30
    genre_chart_top: int = 15
    grid_bins: int = 20

    def with_(self, **kw) -> "Settings":
        return replace(self, **kw)


DEFAULTS = Settings()


def resolve_top_n(top_n, settings: Settings = DEFAULTS) -> int:
    """``None`` means the default; zero or negative is an error."""
    if top_n is None:
        return settings.top_n
    if int(top_n) <= 0:
        raise ValueError(f"top_n must be positive, got {top_n}")
    return int(top_n)
