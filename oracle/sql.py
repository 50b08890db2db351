"""DuckDB SQL for every registered query with a SQL formulation.

Conventions shared with the Spark side: ties in every limited query are
broken by the same column; rounding to 2 (or 6) decimals uses the
half-up-on-shortest-decimal form of ``r2``/``r6``; nulls are placed
explicitly where a limit follows.
"""

from __future__ import annotations

from oracle.base import davg2, dsum2, r2, with_clean


def r6(expr: str) -> str:
    return f"CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,6))::DOUBLE"


CLEAN_COLS = ("id, title, tagline, release_date, genres, belongs_to_collection, original_language, "
              "budget_musd, revenue_musd, production_companies, production_countries, vote_count, "
              "vote_average, popularity, runtime, overview, spoken_languages, poster_path, \"cast\", "
              "cast_size, director, crew_size")

RANKINGS = [
    ("highest_revenue", "revenue_musd", False, None),
    ("highest_budget", "budget_musd", False, None),
    ("highest_profit", "profit", False, None),
    ("lowest_profit", "profit", True, None),
    ("highest_roi", "roi", False, "budget_musd >= 10"),
    ("lowest_roi", "roi", True, "budget_musd >= 10"),
    ("most_voted", "vote_count", False, None),
    ("highest_rated", "vote_average", False, "vote_count >= 10"),
    ("lowest_rated", "vote_average", True, "vote_count >= 10"),
    ("most_popular", "popularity", False, None),
]

CLEAN_TYPES = [
    ("id", "bigint"), ("title", "string"), ("tagline", "string"), ("release_date", "date"),
    ("genres", "string"), ("belongs_to_collection", "string"), ("original_language", "string"),
    ("budget_musd", "double"), ("revenue_musd", "double"), ("production_companies", "string"),
    ("production_countries", "string"), ("vote_count", "bigint"), ("vote_average", "double"),
    ("popularity", "double"), ("runtime", "bigint"), ("overview", "string"),
    ("spoken_languages", "string"), ("poster_path", "string"), ("cast", "string"),
    ("cast_size", "int"), ("director", "string"), ("crew_size", "int"),
]
REQUIRED = {"id", "title", "release_date", "vote_average"}
CORRELATED = ("popularity", "vote_average", "vote_count", "budget_musd", "revenue_musd", "runtime")


def _q(c: str) -> str:
    return f'"{c}"'


def _ranking_sql(metric, asc, extra, n=10):
    where = f"{metric} IS NOT NULL" + (f" AND {extra}" if extra else "")
    order = f"{metric} {'ASC' if asc else 'DESC'}, id ASC"
    return (f"SELECT title, {metric}, release_date, genres FROM metrics "
            f"WHERE {where} ORDER BY {order} LIMIT {n}")


def _rankings_long(with_rank=True):
    parts = []
    for name, metric, asc, extra in RANKINGS:
        where = f"{metric} IS NOT NULL" + (f" AND {extra}" if extra else "")
        order = f"{metric} {'ASC' if asc else 'DESC'}, id ASC"
        parts.append(
            f"SELECT * FROM (SELECT '{name}' AS ranking, "
            f"CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank, title, "
            f"CAST({metric} AS DOUBLE) AS value, release_date, genres FROM metrics "
            f"WHERE {where}) WHERE rank <= 10")
    body = "\nUNION ALL\n".join(parts)
    if with_rank:
        return with_clean(body)
    return with_clean(f"SELECT ranking, title, value, release_date, genres FROM ({body})")


def _exists_token(col, needle):
    return f"list_contains(string_split({col}, '|'), '{needle}')"


def _schema_report():
    vals = ", ".join(
        f"('{c}', '{t}', '{t}', {str(c in REQUIRED).upper()}, TRUE)" for c, t in CLEAN_TYPES)
    counts = ", ".join(f"COUNT({_q(c)}) AS {_q(c)}" for c, _ in CLEAN_TYPES)
    return with_clean(f"""
, cnt AS (SELECT {counts} FROM clean),
long AS (UNPIVOT cnt ON COLUMNS(*) INTO NAME col VALUE non_null)
SELECT v.col AS "column", v.expected_type, v.actual_type, v.required, v.type_ok,
       CAST(l.non_null AS BIGINT) AS non_null
FROM (VALUES {vals}) v(col, expected_type, actual_type, required, type_ok)
JOIN long l ON l.col = v.col""")


def _correlations():
    parts = []
    for i, a in enumerate(CORRELATED):
        for b in CORRELATED[i + 1:]:
            parts.append(
                f"SELECT '{a}' AS metric_a, '{b}' AS metric_b, "
                f"COUNT(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS pairs, "
                f"{r6(f'corr({a}, {b})')} AS correlation FROM clean")
    return with_clean("\nUNION ALL\n".join(parts))


FRANCHISE = f"""
, cat AS (SELECT *, CASE WHEN belongs_to_collection IS NOT NULL THEN 'Franchise'
                         ELSE 'Standalone' END AS category FROM metrics)
SELECT category, COUNT(*) AS movie_count,
  {davg2('revenue_musd')} AS mean_revenue, {davg2('budget_musd')} AS mean_budget,
  {davg2('profit')} AS mean_profit, {davg2('roi')} AS mean_roi,
  {davg2('popularity')} AS mean_popularity, {davg2('vote_average')} AS mean_rating,
  {r2('MEDIAN(roi)')} AS median_roi
FROM cat GROUP BY category"""

TOP_FRANCHISES = f"""
SELECT belongs_to_collection, COUNT(*) AS total_movies,
  {dsum2('budget_musd')} AS total_budget, {davg2('budget_musd')} AS mean_budget,
  {dsum2('revenue_musd')} AS total_revenue, {davg2('revenue_musd')} AS mean_revenue,
  {davg2('vote_average')} AS mean_rating
FROM metrics WHERE belongs_to_collection IS NOT NULL
GROUP BY belongs_to_collection
ORDER BY total_revenue DESC NULLS LAST, belongs_to_collection ASC LIMIT 10"""


def _top_directors(person: bool):
    src = ("(SELECT DISTINCT id, unnest(string_split(director, '|')) AS director, revenue_musd, vote_average "
           "FROM metrics WHERE director IS NOT NULL AND director <> '')" if person else
           "(SELECT * FROM metrics WHERE director IS NOT NULL AND director <> '')")
    return with_clean(f"""
SELECT director, COUNT(*) AS total_movies, {dsum2('revenue_musd')} AS total_revenue,
  {davg2('revenue_musd')} AS avg_revenue, {davg2('vote_average')} AS mean_rating
FROM {src} d GROUP BY director
ORDER BY total_revenue DESC NULLS LAST, director ASC LIMIT 10""")


def _genre_kpis(explode: bool):
    src = ("(SELECT unnest(string_split(genres, '|')) AS genres, revenue_musd, budget_musd, "
           "vote_average, popularity FROM metrics WHERE genres IS NOT NULL)" if explode else
           "(SELECT * FROM metrics WHERE genres IS NOT NULL)")
    return with_clean(f"""
SELECT genres, COUNT(*) AS movie_count, {davg2('revenue_musd')} AS avg_revenue,
  {davg2('budget_musd')} AS avg_budget, {davg2('vote_average')} AS avg_rating,
  {davg2('popularity')} AS avg_popularity
FROM {src} g GROUP BY genres
ORDER BY avg_revenue DESC NULLS LAST, genres ASC LIMIT 10""")


BUDGET_BANDS = f"""
, b AS (SELECT *,
   CASE WHEN budget_musd < 1 THEN 0 WHEN budget_musd < 10 THEN 1 WHEN budget_musd < 25 THEN 2
        WHEN budget_musd < 40 THEN 3 ELSE 4 END AS band_index,
   CASE WHEN budget_musd < 1 THEN '<1' WHEN budget_musd < 10 THEN '1-10'
        WHEN budget_musd < 25 THEN '10-25' WHEN budget_musd < 40 THEN '25-40'
        ELSE '>=40' END AS band
   FROM metrics WHERE budget_musd IS NOT NULL)
SELECT band_index, band, COUNT(*) AS movie_count, {davg2('budget_musd')} AS mean_budget,
  {davg2('revenue_musd')} AS mean_revenue, {davg2('profit')} AS mean_profit,
  {davg2('roi')} AS mean_roi, {davg2('vote_average')} AS mean_rating,
  {davg2('popularity')} AS mean_popularity, {r2('MEDIAN(roi)')} AS median_roi
FROM b GROUP BY band_index, band"""

ROI_VALUES = """
, v AS (SELECT roi FROM metrics WHERE roi IS NOT NULL AND roi > 0 AND roi < 100)"""

ROI_HISTOGRAM = ROI_VALUES + """,
st0 AS (SELECT COUNT(*) AS n, MIN(roi) AS mn0, MAX(roi) AS mx0 FROM v),
st AS (SELECT n, CAST(LEAST(n, 30) AS INTEGER) AS bins,
          CASE WHEN mn0 = mx0 THEN mn0 - 0.5 ELSE mn0 END AS mn,
          CASE WHEN mn0 = mx0 THEN mx0 + 0.5 ELSE mx0 END AS mx
       FROM st0 WHERE n >= 2),
g0 AS (SELECT v.roi, st.mn, st.mx, st.bins,
          CAST(LEAST(floor((v.roi - st.mn) * (st.bins / (st.mx - st.mn))), st.bins - 1) AS INTEGER) AS g
       FROM v CROSS JOIN st),
g1 AS (SELECT *, CASE WHEN roi < (CASE WHEN g >= bins THEN mx ELSE mn + g * ((mx - mn) / bins) END)
                      THEN g - 1 ELSE g END AS g1 FROM g0),
g2 AS (SELECT *, CASE WHEN roi >= (CASE WHEN g1 + 1 >= bins THEN mx
                                         ELSE mn + (g1 + 1) * ((mx - mn) / bins) END)
                           AND g1 <> bins - 1 THEN g1 + 1 ELSE g1 END AS bin FROM g1),
counts AS (SELECT bin, COUNT(*) AS cnt FROM g2 GROUP BY bin),
all_bins AS (SELECT CAST(unnest(range(0, bins)) AS INTEGER) AS bin, mn, mx, bins FROM st)
SELECT a.bin,
  CASE WHEN a.bin = 0 THEN a.mn ELSE a.mn + a.bin * (a.mx - a.mn) / a.bins END AS lower,
  CASE WHEN a.bin + 1 = a.bins THEN a.mx ELSE a.mn + (a.bin + 1) * (a.mx - a.mn) / a.bins END AS upper,
  CAST(COALESCE(c.cnt, 0) AS BIGINT) AS count
FROM all_bins a LEFT JOIN counts c ON c.bin = a.bin"""

ROI_MEDIAN = ROI_VALUES + f"""
SELECT COUNT(*) AS n_values, {r6('MEDIAN(roi)')} AS median_roi FROM v HAVING COUNT(*) >= 2"""

FRANCHISE_SERIES = f"""
, cat AS (SELECT *, CASE WHEN belongs_to_collection IS NOT NULL THEN 'Franchise'
                         ELSE 'Standalone' END AS category FROM metrics),
r AS (SELECT category, {davg2('revenue_musd')} AS mean_revenue, {davg2('budget_musd')} AS mean_budget,
        {davg2('popularity')} AS mean_popularity, {davg2('vote_average')} AS mean_rating
      FROM cat GROUP BY category)
SELECT category, 'mean_revenue' AS metric, mean_revenue AS value FROM r
UNION ALL SELECT category, 'mean_budget', mean_budget FROM r
UNION ALL SELECT category, 'mean_popularity', mean_popularity FROM r
UNION ALL SELECT category, 'mean_rating', mean_rating FROM r"""

def _grid(x: str, y: str) -> str:
    return GRID.replace("budget_musd", x).replace("revenue_musd", y)


GRID = """
, p AS (SELECT budget_musd AS x, revenue_musd AS y FROM clean
        WHERE budget_musd IS NOT NULL AND revenue_musd IS NOT NULL),
e AS (SELECT MIN(x) AS x0, MAX(x) AS x1, MIN(y) AS y0, MAX(y) AS y1 FROM p)
SELECT CAST(LEAST(CASE WHEN x1 - x0 > 0 THEN floor((x - x0) / (x1 - x0) * 20) ELSE 0 END, 19) AS INTEGER) AS x_bin,
       CAST(LEAST(CASE WHEN y1 - y0 > 0 THEN floor((y - y0) / (y1 - y0) * 20) ELSE 0 END, 19) AS INTEGER) AS y_bin,
       COUNT(*) AS points
FROM p CROSS JOIN e GROUP BY 1, 2"""

REQUESTS = """
WITH req AS (
  SELECT o_orderkey AS id FROM orders
  UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 10 = 0
  UNION ALL SELECT -1 UNION ALL SELECT 0
  UNION ALL SELECT m + i FROM (SELECT MAX(o_orderkey) AS m FROM orders) CROSS JOIN range(1, 51) t(i)
)"""

PAYLOAD_IDS = """,
payload_ids AS (SELECT DISTINCT o_orderkey AS id FROM orders),
valid AS (SELECT DISTINCT id FROM req WHERE id > 0),
outcome AS (SELECT v.id, CASE WHEN p.id IS NOT NULL THEN 'extracted' ELSE 'failed' END AS outcome
            FROM valid v LEFT JOIN payload_ids p ON p.id = v.id)"""


# Payload copies that differ, in order of arrival.
ARRIVING = """
, arriving AS (
  SELECT k AS id, title, status, k * 10 AS arrival FROM raw
  UNION ALL
  SELECT k, CASE WHEN k % 30 <> 0 THEN title || ' (copy)' END, 'Planned',
         CASE WHEN k % 20 = 0 THEN k * 10 - 5 ELSE k * 10 + 5 END FROM raw WHERE k % 10 = 0
  UNION ALL
  SELECT NULL, title, status, k * 10 + 7 FROM raw WHERE k % 101 = 0)"""


# Reports run by ``report_status`` (names as the bundle calls them) and the
# oracle query whose row count each must have.
REPORT_BUNDLE = [(f"ranking_{n}", f"ranking_{n}") for n, *_ in RANKINGS] + [
    ("search_genres_cast", "search_genres_cast"),
    ("search_cast_director", "search_cast_director"),
    ("franchise_comparison", "franchise_vs_standalone"),
    ("top_franchises", "top_franchises"),
    ("top_directors", "top_directors"),
    ("genre_kpis", "genre_combination_kpis"),
    ("budget_band_kpis", None),
    ("chart_revenue_budget_grid", "chart_revenue_budget_grid"),
    ("chart_popularity_rating_grid", "chart_popularity_rating_grid"),
    ("chart_franchise_comparison", "chart_franchise_comparison"),
    ("chart_top_franchises", "chart_top_franchises"),
    ("chart_revenue_budget", "chart_revenue_budget"),
    ("chart_break_even", "chart_break_even"),
    ("chart_roi_histogram", "chart_roi_histogram"),
    ("chart_roi_median", "chart_roi_median"),
    ("chart_popularity_rating", "chart_popularity_rating"),
    ("chart_genre_distribution", "chart_genre_distribution"),
]

# the bundle's budget bands use the default edges 10, 50, 100, 200
DEFAULT_BANDS = with_clean(f"""
, b AS (SELECT budget_musd, CASE WHEN budget_musd < 10 THEN 0 WHEN budget_musd < 50 THEN 1
                    WHEN budget_musd < 100 THEN 2 WHEN budget_musd < 200 THEN 3 ELSE 4 END AS band_index
        FROM metrics WHERE budget_musd IS NOT NULL)
SELECT band_index, {davg2('budget_musd')} AS mean_budget FROM b GROUP BY band_index""")

# the number that is added up of each report in ``job_outputs``
TOTALS = {f"ranking_{n}": m for n, m, *_ in RANKINGS} | {
    "search_genres_cast": "vote_average", "search_cast_director": "runtime",
    "franchise_comparison": "mean_revenue", "top_franchises": "total_revenue",
    "top_directors": "total_revenue", "genre_kpis": "avg_revenue", "budget_band_kpis": "mean_budget",
    "chart_revenue_budget": "revenue_musd", "chart_break_even": "max_value", "chart_roi_histogram": "count",
    "chart_roi_median": "median_roi", "chart_revenue_budget_grid": "points",
    "chart_popularity_rating_grid": "points", "chart_franchise_comparison": "value",
    "chart_top_franchises": "total_revenue", "chart_popularity_rating": "popularity",
    "chart_genre_distribution": "movies",
}


def _job_outputs(q: dict) -> str:
    parts = [f"SELECT 'clean' AS name, COUNT(*) AS rows, {dsum2('revenue_musd')} AS total FROM ({q['clean_titles']}) t",
             f"SELECT 'failed requests', COUNT(*), CAST(0 AS DOUBLE) FROM ({q['ingest_outcomes']}) t "
             "WHERE outcome = 'failed'"]
    for name, key in REPORT_BUNDLE:
        sql = q[key] if key else DEFAULT_BANDS
        parts.append(f"SELECT '{name}', COUNT(*), {dsum2(_q(TOTALS[name]))} FROM ({sql}) t")
    return "\nUNION ALL\n".join(parts)


# report -> (query, key, measures) of ``report_bundle``
BUNDLED = {
    "franchise_comparison": ("franchise_vs_standalone", "category", (
        "movie_count", "mean_revenue", "mean_budget", "mean_profit", "mean_roi", "mean_popularity", "mean_rating", "median_roi")),
    "top_franchises": ("top_franchises", "belongs_to_collection", (
        "total_movies", "total_budget", "mean_budget", "total_revenue", "mean_revenue", "mean_rating")),
    "top_directors": ("top_directors", "director", ("total_movies", "total_revenue", "avg_revenue", "mean_rating")),
    "genre_kpis": ("genre_combination_kpis", "genres", (
        "movie_count", "avg_revenue", "avg_budget", "avg_rating", "avg_popularity")),
    "budget_band_kpis": ("budget_band_kpis", "band", (
        "band_index", "movie_count", "mean_budget", "mean_revenue", "mean_profit", "mean_roi", "mean_rating",
        "mean_popularity", "median_roi")),
    "chart_franchise_comparison": ("chart_franchise_comparison", "category || ':' || metric", ("value",)),
    "chart_top_franchises": ("chart_top_franchises", "belongs_to_collection", ("total_revenue", "mean_rating")),
    "chart_genre_distribution": ("chart_genre_distribution", "genre", ("movies",)),
}


def _report_bundle(q: dict) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS report, {key} AS key, '{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM ({q[query]}) t"
        for name, (query, key, measures) in BUNDLED.items() for m in measures)


def _report_status(q: dict) -> str:
    parts = []
    for name, key in REPORT_BUNDLE:
        sql = q[key] if key else DEFAULT_BANDS
        parts.append(f"SELECT '{name}' AS report, 'ok' AS status, "
                     f"(SELECT COUNT(*) FROM ({sql}) t) AS rows, CAST(NULL AS VARCHAR) AS error")
    return "\nUNION ALL\n".join(parts)


def queries() -> dict:
    q = {}
    q["clean_titles"] = with_clean(f"SELECT {CLEAN_COLS} FROM clean")
    for name in ("published_clean", "idempotent_clean", "checkpointed_clean", "raw_roundtrip"):
        q[name] = q["clean_titles"]
    q["clean_sample"] = with_clean(
        "SELECT title, genres, belongs_to_collection, budget_musd, revenue_musd, director FROM clean")
    q["raw_scan"] = with_clean(
        "SELECT rid AS id, title, status, CAST(raw_genre_count AS INTEGER) AS genre_count, "
        "CAST(raw_cast_count AS INTEGER) AS cast_count, belongs_to_collection AS collection FROM rows")
    q["flatten_collection"] = with_clean("SELECT rid AS id, belongs_to_collection FROM rows")
    q["flatten_names"] = with_clean(
        "SELECT rid AS id, genres, spoken_languages, production_countries, production_companies, "
        "cast_names AS \"cast\", origin_country FROM rows")
    q["credit_sizes"] = with_clean(
        "SELECT rid AS id, CAST(n_credits AS INTEGER) AS cast_size, "
        "CAST(n_credits AS INTEGER) AS crew_size FROM rows")
    q["flatten_directors"] = with_clean(
        "SELECT rid AS id, CASE WHEN n_credits > 0 THEN COALESCE(director_names, '') END AS director "
        "FROM rows")
    q["typed_titles"] = with_clean(
        "SELECT CAST(rid AS BIGINT) AS id, TRY_CAST(release_raw AS DATE) AS release_date, "
        "CAST(budget_raw AS DOUBLE) AS budget, CAST(revenue_raw AS DOUBLE) AS revenue, "
        "CAST(runtime_raw AS BIGINT) AS runtime, CAST(votes_raw AS BIGINT) AS vote_count, "
        "rating_raw AS vote_average, popularity FROM rows")
    q["typed_mixed_json"] = with_clean(
        "SELECT CAST(CASE WHEN rid % 14 = 0 THEN rid + 9007199254740993 WHEN rid % 7 = 0 THEN rid + 3000000000 "
        "ELSE rid END AS BIGINT) AS id, "
        "CAST(budget_raw AS DOUBLE) AS budget, CAST(revenue_raw AS DOUBLE) AS revenue, "
        "CAST(runtime_raw AS BIGINT) AS runtime, CAST(votes_raw AS BIGINT) AS vote_count, "
        "rating_raw AS vote_average, popularity FROM rows WHERE rid IS NOT NULL AND rid % 43 <> 0")
    q["drop_irrelevant"] = with_clean("SELECT rid AS id, title, 'id,title' AS columns FROM rows")
    q["nullified_titles"] = with_clean(
        "SELECT id, title, status, overview, tagline, budget_musd, revenue_musd, runtime, vote_count, "
        "vote_average, genres, belongs_to_collection, director, \"cast\", production_companies, "
        "production_countries, spoken_languages FROM typed")
    q["dedup_titles"] = with_clean(
        "SELECT COUNT(*) AS rows_before, "
        "COUNT(DISTINCT id) + MAX(CASE WHEN id IS NULL THEN 1 ELSE 0 END) AS rows_after, "
        "COUNT(*) - COUNT(DISTINCT id) - MAX(CASE WHEN id IS NULL THEN 1 ELSE 0 END) AS removed "
        "FROM typed")
    q["released_titles"] = with_clean("SELECT * FROM released")
    q["min_non_null"] = with_clean(f"SELECT {CLEAN_COLS}, origin_country FROM clean_wide")
    q["schema_report"] = _schema_report()
    q["quality_report"] = with_clean(
        "SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE id IS NULL) AS null_ids, "
        "COUNT(*) FILTER (WHERE title IS NULL) AS null_titles, "
        "(COUNT(*) > 0 AND COUNT(*) FILTER (WHERE id IS NULL) = 0) AS passed FROM clean")
    q["title_metrics"] = with_clean(
        "SELECT id, title, budget_musd, revenue_musd, profit, roi FROM metrics")
    for name, metric, asc, extra in RANKINGS:
        q[f"ranking_{name}"] = with_clean(_ranking_sql(metric, asc, extra))
    q["rankings_long"] = _rankings_long()
    q["published_rankings"] = _rankings_long(with_rank=False)
    q["search_genres_cast"] = with_clean(
        "SELECT title, vote_average, genres, \"cast\", CAST(row_number() OVER "
        "(ORDER BY vote_average DESC NULLS LAST, id) AS INTEGER) AS position FROM clean WHERE genres IS NOT NULL "
        "AND \"cast\" IS NOT NULL AND contains(genres, 'PROMO') AND contains(genres, 'ECONOMY') "
        "AND contains(\"cast\", 'Supplier#000000003')")
    q["search_cast_director"] = with_clean(
        "SELECT title, runtime, director, \"cast\", CAST(row_number() OVER "
        "(ORDER BY runtime ASC NULLS FIRST, id) AS INTEGER) AS position FROM clean WHERE \"cast\" IS NOT NULL "
        "AND director IS NOT NULL AND contains(\"cast\", 'Supplier#000000005') "
        "AND contains(director, 'Supplier#000000003')")
    q["search_token"] = with_clean(
        "SELECT title, production_countries, genres FROM clean WHERE production_countries IS NOT NULL "
        f"AND genres IS NOT NULL AND {_exists_token('production_countries', 'NATION_1')} "
        f"AND {_exists_token('genres', 'PROMO')}")
    q["franchise_vs_standalone"] = with_clean(FRANCHISE)
    q["top_franchises"] = with_clean(TOP_FRANCHISES)
    q["top_directors"] = _top_directors(False)
    q["top_directors_person"] = _top_directors(True)
    q["genre_combination_kpis"] = _genre_kpis(False)
    q["genre_kpis"] = _genre_kpis(True)
    q["budget_band_kpis"] = with_clean(BUDGET_BANDS)
    q["metric_correlations"] = _correlations()
    q["chart_revenue_budget"] = with_clean(
        "SELECT id, title, budget_musd, revenue_musd FROM clean "
        "WHERE budget_musd IS NOT NULL AND revenue_musd IS NOT NULL")
    q["chart_revenue_budget_grid"] = with_clean(GRID)
    q["chart_popularity_rating_grid"] = with_clean(_grid("vote_average", "popularity"))
    q["chart_break_even"] = with_clean(
        "SELECT COUNT(*) AS points, GREATEST(MAX(budget_musd), MAX(revenue_musd)) AS max_value "
        "FROM clean WHERE budget_musd IS NOT NULL AND revenue_musd IS NOT NULL")
    q["chart_roi_histogram"] = with_clean(ROI_HISTOGRAM)
    q["chart_roi_median"] = with_clean(ROI_MEDIAN)
    q["chart_franchise_comparison"] = with_clean(FRANCHISE_SERIES)
    q["chart_top_franchises"] = with_clean(
        f", tf AS ({TOP_FRANCHISES}) SELECT belongs_to_collection, total_revenue, mean_rating FROM tf")
    q["chart_popularity_rating"] = with_clean(
        "SELECT id, title, popularity, vote_average FROM clean "
        "WHERE popularity IS NOT NULL AND vote_average IS NOT NULL")
    q["chart_genre_distribution"] = with_clean(
        ", g AS (SELECT unnest(string_split(genres, '|')) AS genre FROM clean WHERE genres IS NOT NULL) "
        "SELECT genre, COUNT(*) AS movies FROM g GROUP BY genre ORDER BY movies DESC, genre ASC LIMIT 15")
    q["request_ids"] = REQUESTS + " SELECT DISTINCT id FROM req WHERE id > 0"
    q["request_summary"] = REQUESTS + """
SELECT COUNT(*) AS requested, COUNT(DISTINCT id) AS unique_ids,
       COUNT(DISTINCT id) FILTER (WHERE id > 0) AS valid_ids,
       COUNT(*) - COUNT(DISTINCT id) FILTER (WHERE id > 0) AS removed FROM req"""
    q["hoist_credits"] = with_clean("""
SELECT rid AS id,
  CAST(CASE WHEN rid IS NOT NULL AND rid % 3 = 0 THEN COALESCE(raw_cast_count, 0)
            ELSE raw_cast_count END AS INTEGER) AS cast_count,
  COALESCE(cast_names, '') AS cast_names,
  CAST(CASE WHEN rid IS NOT NULL AND rid % 3 = 0 THEN COALESCE(raw_cast_count, 0)
            ELSE raw_cast_count END AS INTEGER) AS crew_count
FROM rows""")
    first = "row_number() OVER (PARTITION BY id ORDER BY arrival) = 1"
    q["ingest_valid"] = with_clean(
        f"{ARRIVING} SELECT id, title, status FROM arriving WHERE id IS NOT NULL QUALIFY {first}")
    q["ingest_valid_titled"] = with_clean(
        f"{ARRIVING} SELECT id, title, status FROM arriving "
        f"WHERE id IS NOT NULL AND title IS NOT NULL QUALIFY {first}")
    q["dedup_first_arrival"] = with_clean(f"{ARRIVING} SELECT id, title, status FROM arriving QUALIFY {first}")
    q["ingest_outcomes"] = REQUESTS + PAYLOAD_IDS + " SELECT id, outcome FROM outcome"
    q["ingest_summary"] = REQUESTS + PAYLOAD_IDS + f"""
SELECT COUNT(*) AS valid_requested, COUNT(*) FILTER (WHERE outcome = 'extracted') AS extracted,
  COUNT(*) FILTER (WHERE outcome = 'failed') AS failed,
  {r2("CAST(COUNT(*) FILTER (WHERE outcome = 'extracted') AS DOUBLE) * 100 / COUNT(*)")} AS success_rate
FROM outcome"""
    q["quarantine"] = with_clean("""
, p AS (SELECT rid, CASE WHEN rid IS NOT NULL AND (rid % 41 = 0 OR rid % 37 = 0)
                         THEN CASE WHEN rid % 41 = 0 THEN 'malformed' ELSE 'bad id' END ELSE 'good' END AS part FROM rows)
SELECT part, COUNT(*) AS rows,
  CASE WHEN part = 'good' THEN COUNT(rid) ELSE 0 END AS rows_with_id
FROM p GROUP BY part""")
    q["landed_folders"] = with_clean("""
SELECT 'landed' AS folder, TRUE AS found, COUNT(*) AS documents, COUNT(rid) AS with_id FROM rows
UNION ALL SELECT unnest(['no rows', 'empty', 'missing']), FALSE, 0, 0""")
    q["report_status"] = _report_status(q)
    q["job_outputs"] = _job_outputs(q)
    q["report_bundle"] = _report_bundle(q)
    q["incremental_clean"] = q["clean_titles"]
    wide = with_clean("SELECT * FROM clean_wide")
    assert ">= 10" in wide
    q["rebuilt_clean"] = (
        f"SELECT 'defaults' AS name, COUNT(*) AS rows FROM ({q['clean_titles']}) t "
        f"UNION ALL SELECT 'at least 20 values', COUNT(*) FROM ({wide.replace('>= 10', '>= 20')}) t "
        f"UNION ALL SELECT outcome, COUNT(*) FROM ({q['ingest_outcomes']}) t GROUP BY outcome")
    return q
