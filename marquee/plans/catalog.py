"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Every query derives its input from the star-schema tables in ``sf_dir``
(through the title fixture), so its work grows with them.  Stage queries
(``flatten_*``, ``typed_titles``, ``clean_titles``, ...) compute from the raw
tables; report queries read the clean table as a materialised stage built
once from those tables (``plans.stages``), as production reports read the
published table.  Queries that exercise sinks write under a fresh directory
in the session's shared folder (``spark.checkpoint.dir``) and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.config import DEFAULTS, RANKING_TABLE
from marquee.functions.columns import exact_sum, size_or_null, to_whole
from marquee.operators import charts, cohorts, ingest, quality, rankings, search
from marquee.operators import clean as C
from marquee.operators.metrics import with_metrics
from marquee.operators.stats import correlations
from marquee.plans import clean as P
from marquee.plans import bundle, publish
from marquee.plans.jobs import build_clean
from marquee.plans.jobs import run as run_job
from marquee.plans.reports import SAVED_REPORTS, report_builders, run_isolated, written_to
from marquee.plans.stages import clean_stage
from marquee.plans.storage import scratch_path
from marquee.schema import RAW_SCHEMA
from marquee.sources.fixtures import arriving_payloads, payloads, raw_titles, request_ids
from marquee.sources.readers import landed_documents_or_none, read_documents

# Needles for the searches on the fixture (it has supplier names for people
# and part types for genres); the operators' defaults are the source's.
E1_GENRES = ("PROMO", "ECONOMY")
E1_CAST = ("Supplier#000000003",)
E2_CAST = ("Supplier#000000005",)
E2_DIRECTOR = ("Supplier#000000003",)
TOKEN_SEARCH = {"production_countries": ["NATION_1"], "genres": ["PROMO"]}
BAND_EDGES = (1.0, 10.0, 25.0, 40.0)
CORRELATED = ("popularity", "vote_average", "vote_count", "budget_musd", "revenue_musd", "runtime")


# Lazy plans are immutable, so the fixture and clean plans are built once per
# session and table directory and shared by the queries (building them costs
# thousands of driver-to-JVM calls).  This shares the *plan*, not data: every
# action still reads the tables and recomputes everything.
_PLANS: dict = {}


def _plan(spark, sf, kind, build):
    key = (spark.sparkContext.applicationId, id(spark), sf.rstrip("/"), kind)
    if key not in _PLANS:
        _PLANS[key] = build()
    return _PLANS[key]


def _raw(spark, sf):
    return _plan(spark, sf, "raw", lambda: raw_titles(spark, sf))


def _payloads(spark, sf) -> DataFrame:
    return _plan(spark, sf, "payloads", lambda: payloads(spark, sf, raw=_raw(spark, sf)))


def _clean_plan(spark, sf) -> DataFrame:
    """The clean table computed from the raw tables (lazy plan)."""
    return _plan(spark, sf, "clean", lambda: P.clean_titles(_raw(spark, sf)))


def _clean(spark, sf) -> DataFrame:
    """The clean table as a materialised stage (built once, then read as
    Parquet); reports run over it."""
    return clean_stage(spark, sf)


# --- sources -----------------------------------------------------------------

def q_raw_scan(spark, sf):
    path = scratch_path(spark, "raw")
    publish.write_documents(_raw(spark, sf), path)
    docs = read_documents(spark, path, schema=RAW_SCHEMA, keep_corrupt=False)
    return docs.select("id", "title", "status",
                       size_or_null("genres").alias("genre_count"),
                       size_or_null("cast").alias("cast_count"),
                       F.col("belongs_to_collection.name").alias("collection"))


def q_clean_sample(spark, sf):
    path = scratch_path(spark, "clean")
    _clean_plan(spark, sf).write.parquet(path)
    return spark.read.parquet(path).select(
        "title", "genres", "belongs_to_collection", "budget_musd", "revenue_musd", "director")


# --- ingest ------------------------------------------------------------------

def q_request_ids(spark, sf):
    return ingest.request_list(request_ids(spark, sf))


def q_request_summary(spark, sf):
    return ingest.request_summary(request_ids(spark, sf))


def q_hoist_credits(spark, sf):
    h = C.hoist_credits(_payloads(spark, sf))
    return h.select("id", size_or_null("cast").alias("cast_count"),
                    F.concat_ws("|", F.transform("cast", lambda x: x["name"])).alias("cast_names"),
                    size_or_null("crew").alias("crew_count"))


def q_ingest_valid(spark, sf):
    return ingest.first_copy_per_id(arriving_payloads(spark, sf)).select("id", "title", "status")


def q_ingest_valid_titled(spark, sf):
    """The first copy that has both id and title."""
    return (ingest.first_copy_per_id(arriving_payloads(spark, sf), require=("id", "title"))
            .select("id", "title", "status"))


def q_dedup_first_arrival(spark, sf):
    """Dedupe on copies that differ; the earliest survives, null ids are one."""
    return C.dedupe_by_id(arriving_payloads(spark, sf), prefer=["_arrival"]).select("id", "title", "status")


def q_ingest_outcomes(spark, sf):
    return ingest.outcomes(request_ids(spark, sf), ingest.first_copy_per_id(arriving_payloads(spark, sf)))


def q_ingest_summary(spark, sf):
    return ingest.outcome_summary(request_ids(spark, sf),
                                  ingest.first_copy_per_id(arriving_payloads(spark, sf)))


def q_quarantine(spark, sf):
    """Land payloads as JSON text with planted faults (a text id for
    k % 37 = 0, a cut-off line for k % 41 = 0), read them back under the
    declared schema and split good from quarantined rows."""
    p = _payloads(spark, sf)
    js = F.to_json(F.struct(*[F.col(c) for c in p.columns]))
    k = F.col("id")
    text = (F.when(k % 41 == 0, F.substring(js, 1, 40))
            .when(k % 37 == 0, F.regexp_replace(js, r'^\{"id":[0-9]+', '{"id":"x"'))
            .otherwise(js))
    path = scratch_path(spark, "landed")
    publish.landed(p.select(text.alias("value"))).text(path)
    good, bad = ingest.split_corrupt(read_documents(spark, path))
    return (good.select(F.lit("good").alias("part"), to_whole("id").alias("id"))
            .unionByName(bad.select(F.col("reason").alias("part"), to_whole("id").alias("id")))
            .groupBy("part").agg(F.count(F.lit(1)).alias("rows"),
                                 F.count("id").alias("rows_with_id")))


def q_typed_mixed_json(spark, sf):
    """Land payloads whose numbers are written in several ways: whole, with a
    fraction (k % 3 = 1) or as text (k % 3 = 2), ids above 2^31 for k % 7 = 0,
    above 2^53 for k % 14 = 0, and ids that are no whole number for
    k % 43 = 0, which go to quarantine; read, split and convert them."""
    p = _payloads(spark, sf).filter(F.col("id").isNotNull())
    k = F.col("id")
    shifted = (F.when(k % 14 == 0, k + 9_007_199_254_740_993).when(k % 7 == 0, k + 3_000_000_000).otherwise(k))
    js = F.to_json(F.struct(*[shifted.alias("id") if c == "id" else F.col(c) for c in p.columns]))
    numbers = r'"(id|budget|revenue|runtime|vote_count)":([0-9]+)'
    text = (F.when(k % 3 == 1, F.regexp_replace(js, numbers, '"$1":$2.0'))
            .when(k % 3 == 2, F.regexp_replace(js, numbers, '"$1":"$2"')).otherwise(js))
    text = F.when(k % 43 == 0, F.regexp_replace(js, r'"id":([0-9]+)', '"id":$1.5')).otherwise(text)
    path = scratch_path(spark, "mixed")
    publish.landed(p.select(text.alias("value"))).text(path)
    good, _ = ingest.split_corrupt(read_documents(spark, path))
    return P.typed(good).select("id", "budget", "revenue", "runtime", "vote_count", "vote_average", "popularity")


# --- cleaning stages -----------------------------------------------------------

def q_flatten_collection(spark, sf):
    return P.flattened(_raw(spark, sf)).select("id", "belongs_to_collection")


def q_flatten_names(spark, sf):
    return P.flattened(_raw(spark, sf)).select(
        "id", "genres", "spoken_languages", "production_countries", "production_companies",
        "cast", "origin_country")


def q_drop_irrelevant(spark, sf):
    """Documents with the five irrelevant columns lose just those."""
    wide = _raw(spark, sf).select("id", *[F.lit("x").alias(c) for c in DEFAULTS.drop_columns], "title")
    out = C.drop_irrelevant(wide)
    return out.withColumn("columns", F.lit(",".join(out.columns)))


def q_credit_sizes(spark, sf):
    return P.flattened(_raw(spark, sf)).select("id", "cast_size", "crew_size")


def q_flatten_directors(spark, sf):
    return P.flattened(_raw(spark, sf)).select("id", "director")


def q_typed_titles(spark, sf):
    return P.typed(_raw(spark, sf)).select(
        "id", "release_date", "budget", "revenue", "runtime", "vote_count", "vote_average",
        "popularity")


def q_nullified_titles(spark, sf):
    return P.nullified(_raw(spark, sf)).select(
        "id", "title", "status", "overview", "tagline", "budget_musd", "revenue_musd", "runtime",
        "vote_count", "vote_average", "genres", "belongs_to_collection", "director", "cast",
        "production_companies", "production_countries", "spoken_languages")


def q_dedup_titles(spark, sf):
    return quality.dedupe_report(P.nullified(_raw(spark, sf)))


def q_released_titles(spark, sf):
    return P.released(_raw(spark, sf))


def q_min_non_null(spark, sf):
    return P.released(_raw(spark, sf)).transform(C.min_non_null, DEFAULTS)


def q_clean_titles(spark, sf):
    return _clean_plan(spark, sf)


def q_schema_report(spark, sf):
    return quality.schema_report(_clean(spark, sf))


def q_quality_report(spark, sf):
    return quality.quality_report(_clean(spark, sf))


def q_title_metrics(spark, sf):
    return with_metrics(_clean(spark, sf)).select(
        "id", "title", "budget_musd", "revenue_musd", "profit", "roi")


# --- rankings and searches -------------------------------------------------------

def _ranking_query(name):
    def q(spark, sf):
        return rankings.ranking(_clean(spark, sf), name)
    q.__name__ = f"q_ranking_{name}"
    return q


def q_rankings_long(spark, sf):
    return rankings.rankings_long(_clean(spark, sf))


def q_search_genres_cast(spark, sf):
    return search.search_genres_cast(_clean(spark, sf), E1_GENRES, E1_CAST, position=True)


def q_search_cast_director(spark, sf):
    return search.search_cast_director(_clean(spark, sf), E2_CAST, E2_DIRECTOR, position=True)


def q_search_token(spark, sf):
    return search.search(_clean(spark, sf), TOKEN_SEARCH, match="token",
                         select=["title", "production_countries", "genres"])


# --- grouped reports -----------------------------------------------------------

def q_franchise_vs_standalone(spark, sf):
    return cohorts.franchise_vs_standalone(_clean(spark, sf))


def q_top_franchises(spark, sf):
    return cohorts.top_franchises(_clean(spark, sf))


def q_top_directors(spark, sf):
    return cohorts.top_directors(_clean(spark, sf))


def q_top_directors_person(spark, sf):
    return cohorts.top_directors(_clean(spark, sf), by="person")


def q_genre_combination_kpis(spark, sf):
    return cohorts.genre_kpis(_clean(spark, sf), by="combination")


def q_genre_kpis(spark, sf):
    return cohorts.genre_kpis(_clean(spark, sf), by="genre")


def q_budget_band_kpis(spark, sf):
    return cohorts.budget_band_kpis(_clean(spark, sf), BAND_EDGES)


def _numbers(name, df, key):
    """A report's rows in long form: report, key, measure, value."""
    values = [c for c in df.columns if c != key and c != "metric" and c != "band"]
    rows = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in values])
    label = F.concat_ws(":", F.col(key), F.col("metric")) if "metric" in df.columns else F.col(key)
    return df.select(F.lit(name).alias("report"), label.alias("key"), F.explode(rows).alias("r")).select("report", "key", "r.*")


BUNDLE_KEYS = {"franchise_comparison": "category", "top_franchises": "belongs_to_collection", "top_directors": "director",
               "genre_kpis": "genres", "budget_band_kpis": "band", "chart_franchise_comparison": "category",
               "chart_top_franchises": "belongs_to_collection", "chart_genre_distribution": "genre"}


def q_report_bundle(spark, sf):
    """All grouped reports from one pass over the clean table."""
    groups = bundle.grouped(_clean(spark, sf), edges=BAND_EDGES)
    parts = [_numbers(name, df, BUNDLE_KEYS[name]) for name, df in bundle.reports(groups).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_metric_correlations(spark, sf):
    return correlations(_clean(spark, sf), CORRELATED)


# --- chart data ------------------------------------------------------------------

def q_chart_revenue_budget(spark, sf):
    return charts.revenue_budget_points(_clean(spark, sf))


def q_chart_revenue_budget_grid(spark, sf):
    return charts.grid_counts(charts.revenue_budget_points(_clean(spark, sf)),
                              "budget_musd", "revenue_musd", bins=20)


def q_chart_popularity_rating_grid(spark, sf):
    return charts.grid_counts(charts.popularity_rating_points(_clean(spark, sf)),
                              "vote_average", "popularity", bins=20)


def q_chart_break_even(spark, sf):
    return charts.break_even(_clean(spark, sf))


def q_chart_roi_histogram(spark, sf):
    return charts.roi_histogram(_clean(spark, sf))


def q_chart_roi_median(spark, sf):
    return charts.roi_median(_clean(spark, sf))


def q_chart_franchise_comparison(spark, sf):
    return charts.franchise_comparison_series(
        cohorts.franchise_vs_standalone(_clean(spark, sf), median=False))


def q_chart_top_franchises(spark, sf):
    return charts.top_franchise_series(cohorts.top_franchises(_clean(spark, sf)))


def q_chart_popularity_rating(spark, sf):
    return charts.popularity_rating_points(_clean(spark, sf))


def q_chart_genre_distribution(spark, sf):
    return charts.genre_distribution(_clean(spark, sf))


# --- sinks, reuse, jobs ------------------------------------------------------------

def q_published_rankings(spark, sf):
    """Write the saved report data sets, then read the rankings back."""
    root = scratch_path(spark, "analysis")
    builders = report_builders(_clean(spark, sf))
    for name in SAVED_REPORTS:
        builders[name]().write.mode("overwrite").parquet(f"{root}/{name}")
    parts = []
    for name, metric, *_ in RANKING_TABLE:
        r = spark.read.parquet(f"{root}/ranking_{name}")
        parts.append(r.select(F.lit(name).alias("ranking"), "title",
                              F.col(metric).cast("double").alias("value"),
                              "release_date", "genres"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_published_clean(spark, sf):
    root = scratch_path(spark, "published")
    publish.publish_table(_clean_plan(spark, sf), root)
    return publish.read_published(spark, root)


def q_idempotent_clean(spark, sf):
    path = scratch_path(spark, "stage")
    first = publish.load_or_build(spark, path, lambda: _clean_plan(spark, sf))
    # second call finds the complete output and reuses it without rebuilding
    return publish.load_or_build(spark, path, lambda: _clean_plan(spark, sf), schema=first.schema)


def q_checkpointed_clean(spark, sf):
    return P.clean_titles(_raw(spark, sf), checkpoints=P.CHECKPOINT_SITES)


def q_raw_roundtrip(spark, sf):
    path = scratch_path(spark, "landed")
    publish.write_documents(_payloads(spark, sf), path)
    return P.clean_titles(read_documents(spark, path, keep_corrupt=False))


_SEARCHES = {"genres": E1_GENRES, "cast": E1_CAST, "pair_cast": E2_CAST, "pair_director": E2_DIRECTOR}


def q_report_status(spark, sf):
    builders = report_builders(_clean(spark, sf), **_SEARCHES)
    rows = run_isolated(builders, written_to(spark, scratch_path(spark, "status")), parallelism=4)
    return spark.createDataFrame(rows, "report string, status string, rows long, error string")


# the number that is added up of each report the job writes
REPORT_VALUES = {f"ranking_{name}": metric for name, metric, *_ in RANKING_TABLE} | {
    "search_genres_cast": "vote_average", "search_cast_director": "runtime",
    "franchise_comparison": "mean_revenue", "top_franchises": "total_revenue",
    "top_directors": "total_revenue", "genre_kpis": "avg_revenue", "budget_band_kpis": "mean_budget",
    "chart_revenue_budget": "revenue_musd", "chart_break_even": "max_value", "chart_roi_histogram": "count",
    "chart_roi_median": "median_roi", "chart_revenue_budget_grid": "points",
    "chart_popularity_rating_grid": "points", "chart_franchise_comparison": "value",
    "chart_top_franchises": "total_revenue", "chart_popularity_rating": "popularity",
    "chart_genre_distribution": "movies",
}


def _land(spark, df, path, mode="append"):
    publish.landed(df.select(F.to_json(F.struct(*df.columns)).alias("value")), mode).text(path)


def _staged(spark, df, label):
    """``df`` written once, for several landings that are parts of it."""
    path = scratch_path(spark, label)
    publish.packed(df).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def q_job_outputs(spark, sf):
    """The whole job on landed documents; rows and a total of every data set
    it leaves behind."""
    raw, out = scratch_path(spark, "job-landed"), scratch_path(spark, "job-out")
    _land(spark, _payloads(spark, sf), raw)
    run_job(spark, raw, out, requested=request_ids(spark, sf), searches=_SEARCHES)
    parts = [publish.read_published(spark, f"{out}/clean").agg(
        F.lit("clean").alias("name"), F.count(F.lit(1)).alias("rows"), exact_sum("revenue_musd").alias("total"))]
    parts.append(spark.read.parquet(f"{out}/ingest/outcomes").filter("outcome = 'failed'").agg(
        F.lit("failed requests").alias("name"), F.count(F.lit(1)).alias("rows"), F.lit(0.0).alias("total")))
    for name, value in REPORT_VALUES.items():
        parts.append(spark.read.parquet(f"{out}/analysis/{name}").agg(
            F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"), exact_sum(value).alias("total")))
    table = parts[0]
    for p in parts[1:]:
        table = table.unionByName(p)
    return table


def _landed_at(spark, path, millis):
    """Set the modification time of a folder's files."""
    fs, folder = publish._fs(spark, path)
    for st in fs.listStatus(folder):
        fs.setTimes(st.getPath(), millis, -1)


def q_landed_folders(spark, sf):
    """What reuse finds in four places: documents landed in two nested folders,
    a landing without rows, an empty folder and none at all."""
    root, p = scratch_path(spark, "landings"), _staged(spark, _payloads(spark, sf), "landing-payloads")
    _land(spark, p.filter("id % 2 = 0"), f"{root}/landed/even")
    _land(spark, p.filter("id IS NULL OR id % 2 <> 0"), f"{root}/landed/odd")
    _land(spark, p.filter("id IS NULL AND id IS NOT NULL"), f"{root}/no rows")
    fs, folder = publish._fs(spark, f"{root}/empty")
    fs.mkdirs(folder)
    parts = []
    for name in ("landed", "no rows", "empty", "missing"):
        docs = landed_documents_or_none(spark, f"{root}/{name}")
        found = spark.range(0).select(F.col("id")) if docs is None else docs
        parts.append(found.agg(F.lit(name).alias("folder"), F.lit(docs is not None).alias("found"),
                               F.count(F.lit(1)).alias("documents"), F.count("id").alias("with_id")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def q_incremental_clean(spark, sf):
    """Three landings, a run after each: even ids, where k % 20 = 0 comes with
    another title; the other ids; and the documents of k % 20 = 0 as they
    arrived before all others.  The second and third run parse and merge the
    new files only."""
    raw, out = scratch_path(spark, "inc-landed"), scratch_path(spark, "inc-out")
    p, k = _staged(spark, _payloads(spark, sf), "inc-payloads"), F.col("id")
    even = p.filter(k % 2 == 0)
    _land(spark, even.withColumn("title", F.when(k % 20 == 0, F.lit("not yet known")).otherwise(F.col("title"))), f"{raw}/first")
    build_clean(spark, raw, out)
    _land(spark, p.filter("id IS NULL OR id % 2 <> 0"), f"{raw}/second")
    build_clean(spark, raw, out)
    _land(spark, p.filter(k % 20 == 0), f"{raw}/third")
    _landed_at(spark, f"{raw}/third", 1_000_000_000_000)
    return build_clean(spark, raw, out)[0]


def q_rebuilt_clean(spark, sf):
    """A table brought up to date with other settings, then with a request
    list on unchanged files: what each run left behind."""
    raw, out = scratch_path(spark, "set-landed"), scratch_path(spark, "set-out")
    _land(spark, _payloads(spark, sf), raw)
    strict = build_clean(spark, raw, out, settings=DEFAULTS.with_(min_non_null=20))[0].agg(
        F.lit("at least 20 values").alias("name"), F.count(F.lit(1)).alias("rows"))
    usual = build_clean(spark, raw, out)[0].agg(F.lit("defaults").alias("name"), F.count(F.lit(1)).alias("rows"))
    build_clean(spark, raw, out, requested=request_ids(spark, sf))
    outcomes = (spark.read.parquet(f"{out}/ingest/outcomes").groupBy(F.col("outcome").alias("name"))
                .agg(F.count(F.lit(1)).alias("rows")))
    return strict.unionByName(usual).unionByName(outcomes)


def catalog() -> dict:
    q = {
        "raw_scan": q_raw_scan,
        "clean_sample": q_clean_sample,
        "request_ids": q_request_ids,
        "request_summary": q_request_summary,
        "hoist_credits": q_hoist_credits,
        "ingest_valid": q_ingest_valid,
        "ingest_valid_titled": q_ingest_valid_titled,
        "dedup_first_arrival": q_dedup_first_arrival,
        "typed_mixed_json": q_typed_mixed_json,
        "drop_irrelevant": q_drop_irrelevant,
        "ingest_outcomes": q_ingest_outcomes,
        "ingest_summary": q_ingest_summary,
        "quarantine": q_quarantine,
        "flatten_collection": q_flatten_collection,
        "flatten_names": q_flatten_names,
        "credit_sizes": q_credit_sizes,
        "flatten_directors": q_flatten_directors,
        "typed_titles": q_typed_titles,
        "nullified_titles": q_nullified_titles,
        "dedup_titles": q_dedup_titles,
        "released_titles": q_released_titles,
        "min_non_null": q_min_non_null,
        "clean_titles": q_clean_titles,
        "schema_report": q_schema_report,
        "quality_report": q_quality_report,
        "title_metrics": q_title_metrics,
    }
    for name in rankings.RANKING_NAMES:
        q[f"ranking_{name}"] = _ranking_query(name)
    q.update({
        "rankings_long": q_rankings_long,
        "search_genres_cast": q_search_genres_cast,
        "search_cast_director": q_search_cast_director,
        "search_token": q_search_token,
        "franchise_vs_standalone": q_franchise_vs_standalone,
        "top_franchises": q_top_franchises,
        "top_directors": q_top_directors,
        "top_directors_person": q_top_directors_person,
        "genre_combination_kpis": q_genre_combination_kpis,
        "genre_kpis": q_genre_kpis,
        "budget_band_kpis": q_budget_band_kpis,
        "report_bundle": q_report_bundle,
        "metric_correlations": q_metric_correlations,
        "chart_revenue_budget": q_chart_revenue_budget,
        "chart_revenue_budget_grid": q_chart_revenue_budget_grid,
        "chart_break_even": q_chart_break_even,
        "chart_roi_histogram": q_chart_roi_histogram,
        "chart_roi_median": q_chart_roi_median,
        "chart_franchise_comparison": q_chart_franchise_comparison,
        "chart_top_franchises": q_chart_top_franchises,
        "chart_popularity_rating": q_chart_popularity_rating,
        "chart_popularity_rating_grid": q_chart_popularity_rating_grid,
        "chart_genre_distribution": q_chart_genre_distribution,
        "published_rankings": q_published_rankings,
        "published_clean": q_published_clean,
        "idempotent_clean": q_idempotent_clean,
        "checkpointed_clean": q_checkpointed_clean,
        "raw_roundtrip": q_raw_roundtrip,
        "report_status": q_report_status,
        "job_outputs": q_job_outputs,
        "landed_folders": q_landed_folders,
        "incremental_clean": q_incremental_clean,
        "rebuilt_clean": q_rebuilt_clean,
    })
    return q
