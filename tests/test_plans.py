"""Physical plan shape: top-k without a full sort, one scan for ten
rankings with a partial group limit, no Python evaluation anywhere,
projection and filter pushdown into the Parquet scan."""

from tests.conftest import SF_SMALL
from marquee.operators import rankings
from marquee.plans.catalog import catalog


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ranking_is_take_ordered(small_clean):
    p = plan(rankings.ranking(small_clean, "highest_revenue"))
    assert "TakeOrderedAndProject" in p


def test_rankings_long_uses_group_limit(small_clean):
    df = rankings.rankings_long(small_clean)
    df.collect()
    assert "WindowGroupLimit" in plan(df)


def test_no_python_udf_in_any_query(spark):
    qs = catalog()
    for name in ("clean_titles", "rankings_long", "franchise_vs_standalone", "top_directors_person",
                 "chart_roi_histogram", "metric_correlations", "search_token", "hoist_credits",
                 "ingest_summary", "chart_genre_distribution"):
        p = plan(qs[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
        assert "PythonUDF" not in p, name


def test_scan_is_pruned(spark):
    df = catalog()["clean_sample"](spark, SF_SMALL)
    p = plan(df)
    assert "ReadSchema: struct<title:string,genres:string,belongs_to_collection:string," in \
        df._jdf.queryExecution().executedPlan().treeString(), p
    assert "poster_path" not in df._jdf.queryExecution().executedPlan().treeString()


def test_job_reports_scan_only_their_columns(spark, small_clean):
    """Reports over a published table read pruned columns and nothing cached."""
    from marquee.plans.reports import report_builders
    from marquee.plans.storage import scratch_path
    path = scratch_path(spark, "t-pruned")
    small_clean.write.parquet(path)
    for name, build in report_builders(spark.read.parquet(path)).items():
        p = build()._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryTableScan" not in p and "overview" not in p and "poster_path" not in p, (name, p)


def test_clean_has_one_dedupe(spark):
    df = catalog()["clean_titles"](spark, SF_SMALL)
    # analyzed plan: unaffected by cached identical plans in this session
    analyzed = df._jdf.queryExecution().analyzed().toString()
    assert analyzed.count("Aggregate [id") == 1


def test_dedupe_combines_before_the_shuffle(spark):
    from marquee.operators.clean import dedupe_by_id
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, title string")
    for d in (dedupe_by_id(df), dedupe_by_id(df, prefer=["title"])):
        p = plan(d)
        exch = p.index("Exchange")
        # a partial aggregate sits below (after, in the tree string) the exchange
        assert "functions=[partial_" in p[exch:], p


def test_clean_over_documents_has_one_shuffle(spark):
    from marquee.plans.clean import clean_titles
    from marquee.plans.storage import scratch_path
    from marquee.sources.fixtures import payloads
    from marquee.sources.readers import read_documents
    path = scratch_path(spark, "t-docs")
    payloads(spark, SF_SMALL).write.json(path)
    df = clean_titles(read_documents(spark, path))
    df.write.format("noop").mode("overwrite").save()
    p = plan(df)
    assert p.count("Exchange hashpartitioning") == 1, p
    assert "BroadcastExchange" not in p
