"""Properties and cross-checks between operators."""

import random
import statistics

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from marquee.operators import charts, cohorts, rankings, search
from marquee.operators.stats import exact_median
from marquee.plans import publish
from marquee.plans.storage import scratch_path


def test_rankings_long_slices_equal_single_rankings(small_clean):
    long = rankings.rankings_long(small_clean).collect()
    for name, metric, *_ in rankings.RANKING_TABLE:
        single = rankings.ranking(small_clean, name).collect()
        got = sorted((r.rank, r.title, r.value) for r in long if r.ranking == name)
        assert [(t, v) for _, t, v in got] == [(r.title, float(r[metric])) for r in single], name


def test_token_search_subset_of_substring(small_clean):
    crit = {"production_countries": ["NATION_1"]}
    tok = {r.title for r in search.search(small_clean, crit, match="token").collect()}
    sub = {r.title for r in search.search(small_clean, crit).collect()}
    assert tok <= sub and len(tok) < len(sub)


def test_histogram_counts_sum_to_values(small_clean):
    h = charts.roi_histogram(small_clean).collect()
    n = charts.roi_values(small_clean).count()
    assert len(h) == min(30, n)
    assert sum(r["count"] for r in h) == n


def test_histogram_single_value_widened(spark):
    df = spark.createDataFrame([(1, 10.0, 20.0), (2, 10.0, 20.0)],
                               "id int, budget_musd double, revenue_musd double")
    h = sorted(charts.roi_histogram(df).collect(), key=lambda r: r.bin)
    assert len(h) == 2 and h[0].lower == 1.5 and h[-1].upper == 2.5
    assert sum(r["count"] for r in h) == 2


def test_histogram_needs_two_values(spark):
    df = spark.createDataFrame([(1, 10.0, 20.0)], "id int, budget_musd double, revenue_musd double")
    assert charts.roi_histogram(df).count() == 0
    assert charts.roi_median(df).count() == 0


def _median_case(spark, values, groups, **kw):
    rows = [(g, v) for g, v in zip(groups, values)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.median for r in exact_median(df, "v", ["g"], **kw).collect()}
    want = {}
    for g in set(groups):
        vals = [v for gg, v in rows if gg == g and v is not None]
        if vals:
            want[g] = statistics.median(vals)
    assert set(got) == set(want)
    for g in want:
        assert abs(got[g] - want[g]) <= 1e-12 * max(1.0, abs(want[g])), (g, got[g], want[g])


def test_exact_median_small_groups(spark):
    rnd = random.Random(1)
    vals = [rnd.random() for _ in range(501)]
    _median_case(spark, vals, [("a" if i % 3 else "b") for i in range(501)])


def test_exact_median_iterates_on_large_groups(spark):
    # threshold far below the group sizes forces the bucket-narrowing rounds
    rnd = random.Random(7)
    vals = [rnd.lognormvariate(0, 2) for _ in range(4000)]
    groups = ["hot" if i % 4 else "cold" for i in range(4000)]
    _median_case(spark, vals, groups, threshold=40, pivots=8)


def test_exact_median_heavy_duplicates(spark):
    # a third of the values are one repeated number: a constant bucket
    rnd = random.Random(3)
    vals = [1.0 if i % 3 == 0 else rnd.uniform(0, 2) for i in range(3000)]
    _median_case(spark, vals, ["x"] * 3000, threshold=30, pivots=8)
    vals2 = [5.0] * 1000 + [6.0] * 1000
    _median_case(spark, vals2, ["y"] * 2000, threshold=10, pivots=4)


def test_exact_median_without_groups(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)], "v double")
    assert exact_median(df, "v", threshold=3, pivots=4).first()[0] == 4.5


def test_load_or_build_reuses(spark, small_clean):
    path = scratch_path(spark, "t-stage")
    calls = []

    def build():
        calls.append(1)
        return small_clean

    a = publish.load_or_build(spark, path, build)
    b = publish.load_or_build(spark, path, build)
    assert len(calls) == 1
    assert sorted(a.collect()) == sorted(b.collect())
    publish.load_or_build(spark, path, build, fresh=True)
    assert len(calls) == 2


def test_publish_swaps_pointer(spark, small_clean):
    root = scratch_path(spark, "t-pub")
    v1 = publish.publish_table(small_clean.limit(5), root, version="one")
    assert publish.current_version(spark, root) == "one"
    publish.publish_table(small_clean.limit(7), root, version="two")
    assert publish.read_published(spark, root).count() == 7
    # the previous version is untouched
    assert spark.read.parquet(v1).count() == 5


def test_franchise_median_approx_option(small_clean):
    exact = {r.category: r.median_roi for r in cohorts.franchise_vs_standalone(small_clean).collect()}
    approx = {r.category: r.median_roi
              for r in cohorts.franchise_vs_standalone(small_clean, approx=True).collect()}
    assert set(exact) == set(approx)
    for k in exact:
        assert abs(exact[k] - approx[k]) < 0.5


def test_exact_median_empty_input(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert exact_median(df, "v", ["g"]).collect() == []
    assert exact_median(df, "v").collect() == []


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.integers(-50, 50).map(float),
                          st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False)),
                min_size=1, max_size=120),
       st.integers(2, 6))
def test_exact_median_matches_statistics(spark, values, pivots):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_median(df, "v", threshold=5, pivots=pivots).first()[0]
    want = statistics.median(values)
    assert abs(got - want) <= 1e-9 * max(1.0, abs(want))


def test_exact_median_null_group(spark):
    rows = [(None, 1.0), (None, 3.0), ("a", 5.0), ("a", 7.0), ("a", 9.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    for kw in ({}, {"threshold": 1, "pivots": 2}):
        got = {r.g: r.median for r in exact_median(df, "v", ["g"], **kw).collect()}
        assert got == {None: 2.0, "a": 7.0}, kw


def test_exact_median_heavy_ties_take_few_rounds(spark):
    """99 % ties: the tied value is a cut point with a bucket of its own."""
    import statistics

    values = [5.0] * 39_600 + [float(i % 397) / 100 for i in range(400)]
    rounds = []
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_median(df, "v", threshold=1000, on_round=rounds.append).first()[0]
    assert got == statistics.median(values) and len(rounds) <= 4
    # the median just below the tied value
    values = [5.0] * 19_990 + [4.999 - i / 1e6 for i in range(20_010)]
    rounds.clear()
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_median(df, "v", threshold=1000, on_round=rounds.append).first()[0]
    assert got == statistics.median(values) and len(rounds) <= 4
