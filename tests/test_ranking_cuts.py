"""The cuts of the ten rankings: few rows are left to sort, none of the best is lost."""

import pytest
from pyspark.sql import functions as F

from marquee.operators import rankings


def titles(spark, n, distinct):
    h = F.pmod(F.xxhash64("id"), F.lit(distinct))
    return spark.range(n).select(
        "id", F.concat(F.lit("t"), "id").alias("title"), F.lit("2001-01-01").cast("date").alias("release_date"), F.lit("g").alias("genres"),
        (h % 9973 + 1).cast("double").alias("budget_musd"), (h / 7).alias("revenue_musd"), (h % 100_003).alias("vote_count"),
        F.when(h % 5 != 0, h / 1e6).alias("vote_average"), (h * 1.5).alias("popularity"))


def test_a_million_rows_leave_few_candidates(spark):
    df = titles(spark, 1_000_000, 1 << 40)
    left = {r.ranking: r["count"] for r in rankings.ranking_candidates(df, 10).groupBy("ranking").count().collect()}
    # highest_budget has 9,973 values and so about 100 rows a value
    assert len(left) == 10 and all(10 <= v <= 300 for v in left.values()), left


@pytest.mark.parametrize("rows,distinct,n", [(3000, 1 << 40, 10), (3000, 7, 10), (6, 1 << 40, 10), (300, 50, 5000), (0, 5, 3)])
def test_the_best_are_kept_with_ties_and_short_rankings(spark, rows, distinct, n):
    df = titles(spark, rows, distinct).cache()
    got = {(r.ranking, r.rank): r.title for r in rankings.rankings_long(df, n).collect()}
    want = {}
    for name in rankings.RANKING_NAMES:
        for k, r in enumerate(rankings.ranking(df, name, n).collect()):
            want[name, k + 1] = r.title
    assert got == want
