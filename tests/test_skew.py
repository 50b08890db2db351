"""Hot keys: one id holding a third of all rows, one group holding most
values of a median, a hot collection in a report."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from marquee.operators import cohorts
from marquee.operators.stats import exact_median
from marquee.plans.clean import clean_titles
from marquee.sources.fixtures import raw_titles


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_hot_duplicate_id_collapses(spark):
    raw = raw_titles(spark, SF_SMALL)
    n = raw.count()
    one = raw.filter(F.col("id") == 10).dropDuplicates()
    copies = (one.withColumn("_c", F.explode(F.sequence(F.lit(1), F.lit(n // 2))))
              .drop("_c"))
    skewed = raw.unionByName(copies)           # id 10 now holds a third of the rows
    assert skewed.filter(F.col("id") == 10).count() > n // 2
    out = clean_titles(skewed)
    assert rows(out) == rows(clean_titles(raw))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial" in plan.lower() or "SortAggregate" in plan


def test_hot_group_median_and_report(spark, small_clean):
    # every title moved into one collection: a single group with all rows
    hot = small_clean.withColumn("belongs_to_collection", F.lit("Hot Collection"))
    top = cohorts.top_franchises(hot).collect()
    assert len(top) == 1 and top[0].total_movies == small_clean.count()
    med = exact_median(hot.withColumn("roi", F.col("revenue_musd") / F.col("budget_musd")),
                       "roi", ["belongs_to_collection"], threshold=20, pivots=8).first()
    vals = sorted(r.v for r in hot.select((F.col("revenue_musd") / F.col("budget_musd")).alias("v"))
                  .dropna().collect())
    k = len(vals)
    want = (vals[(k - 1) // 2] + vals[k // 2]) / 2
    assert abs(med.median - want) < 1e-12
