"""Two-pass exact medians, grouped reports of one scan, numbering by partitions."""

import statistics

from pyspark.sql import functions as F

from marquee.operators import stats
from marquee.operators.search import search
from marquee.plans import bundle
from marquee.plans.storage import scratch_path


def test_median_of_ties_gaps_and_nulls(spark, monkeypatch):
    groups = {"ties": [5.0] * 3000 + [7.0] * 2999, "even": [float(i) for i in range(20_000)], "one": [2.5],
              "two": [1.0, 4.0], None: [3.0, 9.0, 9.0]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("two", float("nan")), ("two", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(8)
    want = {g: statistics.median(v) for g, v in groups.items()} | {"none": None}

    def got():
        out = stats.aggregated_with_median(df, "v", ["g"], [F.count(F.lit(1)).alias("n")]).collect()
        assert {r.g: r.n for r in out} == {g: len(v) for g, v in groups.items()} | {"two": 4, "none": 1}
        return {r.g: r.median for r in out}

    assert got() == want
    # a sketch too small for its margin: what it misses is found without it
    monkeypatch.setattr(stats, "SKETCH_SIZE", 8)
    monkeypatch.setattr(stats, "RANK_MARGIN", 0.0001)
    assert got() == want


def test_grouped_reports_scan_the_table_once(spark, small_clean):
    path = scratch_path(spark, "t-bundle")
    small_clean.write.parquet(path)
    rows = bundle.group_rows(spark.read.parquet(path))
    plan = rows.groupBy("grouping", "key").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "overview" not in plan


def test_numbering_has_no_single_task(spark):
    df = spark.range(1000).selectExpr("id", "concat('t', id % 7) AS title", "double(id % 10) AS v").repartition(6)
    out = search(df, {"title": "t"}, order_by="v", ascending=False, select=["id", "v"], position=True)
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    want = sorted(((-(i % 10), i) for i in range(1000)))
    assert {r.id: r.position for r in out.collect()} == {i: k for k, (_, i) in enumerate(want, 1)}
