"""What queries move and write: gzipped landings, payloads derived once for
several landings, one order of arrival a row, partitions by the input's size."""

import pytest

from marquee.operators.ingest import first_copy_per_id
from marquee.plans import catalog, publish
from marquee.plans.storage import scratch_path
from marquee.sources import fixtures
from marquee.sources.readers import landed_documents_or_none, read_documents


def files(spark, path):
    fs, folder = publish._fs(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")]


def test_landings_are_gzipped_in_bounded_files(spark, monkeypatch):
    monkeypatch.setattr(publish, "FILE_DOCUMENTS", 40)
    df = spark.range(100).selectExpr("id", "concat('t', id) AS title").coalesce(1)
    one, two = scratch_path(spark, "t-gz"), scratch_path(spark, "t-gz")
    publish.write_documents(df, one)
    catalog._land(spark, df, two)
    for path in (one, two):
        names = files(spark, path)
        assert len(names) == 3 and all(n.endswith(".gz") for n in names)
        docs = read_documents(spark, path, arrival=True)
        assert {(r.id, r.title) for r in docs.collect()} == {(str(i), f"t{i}") for i in range(100)}
        assert docs.select("_arrival").distinct().count() == 100


def test_a_compressed_landing_without_rows_is_none(spark):
    none, some = scratch_path(spark, "t-none"), scratch_path(spark, "t-some")
    catalog._land(spark, spark.range(5).filter("id < 0"), none)
    catalog._land(spark, spark.range(1), some)
    assert files(spark, none)
    assert landed_documents_or_none(spark, none) is None
    assert landed_documents_or_none(spark, some).count() == 1


def test_first_copies_keep_one_order_a_row(spark):
    rows = [(1, "b", 2), (1, "a", 5), (1, "none", None), (2, "x", None), (3, None, 1), (3, "y", 2), (None, "z", 0)]
    p = spark.createDataFrame(rows, "id long, title string, _arrival int")
    got = first_copy_per_id(p, keep_order=True)
    assert got.columns == ["id", "title", "_arrival"]
    # a row without an order never wins over one with it
    assert {tuple(r) for r in got.collect()} == {(1, "b", 2), (2, None, None), (3, None, 1)}
    buffers = [x for x in got._jdf.queryExecution().executedPlan().toString().split("\n") if "partial_" in x]
    assert buffers and all("min_by" not in x for x in buffers)


def test_several_landings_derive_their_payloads_once(spark, monkeypatch):
    seen = []
    land = catalog._land
    monkeypatch.setattr(catalog, "_land", lambda s, df, *a: seen.append(df) or land(s, df, *a))
    assert catalog.q_landed_folders(spark, "/root/testdata/sf0.001").count() == 4
    assert len(seen) == 3
    for df in seen:
        assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("stored, tasks", [(fixtures.LINE_BYTES * 16, None), (fixtures.LINE_BYTES * 100, 100)])
def test_documents_are_built_in_partitions_sized_by_the_input(spark, stored, tasks):
    lines = spark.range(10).selectExpr("id AS l_orderkey")
    plan = fixtures._by_order(lines, stored)._jdf.queryExecution().executedPlan().toString()
    assert ("REPARTITION_BY_NUM" in plan and "hashpartitioning(l_orderkey#" in plan and f", {tasks})" in plan) == (tasks is not None)
