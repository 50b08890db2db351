"""How a build of the clean table finds first copies and writes: documents
without company are not shuffled, none are sorted by their folder, what was
staged goes, and filters never change a result."""

import pytest

from marquee.operators import ingest, membership
from marquee.plans import incremental, publish
from marquee.plans.jobs import build_clean
from marquee.plans.storage import scratch_path, shared_dir
from marquee.schema import ARRIVAL_COLUMN
from tests.test_incremental import land, names, title

ROWS = "id long, title string, genres array<string>, _arrival struct<at: long, row: long>"


def rows():
    one = [(i, f"t{i}", ["g", None], (5, i)) for i in range(40)]
    later = [(i, f"late {i}", None, (9, i)) for i in range(0, 40, 3)]
    earlier = [(i, None, [], (1, i)) for i in range(0, 40, 5)]
    hot = [(7, f"hot {k}", ["h"], (7, k)) for k in range(60)]
    odd = [(50, None, ["x"], (3, 1)), (51, "no order", ["y"], None), (52, "a", [], None), (52, "b", [], (8, 8)),
           (53, "a", [], None), (53, "b", [], None), (None, "z", ["n"], (0, 0)), (None, "z", ["n"], (0, 1)),
           (54, "half", [], (None, 2)), (54, "whole", [], (2, None)), (-1, "", None, (2, 2))]
    return one + later + earlier + hot + odd


@pytest.mark.parametrize("require", [("id",), ("id", "title"), ("title",)])
@pytest.mark.parametrize("words", [1, 3, 1 << 20])
def test_filters_of_any_size_keep_the_first_copies(spark, monkeypatch, require, words):
    monkeypatch.setattr(membership, "WORDS", words)
    docs = spark.createDataFrame(rows(), ROWS)
    got = incremental.first_copies(docs, require, scratch_path(spark, "t-first"))
    want = ingest.first_copy_per_id(docs, ARRIVAL_COLUMN, require, keep_order=True)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_filter_finds_what_was_put_in_and_little_else(spark):
    values = spark.range(0, 20_000, 2).selectExpr("IF(id = 0, NULL, id) AS id")
    bits = membership.bit_filter(values, "id")
    every = spark.range(1, 20_000).selectExpr("id").unionByName(values.filter("id IS NULL"))
    found = {r.id for r in membership.maybe_in(every, bits, "id").collect()}
    assert found >= {None, *range(2, 20_000, 2)} and len(found) < 10_100
    assert membership.maybe_in(every, bits, "id", found=False).count() == 20_000 - len(found)


def test_documents_without_copies_are_not_brought_together(spark, monkeypatch):
    given = []
    first = ingest.first_copy_per_id
    monkeypatch.setattr(ingest, "first_copy_per_id", lambda p, *a, **kw: given.append(p.count()) or first(p, *a, **kw))
    raw, out = scratch_path(spark, "t-few"), scratch_path(spark, "t-few-out")
    land(spark, f"{raw}/a", *[title(i) for i in range(60)], *[title(3, "again") for _ in range(40)])
    assert names(build_clean(spark, raw, out)[0]) == {i: "t" for i in range(60)}
    land(spark, f"{raw}/b", *[title(i, "too late") for i in (5, 6)], title(99))
    assert names(build_clean(spark, raw, out)[0]) == {i: "t" for i in (*range(60), 99)}
    assert given == [1, 2]


def test_folders_are_written_without_a_sort_and_the_setting_comes_back(spark, monkeypatch):
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before = spark.conf.get(name)
    packed = publish.packed
    monkeypatch.setattr(publish, "packed", lambda df: seen.append(spark.conf.get(name)) or packed(df))
    root = scratch_path(spark, "t-open")
    got = incremental._write_buckets(spark.range(200), root, "a", 16)
    assert seen == ["16"] and spark.conf.get(name) == before
    assert len(got) == 16 and spark.read.parquet(f"{root}/v=a").count() == 200
    with incremental._open_writers(spark, 16), incremental._open_writers(spark, 4):
        assert spark.conf.get(name) == "16"
    assert spark.conf.get(name) == before
    with pytest.raises(ZeroDivisionError), incremental._open_writers(spark, 16):
        1 / 0
    assert spark.conf.get(name) == before
    raw, work = scratch_path(spark, "t-flat"), scratch_path(spark, "t-flat-work")
    land(spark, raw, title(1), "{broken")
    good, bad = incremental._parsed(spark, raw, False, work)
    assert (good.count(), bad.count()) == (1, 1)
    fs, folder = publish._fs(spark, f"{work}/parsed")
    assert not any(f.isDirectory() for f in fs.listStatus(folder))


def test_what_a_build_staged_goes_with_it(spark):
    def folders():
        fs, folder = publish._fs(spark, f"{shared_dir(spark)}/marquee")
        return {f.getPath().getName() for f in fs.listStatus(folder)}

    raw, out = scratch_path(spark, "t-gone"), scratch_path(spark, "t-gone-out")
    land(spark, raw, title(1), title(1), title(2))
    before = folders()
    table = build_clean(spark, raw, out)[0]
    assert folders() - before == {out.rsplit("/", 1)[1]}
    assert set(names(table)) == {1, 2}


def test_staged_payloads_are_packed(spark):
    from marquee.plans import catalog

    got = catalog._staged(spark, spark.range(5).selectExpr("id", "array('a') AS genres"), "t-packed")
    assert got.count() == 5 and all(f.endswith(".zstd.parquet") for f in got.inputFiles())
