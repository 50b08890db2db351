"""Ingest rules and readers on small hand-made inputs."""

import json

import pytest

from marquee.operators import ingest
from marquee.plans.storage import scratch_path
from marquee.sources.readers import landed_documents_or_none, read_documents


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def test_request_hygiene(spark):
    df = ids(spark, [0, 5, 5, 3, -1, 3])
    assert sorted(r.id for r in ingest.request_list(df).collect()) == [3, 5]
    s = ingest.request_summary(df).first()
    assert (s.requested, s.unique_ids, s.valid_ids, s.removed) == (6, 4, 2, 4)


def test_request_errors(spark):
    with pytest.raises(ingest.ExtractionError):
        ingest.check_requests(spark.createDataFrame([], "id long"))
    with pytest.raises(ingest.ExtractionError):
        ingest.check_requests(ids(spark, [0, -3]))
    ingest.check_requests(ids(spark, [1]))


def test_first_copy_and_title_requirement(spark):
    rows = [(1, "a", 0), (1, "b", 1), (2, None, 2), (None, "x", 3)]
    p = spark.createDataFrame(rows, "id long, title string, _arrival long")
    got = {r.id: r.title for r in ingest.first_copy_per_id(p).collect()}
    assert got == {1: "a", 2: None}
    strict = {r.id for r in ingest.first_copy_per_id(p, require=("id", "title")).collect()}
    assert strict == {1}


def test_outcomes_and_rate(spark):
    req = ids(spark, [1, 2, 3, 4, 0])
    fetched = ids(spark, [1, 3])
    out = {r.id: r.outcome for r in ingest.outcomes(req, fetched).collect()}
    assert out == {1: "extracted", 2: "failed", 3: "extracted", 4: "failed"}
    s = ingest.outcome_summary(req, fetched).first()
    assert (s.valid_requested, s.extracted, s.failed, s.success_rate) == (4, 2, 2, 50.0)
    with pytest.raises(ingest.ExtractionError):
        ingest.check_extracted(req, ids(spark, [99]).filter("id < 0"))


def test_json_array_form(spark, tmp_path):
    docs = [{"id": 1, "title": "A", "genres": [{"name": "x"}]}, {"id": 2, "title": "B"}]
    path = tmp_path / "movies.json"
    path.write_text(json.dumps(docs, indent=2))
    df = read_documents(spark, str(path), multi_line=True)
    assert sorted((r.id, r.title) for r in df.collect()) == [("1", "A"), ("2", "B")]


def test_landed_or_none(spark):
    empty = scratch_path(spark, "t-empty")
    assert landed_documents_or_none(spark, empty) is None
    spark.createDataFrame([], "value string").write.text(empty)
    assert landed_documents_or_none(spark, empty) is None
    full = scratch_path(spark, "t-full")
    spark.createDataFrame([('{"id": 1}',)], "value string").write.text(full)
    assert landed_documents_or_none(spark, full).count() == 1


def test_outcome_summary_without_valid_requests(spark):
    s = ingest.outcome_summary(ids(spark, [0, -1]), ids(spark, [1])).first()
    assert (s.valid_requested, s.extracted, s.success_rate) == (0, 0, None)
