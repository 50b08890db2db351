"""The clean table kept up to date: only new files parsed, first copies by
arrival, settings and request lists taken into account, one winner of two runs."""

import json

import pytest

from marquee.config import DEFAULTS
from marquee.operators import cohorts
from marquee.operators.quality import ValidationError
from marquee.plans import incremental, publish
from marquee.plans.catalog import _landed_at
from marquee.plans.jobs import build_clean
from marquee.plans.storage import scratch_path


def title(i, name="t", **more):
    return {"id": i, "title": name, "status": "Released", "overview": "o", "tagline": "g", "original_language": "en",
            "poster_path": "/p", "budget": 5, "revenue": 7, "runtime": 90, "vote_count": 20, "vote_average": 7.5,
            "popularity": 1.0} | more


def land(spark, path, *docs):
    spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "value string") \
        .coalesce(1).write.text(path)


def names(df):
    return {r.id: r.title for r in df.select("id", "title").collect()}


@pytest.fixture()
def parsed(monkeypatch):
    """What each run gave the JSON reader."""
    seen = []
    read = incremental.read_documents
    monkeypatch.setattr(incremental, "read_documents", lambda spark, path, **kw: seen.append(path) or read(spark, path, **kw))
    return seen


def test_only_new_files_are_parsed_and_the_first_copy_wins(spark, parsed):
    raw, out = scratch_path(spark, "t-inc"), scratch_path(spark, "t-inc-out")
    land(spark, f"{raw}/a", title(1), title(2, "late"), "{broken")
    assert build_clean(spark, raw, out)[1] == 1
    before = publish.current_version(spark, f"{out}/clean")
    assert build_clean(spark, raw, out)[1] is None and len(parsed) == 1
    land(spark, f"{raw}/b", title(2, "early"), title(3), title("4.7"))
    _landed_at(spark, f"{raw}/b", 1_000_000_000_000)
    table, bad = build_clean(spark, raw, out)
    assert names(table) == {1: "t", 2: "early", 3: "t"} and bad == 2
    assert [f.rsplit("/", 2)[1] for f in parsed[1]] == ["b"]
    land(spark, f"{raw}/c", title(1, "too late"))
    table, _ = build_clean(spark, raw, out)
    assert names(table) == {1: "t", 2: "early", 3: "t"}
    # buckets without a new document are those of earlier versions
    version = publish.current_version(spark, f"{out}/clean")
    parts = publish.read_parts(spark, f"{out}/clean", version)
    assert version != before and set(parts.values()) - {version}
    reasons = {r.reason for r in incremental.read_quarantine(spark, out).select("reason").collect()}
    assert reasons == {"malformed", "bad id"}


def test_changed_files_and_settings_mean_a_full_build(spark, parsed):
    raw, out = scratch_path(spark, "t-full"), scratch_path(spark, "t-full-out")
    sparse = {"id": 5, "title": "s", "status": "Released", "overview": "o"}
    land(spark, f"{raw}/a", title(1), sparse)
    land(spark, f"{raw}/b", title(2))
    assert set(names(build_clean(spark, raw, out)[0])) == {1, 2}
    assert set(names(build_clean(spark, raw, out, settings=DEFAULTS.with_(min_non_null=3))[0])) == {1, 2, 5}
    assert set(names(build_clean(spark, raw, out)[0])) == {1, 2}
    assert parsed == [raw] * 3
    fs, folder = publish._fs(spark, f"{raw}/b")
    fs.delete(folder, True)
    assert set(names(build_clean(spark, raw, out)[0])) == {1}
    assert parsed == [raw] * 4


def test_outcomes_on_reuse_and_quarantine_when_the_gate_fails(spark):
    raw, out = scratch_path(spark, "t-req2"), scratch_path(spark, "t-req2-out")
    land(spark, f"{raw}/a", title(1))
    build_clean(spark, raw, out)
    build_clean(spark, raw, out, requested=spark.createDataFrame([(1,), (9,)], "id long"))
    got = {r.id: r.outcome for r in spark.read.parquet(f"{out}/ingest/outcomes").collect()}
    assert got == {1: "extracted", 9: "failed"}
    raw, out = scratch_path(spark, "t-gate"), scratch_path(spark, "t-gate-out")
    land(spark, f"{raw}/a", title(1, status="Planned"), "{broken")
    with pytest.raises(ValidationError):
        build_clean(spark, raw, out)
    assert publish.current_version(spark, f"{out}/clean") is None
    assert spark.read.json(f"{out}/quarantine").filter("reason = 'malformed'").count() == 1


def test_two_runs_on_one_version_have_one_winner(spark):
    root = scratch_path(spark, "t-race")
    publish.publish_table(spark.range(3), root, "a")
    one, two = publish.write_version(spark.range(4), root, "b"), publish.write_version(spark.range(5), root, "c")
    publish.point_to(spark, root, one, base="a")
    with pytest.raises(publish.PublishConflict):
        publish.point_to(spark, root, two, base="a")
    assert publish.read_published(spark, root).count() == 4
    # a run that has taken the next number and not published yet
    assert publish._claimed(spark, root, 3)
    with pytest.raises(publish.PublishConflict):
        publish.point_to(spark, root, two, base="b")
    publish.publish_table(spark.range(6), root, "d")
    assert publish.read_published(spark, root).count() == 6


def test_dead_and_unneeded_versions_go_and_shared_buckets_stay(spark):
    root = scratch_path(spark, "t-drop")
    frame = spark.range(8).selectExpr("id", "int(id % 2) AS bucket")
    for v in "ab":
        frame.write.partitionBy("bucket").parquet(f"{root}/v={v}")
    publish.write_parts(spark, root, "a", {0: "a", 1: "a"})
    publish.write_parts(spark, root, "b", {0: "a", 1: "b"})
    for v in "ab":
        publish.point_to(spark, root, v)
    publish.write_version(spark.range(2), root, "dead")
    publish.drop_versions(spark, root, keep=1, seconds=0)
    assert not publish.path_exists(spark, f"{root}/v=dead") and publish.path_exists(spark, f"{root}/v=a")
    assert sorted(r.id for r in publish.read_published(spark, root).collect()) == list(range(8))


def test_sums_and_ids_no_number_can_spoil(spark):
    from pyspark.sql import functions as F

    from marquee.functions.columns import to_id, to_whole

    rows = [(i, f"t{i}", "c", "g", "d", 9e27, 9e27, 7.0, 1.0) for i in range(4)] + [(9, "t9", "x", "g", "d", 3.0, 5.0, 7.0, 1.0)]
    clean = spark.createDataFrame(rows, "id long, title string, belongs_to_collection string, genres string, director string, "
                                        "budget_musd double, revenue_musd double, vote_average double, popularity double")
    got = {r.belongs_to_collection: r for r in cohorts.top_franchises(clean).collect()}
    assert got["c"].total_revenue is None and got["x"].total_revenue == 5.0
    for report in (cohorts.top_directors(clean), cohorts.genre_kpis(clean), cohorts.franchise_vs_standalone(clean),
                   cohorts.budget_band_kpis(clean)):
        assert report.count()
        report.collect()
    ids = spark.createDataFrame([("9007199254740993.0",), ("4.7",), ("4",), ("x",), ("1e3",), (None,)], "id string")
    assert [tuple(r) for r in ids.select(to_whole("id"), to_id("id")).collect()] == [
        (9007199254740993, 9007199254740993), (4, None), (4, 4), (None, None), (1000, 1000), (None, None)]
