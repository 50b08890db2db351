"""End-to-end job: landed payloads (with a malformed line) -> quarantine,
published clean table, isolated reports; a second run reuses the table."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from marquee.plans import publish
from marquee.plans.jobs import run
from marquee.plans.storage import scratch_path
from marquee.sources.fixtures import payloads


def test_run_end_to_end(spark):
    landing = scratch_path(spark, "t-job-landing")
    p = payloads(spark, SF_SMALL)
    p.select(F.to_json(F.struct(*p.columns)).alias("value")).write.text(f"{landing}/a")
    spark.createDataFrame([('{"id": 1, "title": ',)], "value string").write.text(f"{landing}/b")
    out = scratch_path(spark, "t-job-out")

    first = run(spark, f"{landing}/*", out)
    assert first["quarantined"] == 1
    assert all(r[1] == "ok" for r in first["reports"]), first["reports"]
    clean = publish.read_published(spark, f"{out}/clean")
    assert clean.count() == 473
    assert spark.read.parquet(f"{out}/analysis/top_franchises").count() == 10

    # every report of the bundle is on disk
    for name, *_ in first["reports"]:
        assert spark.read.parquet(f"{out}/analysis/{name}").columns

    second = run(spark, f"{landing}/*", out)
    assert second["quarantined"] is None          # clean stage reused
    assert publish.read_published(spark, f"{out}/clean").count() == 473

    # a new file: the table is built again, and the old quarantine is replaced
    doc = {"id": 10_000_000_001, "title": "New", "status": "Released", "overview": "o", "tagline": "t",
           "original_language": "en", "poster_path": "/p", "budget": 5, "revenue": 7, "runtime": 90,
           "vote_count": 20, "vote_average": 7.5, "popularity": 1.0}
    import json
    spark.createDataFrame([(json.dumps(doc),)], "value string").write.text(f"{landing}/c")
    third = run(spark, f"{landing}/*", out)
    assert third["quarantined"] == 1
    assert publish.read_published(spark, f"{out}/clean").filter("id = 10000000001").count() == 1


def test_report_that_fails_at_run_time_is_recorded(spark):
    from marquee.plans.reports import run_isolated, written_to

    df = spark.createDataFrame([(1, 0)], "a int, b int")
    builders = {"good": lambda: df, "bad": lambda: df.select(F.assert_true(F.col("b") > 0), "a"),
                "long": lambda: (_ for _ in ()).throw(ValueError("x" * 900))}
    got = {r[0]: r for r in run_isolated(builders, written_to(spark, scratch_path(spark, "t-iso")))}
    assert got["good"][1:3] == ("ok", 1) and got["bad"][1] == "failed"
    assert got["long"][3] == "ValueError: " + "x" * 900


def test_readers_never_miss_the_table_while_it_is_published(spark):
    import threading

    root = scratch_path(spark, "t-atomic")
    publish.publish_table(spark.range(3), root)
    errors, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                assert publish.read_published(spark, root).count() == 3
            except Exception as e:  # noqa: BLE001
                errors.append(e)
    t = threading.Thread(target=read)
    t.start()
    for _ in range(50):
        publish.publish_table(spark.range(3), root)
    stop.set()
    t.join()
    assert not errors
    assert publish.drop_versions(spark, root, keep=2, seconds=0) == 49
    assert publish.read_published(spark, root).count() == 3


def test_first_copy_needs_an_order(spark):
    import pytest
    from marquee.operators.ingest import first_copy_per_id
    with pytest.raises(ValueError):
        first_copy_per_id(spark.createDataFrame([(1, "a")], "id long, title string"))


def test_requested_ids_are_checked_and_their_outcomes_written(spark):
    import pytest
    from marquee.operators.ingest import ExtractionError

    landing, out = scratch_path(spark, "t-req"), scratch_path(spark, "t-req-out")
    payloads(spark, SF_SMALL).write.json(landing)
    with pytest.raises(ExtractionError):
        run(spark, landing, out, requested=spark.createDataFrame([(0,)], "id long"))
    run(spark, landing, out, requested=spark.createDataFrame([(1,), (99_999_999,)], "id long"))
    got = {r.id: r.outcome for r in spark.read.parquet(f"{out}/ingest/outcomes").collect()}
    assert got[99_999_999] == "failed" and len(got) == 2


def test_failed_quality_gate_keeps_previous_version(spark):
    import pytest
    from marquee.operators.quality import ValidationError
    from marquee.plans.jobs import build_clean

    landing = scratch_path(spark, "t-job-bad")
    spark.createDataFrame([('{"id": 1, "title": "t", "status": "Planned"}',)], "value string") \
        .write.text(landing)
    out = scratch_path(spark, "t-job-bad-out")
    with pytest.raises(ValidationError):
        build_clean(spark, landing, out)
    assert publish.current_version(spark, f"{out}/clean") is None
