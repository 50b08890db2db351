"""The command line runs the job and reports status as JSON."""

import json

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from marquee.__main__ import main
from marquee.plans.storage import scratch_path
from marquee.sources.fixtures import payloads


def test_cli_run(spark, capsys):
    landing = scratch_path(spark, "t-cli-landing")
    p = payloads(spark, SF_SMALL)
    p.select(F.to_json(F.struct(*p.columns)).alias("value")).write.text(landing)
    out = scratch_path(spark, "t-cli-out")
    assert main(["run", "--raw", landing, "--out", out]) == 0
    status = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert status["quarantined"] == 0
    assert {r["report"] for r in status["reports"]} >= {"top_franchises", "ranking_most_popular"}
    assert main(["run", "--raw", landing, "--out", out, "--fresh"]) == 0


def test_budget_bands_approx_option(small_clean):
    from marquee.operators.cohorts import budget_band_kpis
    exact = {r.band: r.median_roi for r in budget_band_kpis(small_clean, (1, 10, 25, 40)).collect()}
    approx = {r.band: r.median_roi
              for r in budget_band_kpis(small_clean, (1, 10, 25, 40), approx=True).collect()}
    assert set(exact) == set(approx)
