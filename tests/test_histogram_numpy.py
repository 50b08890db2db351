"""ROI histogram bins equal numpy.histogram's on random values (including
duplicates and values on bin edges)."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marquee.operators import charts


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.sampled_from([0.5, 1.0, 1.5, 2.0, 3.0]),
                          st.floats(0.01, 99.99, allow_nan=False)), min_size=2, max_size=80))
def test_histogram_matches_numpy(spark, rois):
    rows = [(i, 10.0, r * 10.0) for i, r in enumerate(rois)]
    df = spark.createDataFrame(rows, "id int, budget_musd double, revenue_musd double")
    vals = [r[2] / r[1] for r in rows]
    vals = [v for v in vals if 0 < v < 100]
    if len(vals) < 2:
        return
    counts, edges = np.histogram(vals, bins=min(30, len(vals)))
    got = sorted(charts.roi_histogram(df).collect(), key=lambda r: r.bin)
    assert [r["count"] for r in got] == counts.tolist()
    assert np.allclose([r.lower for r in got], edges[:-1]) and np.isclose(got[-1].upper, edges[-1])
