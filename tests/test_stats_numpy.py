"""Correlations vs numpy, genre distribution vs pandas value_counts."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marquee.operators import charts
from marquee.operators.stats import correlations

VAL = st.one_of(st.none(), st.floats(-100, 100, allow_nan=False).map(lambda x: round(x, 3)))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(VAL, VAL, VAL), min_size=3, max_size=40))
def test_correlations_match_numpy(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.metric_a, r.metric_b): r for r in correlations(df, ["a", "b", "c"], decimals=9).collect()}
    cols = {"a": 0, "b": 1, "c": 2}
    for (x, y), r in got.items():
        pairs = [(t[cols[x]], t[cols[y]]) for t in rows
                 if t[cols[x]] is not None and t[cols[y]] is not None]
        assert r.pairs == len(pairs)
        if len(pairs) < 2:
            assert r.correlation is None
            continue
        xs, ys = np.array(pairs).T
        if xs.std() == 0 or ys.std() == 0:
            assert r.correlation is None  # undefined: null, never a failed job
            continue
        want = np.corrcoef(xs, ys)[0, 1]
        assert abs(r.correlation - want) < 1e-6


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(list("ABCDEFGHIJKLMNOPQR")),
                                              min_size=1, max_size=4).map("|".join)),
                min_size=1, max_size=40))
def test_genre_distribution_matches_value_counts(spark, genres):
    df = spark.createDataFrame([(g,) for g in genres], "genres string")
    got = [(r.genre, r.movies) for r in charts.genre_distribution(df).collect()]
    tokens = [t for g in genres if g for t in g.split("|")]
    vc = pd.Series(tokens, dtype="object").value_counts()
    want = sorted(vc.items(), key=lambda kv: (-kv[1], kv[0]))[:15]
    assert got == [(k, int(v)) for k, v in want]
