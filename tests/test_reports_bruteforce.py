"""Rankings and grouped reports against plain Python on random clean tables
(many ties and nulls)."""

import statistics
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marquee.operators import cohorts, rankings
from marquee.schema import CLEAN_SCHEMA

MONEY = st.one_of(st.none(), st.sampled_from([5.0, 10.0, 12.5, 40.0]))


@st.composite
def clean_rows(draw):
    n = draw(st.integers(1, 25))
    rows = []
    for i in range(1, n + 1):
        r = {f.name: None for f in CLEAN_SCHEMA.fields}
        r.update(id=i, title=f"T{i}", cast_size=0, crew_size=0,
                 budget_musd=draw(MONEY), revenue_musd=draw(MONEY),
                 vote_count=draw(st.sampled_from([None, 3, 10, 50])),
                 vote_average=draw(st.sampled_from([None, 5.0, 7.5])),
                 popularity=draw(st.sampled_from([None, 1.0, 2.0])),
                 belongs_to_collection=draw(st.sampled_from([None, "C1", "C2"])),
                 genres=draw(st.sampled_from([None, "A", "A|B"])))
        rows.append(tuple(r[f.name] for f in CLEAN_SCHEMA.fields))
    return rows


def r2(x):
    return None if x is None else float(Decimal(repr(x)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def mean(xs):
    xs = [Decimal(repr(x)) for x in xs if x is not None]
    return None if not xs else r2(float(sum(xs) / len(xs)))


def roi(r):
    b, v = r["budget_musd"], r["revenue_musd"]
    return v / b if v is not None and b is not None and b > 0 else None


def profit(r):
    b, v = r["budget_musd"], r["revenue_musd"]
    return None if b is None or v is None else v - b


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(clean_rows())
def test_reports_match_plain_python(spark, rows):
    df = spark.createDataFrame(rows, CLEAN_SCHEMA)
    recs = [dict(zip(CLEAN_SCHEMA.fieldNames(), r)) for r in rows]
    for r in recs:
        r["roi"], r["profit"] = roi(r), profit(r)

    # rankings: metric not null, extra filter, order, tiebreak id, top 10
    for name, metric, asc, kind in rankings.RANKING_TABLE:
        ok = [r for r in recs if r[metric] is not None
              and (kind != "min_budget" or (r["budget_musd"] is not None and r["budget_musd"] >= 10))
              and (kind != "min_votes" or (r["vote_count"] is not None and r["vote_count"] >= 10))]
        ok.sort(key=lambda r: ((r[metric] if asc else -r[metric]), r["id"]))
        want = [(r["title"], float(r[metric])) for r in ok[:10]]
        got = [(x.title, float(x[metric])) for x in rankings.ranking(df, name).collect()]
        assert got == want, name

    # franchise vs standalone, with the exact median
    got = {x.category: x for x in cohorts.franchise_vs_standalone(df).collect()}
    for cat in ("Franchise", "Standalone"):
        grp = [r for r in recs if (r["belongs_to_collection"] is not None) == (cat == "Franchise")]
        if not grp:
            assert cat not in got
            continue
        g = got[cat]
        assert g.movie_count == len(grp)
        assert g.mean_revenue == mean([r["revenue_musd"] for r in grp])
        assert g.mean_roi == mean([r["roi"] for r in grp])
        rois = [r["roi"] for r in grp if r["roi"] is not None]
        assert g.median_roi == (r2(statistics.median(rois)) if rois else None)

    # top franchises: order by rounded total revenue desc (nulls last), name
    tf = [(x.belongs_to_collection, x.total_movies, x.total_revenue)
          for x in cohorts.top_franchises(df).collect()]
    groups = {}
    for r in recs:
        if r["belongs_to_collection"] is not None:
            groups.setdefault(r["belongs_to_collection"], []).append(r)
    want = []
    for k, grp in groups.items():
        vals = [Decimal(repr(r["revenue_musd"])) for r in grp if r["revenue_musd"] is not None]
        want.append((k, len(grp), r2(float(sum(vals))) if vals else None))
    want.sort(key=lambda t: (t[2] is None, -(t[2] or 0), t[0]))
    assert tf == want[:10]
