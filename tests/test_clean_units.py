"""Cleaning rules on hand-written documents (cases the fixture cannot show)."""

import datetime as dt

import pytest

from tests.conftest import docs_frame
from marquee.operators import clean as C
from marquee.operators.ingest import split_corrupt
from marquee.operators.quality import ValidationError, validate_quality, validate_schema
from marquee.plans.clean import clean_titles, flattened, nullified, typed


def base(i, **kw):
    d = {"id": i, "title": f"T{i}", "status": "Released", "original_language": "en",
         "overview": "o", "tagline": "t", "release_date": "2000-01-02", "budget": 20_000_000,
         "revenue": 50_000_000, "runtime": 100, "vote_count": 50, "vote_average": 7.5,
         "popularity": 3.0, "poster_path": "/p.jpg",
         "genres": [{"id": 1, "name": "Action"}, {"id": 2, "name": "Drama"}],
         "spoken_languages": [{"english_name": "English"}],
         "production_countries": [{"name": "US"}], "production_companies": [{"name": "A"}],
         "cast": [{"name": "X"}, {"name": "Y"}],
         "crew": [{"job": "Director", "name": "D"}, {"job": "Writer", "name": "W"}],
         "origin_country": ["US"]}
    d.update(kw)
    return d


def one(df, col, i):
    return df.filter(f"id = {i}").select(col).first()[0]


def test_all_null_collection_and_empty_genres(spark):
    docs = [base(1, belongs_to_collection=None, genres=[]), base(2, belongs_to_collection=None, genres=[])]
    f = flattened(docs_frame(spark, docs))
    assert f.filter("belongs_to_collection is not null or genres is not null").count() == 0


def test_director_and_sizes(spark):
    docs = [base(1, crew=[{"job": "Writer", "name": "W"}]), base(2, crew=None, cast=None),
            base(3, crew=[{"job": "Director", "name": "A"}, {"job": "Director", "name": "B"}])]
    f = flattened(docs_frame(spark, docs))
    assert one(f, "director", 1) == ""          # empty before the null rule
    assert one(nullified(docs_frame(spark, docs)), "director", 1) is None
    assert one(f, "director", 2) is None and one(f, "crew_size", 2) == 0 and one(f, "cast_size", 2) == 0
    assert one(f, "director", 3) == "A|B" and one(f, "crew_size", 3) == 2


def test_null_name_skipped(spark):
    docs = [base(1, genres=[{"name": "A"}, {"name": None}, {"name": "B"}])]
    assert one(flattened(docs_frame(spark, docs)), "genres", 1) == "A|B"


def test_vote_rules(spark):
    docs = [base(1, vote_count=None, vote_average=6.0), base(2, vote_count=0, vote_average=6.0)]
    n = nullified(docs_frame(spark, docs))
    assert one(n, "vote_average", 1) == 6.0
    assert one(n, "vote_average", 2) is None


def test_placeholders_exact_match_only(spark):
    docs = [base(1, tagline=" N/A "), base(2, tagline="n/a"), base(3, tagline="N/A"),
            base(4, overview="no data"), base(5, overview="")]
    n = nullified(docs_frame(spark, docs))
    assert one(n, "tagline", 1) == " N/A " and one(n, "tagline", 2) == "n/a"
    assert one(n, "tagline", 3) is None
    assert one(n, "overview", 4) is None and one(n, "overview", 5) is None


def test_release_date_forms(spark):
    docs = [base(1, release_date=""), base(2, release_date="1999"), base(3, release_date="1999-05"),
            base(4, release_date="1999-13-01")]
    t = typed(docs_frame(spark, docs))
    assert one(t, "release_date", 1) is None
    assert one(t, "release_date", 2) == dt.date(1999, 1, 1)
    assert one(t, "release_date", 3) == dt.date(1999, 5, 1)
    assert one(t, "release_date", 4) is None


def test_large_ids_and_counts_are_kept(spark):
    docs = [base(1), base(3_000_000_000, vote_count=5_000_000_000, runtime=4_000_000_000)]
    c = {r.id: r for r in clean_titles(docs_frame(spark, docs)).collect()}
    assert set(c) == {1, 3_000_000_000}
    assert c[3_000_000_000].vote_count == 5_000_000_000 and c[3_000_000_000].runtime == 4_000_000_000


def test_numbers_in_any_form_keep_the_title(spark):
    docs = [base("4", budget=1500000.0, runtime=100.0), base(5, budget="2000000", runtime="90", popularity="1.5"),
            base(6.0, budget="many", popularity="NaN", genres="not a list")]
    good, bad = split_corrupt(docs_frame(spark, docs))
    assert bad.count() == 0
    t = {r.id: r for r in nullified(good).collect()}
    assert t[4].budget_musd == 1.5 and t[4].runtime == 100
    assert t[5].budget_musd == 2.0 and t[5].runtime == 90 and t[5].popularity == 1.5
    assert t[6].budget_musd is None and t[6].popularity is None and t[6].genres is None


def test_quarantine_says_why(spark):
    docs = [base(1), '{"id": "x", "title": "bad"}', '{"id": 5, "title": ', '{"title": "no id"}']
    good, bad = split_corrupt(docs_frame(spark, docs))
    assert sorted(r.reason for r in bad.collect()) == ["bad id", "malformed"]
    assert good.count() == 2


def test_sums_leave_out_what_no_decimal_holds(spark):
    from marquee.functions.columns import exact_avg, exact_sum
    df = spark.createDataFrame([(1e300,), (float("nan"),), (1.0,), (2.0,)], "v double")
    assert tuple(df.agg(exact_avg("v"), exact_sum("v")).first()) == (1.5, 3.0)


def test_a_name_twice_in_a_title_counts_once(spark):
    from marquee.operators.cohorts import top_directors
    df = spark.createDataFrame([(1, "A|A", 10.0, 1.0, 5.0), (2, "A|B", 5.0, 1.0, 7.0)],
                               "id long, director string, revenue_musd double, budget_musd double, vote_average double")
    got = {r.director: (r.total_movies, r.total_revenue) for r in top_directors(df, by="person").collect()}
    assert got == {"A": (2, 15.0), "B": (1, 5.0)}


def test_text_id_quarantined(spark):
    docs = [base(1), '{"id": "x", "title": "bad"}', '{"id": 5, "title": ']
    good, bad = split_corrupt(docs_frame(spark, docs))
    assert good.count() == 1 and bad.count() == 2


def test_duplicate_survivor_decided_before_status(spark):
    docs = [base(7, status="Planned", title="a"), base(7, status="Released", title="b")]
    raw = docs_frame(spark, docs)
    # deterministic survivor: smallest title -> 'a' (Planned) -> filtered out
    assert clean_titles(raw, prefer=["title"]).count() == 0
    released_first = C.F.when(C.F.col("status") == "Released", 0).otherwise(1)
    kept = clean_titles(raw, prefer=[released_first])
    assert [r.title for r in kept.collect()] == ["b"]


def test_credits_wins(spark):
    d = base(1, cast=[{"name": "Top"}])
    d["credits"] = {"cast": [{"name": "C1"}, {"name": "C2"}], "crew": None}
    f = flattened(docs_frame(spark, [d]))
    assert one(f, "cast", 1) == "C1|C2"
    assert one(f, "crew_size", 1) == 0


def test_zero_and_null_money(spark):
    from marquee.operators.metrics import with_metrics
    docs = [base(1, budget=0), base(2, budget=None), base(3, revenue=None)]
    m = with_metrics(nullified(docs_frame(spark, docs)))
    for i in (1, 2, 3):
        assert one(m, "roi", i) is None and one(m, "profit", i) is None


def test_empty_input_fails_quality(spark):
    c = clean_titles(docs_frame(spark, [base(1, status="Planned")]))
    validate_schema(c)
    with pytest.raises(ValidationError):
        validate_quality(c)


def test_min_non_null(spark):
    sparse = {"id": 9, "title": "S", "status": "Released", "original_language": "en"}
    c = clean_titles(docs_frame(spark, [base(1), sparse]))
    assert [r.id for r in c.collect()] == [1]


def test_top_n_zero_rejected(spark, small_clean):
    from marquee.operators.rankings import ranking
    with pytest.raises(ValueError):
        ranking(small_clean, "most_popular", top_n=0)
