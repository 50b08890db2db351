"""clean_titles against a plain-Python statement of the same rules on
random documents (identical duplicate copies keep the survivor unambiguous)."""

import datetime as dt
import json
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import docs_frame
from marquee.config import CLEAN_COLUMNS, NULL_PLACEHOLDERS
from marquee.plans.clean import clean_titles

TEXT = st.sampled_from(["x", "Plot", "", "N/A", "No Data", "no data", "NA", " N/A ", None])
NAMES = st.lists(st.fixed_dictionaries({"name": st.sampled_from(["A", "B", "", None])}),
                 max_size=3)
CREW = st.lists(st.fixed_dictionaries({"job": st.sampled_from(["Director", "Writer"]),
                                       "name": st.sampled_from(["D", "E"])}), max_size=3)
NUM = st.one_of(st.none(), st.just(0), st.integers(1, 300_000_000))


@st.composite
def document(draw, i):
    d = {"id": i, "title": draw(st.sampled_from(["T", None])),
         "status": draw(st.sampled_from(["Released", "Released", "Planned", None])),
         "original_language": draw(st.sampled_from(["en", None])),
         "overview": draw(TEXT), "tagline": draw(TEXT),
         "poster_path": draw(st.sampled_from(["/p.jpg", None])),
         "release_date": draw(st.sampled_from(["2001-02-03", "", "1999-13-01", None])),
         "budget": draw(NUM), "revenue": draw(NUM), "runtime": draw(st.sampled_from([None, 0, 95])),
         "vote_count": draw(st.sampled_from([None, 0, 12])),
         "vote_average": draw(st.sampled_from([None, 6.5])),
         "popularity": draw(st.sampled_from([None, 1.25])),
         "belongs_to_collection": draw(st.sampled_from([None, {"id": 1, "name": "C"}])),
         "genres": draw(st.one_of(st.none(), NAMES)),
         "spoken_languages": draw(st.one_of(st.none(), st.lists(
             st.fixed_dictionaries({"english_name": st.sampled_from(["English", ""])}), max_size=2))),
         "production_countries": draw(st.one_of(st.none(), NAMES)),
         "production_companies": draw(st.one_of(st.none(), NAMES)),
         "cast": draw(st.one_of(st.none(), NAMES)),
         "crew": draw(st.one_of(st.none(), CREW)),
         "origin_country": draw(st.one_of(st.none(), st.lists(st.sampled_from(["US", "FR"]), max_size=2)))}
    if draw(st.booleans()):
        d["credits"] = {"cast": draw(st.one_of(st.none(), NAMES)), "crew": draw(CREW)}
    return d


def joined(arr, field="name"):
    if not arr:
        return None
    return "|".join(x[field] for x in arr if x.get(field) is not None)


def expected(docs):
    out = {}
    for d in docs:
        d = dict(d)
        if d.get("credits") is not None:
            d["cast"] = d["credits"].get("cast") or []
            d["crew"] = d["credits"].get("crew") or []
        crew = d["crew"]
        director = None
        if crew:
            director = "|".join(c["name"] for c in crew if c["job"] == "Director")

        def nz(v):
            return None if v in (0, None) else v
        vc = d["vote_count"]
        r = {
            "id": d["id"], "title": d["title"],
            "tagline": None if d["tagline"] in NULL_PLACEHOLDERS else d["tagline"],
            "overview": None if d["overview"] in NULL_PLACEHOLDERS else d["overview"],
            "release_date": dt.date(2001, 2, 3) if d["release_date"] == "2001-02-03" else None,
            "genres": joined(d["genres"]), "spoken_languages": joined(d["spoken_languages"], "english_name"),
            "production_countries": joined(d["production_countries"]),
            "production_companies": joined(d["production_companies"]),
            "cast": joined(d["cast"]), "cast_size": len(d["cast"] or []),
            "director": director, "crew_size": len(crew or []),
            "belongs_to_collection": (d["belongs_to_collection"] or {}).get("name"),
            "original_language": d["original_language"], "poster_path": d["poster_path"],
            "budget_musd": None if nz(d["budget"]) is None else float(d["budget"]) / 1_000_000,
            "revenue_musd": None if nz(d["revenue"]) is None else float(d["revenue"]) / 1_000_000,
            "runtime": nz(d["runtime"]), "vote_count": vc,
            "vote_average": None if vc == 0 else d["vote_average"],
            "popularity": d["popularity"],
            "origin_country": "|".join(d["origin_country"]) if d["origin_country"] else None,
        }
        for c in ("genres", "spoken_languages", "production_countries", "production_companies",
                  "cast", "director", "belongs_to_collection"):
            if r[c] == "":
                r[c] = None
        if r["id"] is None or r["title"] is None or d["status"] != "Released":
            continue
        if sum(v is not None for v in r.values()) < 10:
            continue
        out[r["id"]] = tuple(r[c] for c in CLEAN_COLUMNS)
    return sorted(out.values(), key=lambda t: t[0])


COMPARED = []


@settings(max_examples=int(os.environ.get("BRUTE_EXAMPLES", "6")), deadline=None,
          suppress_health_check=list(HealthCheck))
@given(st.data())
def test_clean_matches_plain_python(spark, data):
    n = data.draw(st.integers(1, 12))
    docs = [data.draw(document(i)) for i in range(1, n + 1)]
    dups = data.draw(st.lists(st.sampled_from(docs), max_size=4))
    all_docs = docs + [json.loads(json.dumps(d)) for d in dups]
    got = sorted((tuple(r) for r in clean_titles(docs_frame(spark, all_docs)).collect()),
                 key=lambda t: t[0])
    want = expected(all_docs)
    COMPARED.append(len(want))
    assert got == want
