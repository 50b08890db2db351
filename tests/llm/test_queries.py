"""Registered queries against their SQL, held-out accuracy, and the pipeline
against a plain-Python version."""

import hashlib
import os
import zlib

import duckdb
import pytest

import corpus_pipeline
from marquee.llm import bpe, mixing, registry, toxicity
from marquee.llm.common import documents, labels
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.test_cases import LOW, similar

SQL = registry.oracle_sql()


def test_one_query_an_operator():
    assert {n.split("_")[0] for n in registry.queries()} == {f"op{i}" for i in range(1, 14)}
    assert set(SQL) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        p = f"{SF_SMALL}/{t}.parquet"
        assert os.path.exists(p)
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    got = registry.queries()[name](spark, SF_SMALL)
    want = con.sql(SQL[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    mine = sorted(tuple(r[c] for c in cols) for r in got.collect())
    theirs = sorted(tuple(r[want.columns.index(c)] for c in cols) for r in want.fetchall())
    assert mine == theirs


def test_toxicity_held_out_accuracy(spark):
    got = {r.doc_id: r for r in registry.queries()["op10_toxicity"](spark, SF_MID).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(got[r.doc_id].predicted, r.toxic) for r in labels(spark, SF_MID).collect() if got[r.doc_id].held_out]
    assert len(held) > 50 and sum(p == y for p, y in held) / len(held) >= 0.95


def test_pipeline_against_plain_python(spark):
    docs = documents(spark, SF_SMALL)
    model = toxicity.fit(docs, labels(spark, SF_SMALL))
    score = model.scorer()
    rows = [r for r in docs.collect() if score(r.text or "") < 0.5]
    first = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        first.setdefault((r.text or "").translate(LOW), r)
    rows = list(first.values())
    comp = {r.doc_id: r.doc_id for r in rows}
    links = [(a.doc_id, b.doc_id) for i, a in enumerate(rows) for b in rows[i + 1:]
             if similar(a.text, b.text, 5, 80)]
    for _ in links:
        for a, b in links:
            comp[a] = comp[b] = min(comp[a], comp[b])
    rows = [r for r in rows if comp[r.doc_id] == r.doc_id]
    copies = {r.doc_id: r.copies for r in mixing.copies(spark.createDataFrame(rows, docs.schema)).collect()}
    c = bpe.codec(bpe.default_vocabulary())
    want = []
    for r in rows:
        ids = c.bpe.encode_ordinary(r.text or "")
        want += [(r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                  hashlib.sha256((r.text or "").encode()).hexdigest())] * copies[r.doc_id]
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF_SMALL).collect()) == sorted(want)
