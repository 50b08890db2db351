"""Every registered query against its DuckDB oracle at sf0.001 (the driver
runs the same comparison at sf0.01)."""

import os

import duckdb
import pytest

from tests.conftest import SF_SMALL
from tools.compare import TABLES, _digest

import __spark_entry__ as E
from marquee.plans.catalog import catalog

CATALOG = catalog()
QUERIES = E.queries()
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in CATALOG}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(CATALOG) == set(ORACLE)


def test_entry(spark):
    rows = E.entry(spark).collect()
    assert 0 < len(rows) <= 10


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    srows = [r.asDict() for r in sdf.collect()]
    res = con.sql(ORACLE[name])
    drows = [dict(zip(res.columns, r)) for r in res.fetchall()]
    assert sorted(sdf.columns) == sorted(res.columns)
    assert len(srows) == len(drows)
    cols = sorted(sdf.columns)
    assert _digest(srows, cols)[0] == _digest(drows, cols)[0]


def test_report_status_all_ok(spark):
    rows = QUERIES["report_status"](spark, SF_SMALL).collect()
    assert rows and all(r.status == "ok" for r in rows), [r for r in rows if r.status != "ok"]
