"""Differential test: every registered job against its DuckDB statement on
the smallest fixture (the driver runs the same at sf0.01). Set
TILLROLL_ORACLE_SF to another fixture directory to run it there."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL as _SF_DEFAULT
from tillroll.plans.registry import JOBS
from tillroll.sources.fixtures import PHYSICAL

SF_SMALL = os.environ.get("TILLROLL_ORACLE_SF", _SF_DEFAULT)
QUERIES = {k: v for k, v in entry.queries().items() if k not in entry.LLM_QUERIES}
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in PHYSICAL:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_job_has_an_oracle():
    assert len(QUERIES) == len(JOBS)
    assert set(QUERIES) == set(ORACLE)


def _key(row):
    return repr(tuple(row))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_job_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    idx = [ocols.index(c) for c in df.columns]
    want = [tuple(r[i] for i in idx) for r in res.fetchall()]
    assert sorted(got, key=_key) == sorted(want, key=_key)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["date", "category", "total_sales", "product_count", "avg_price"]
    assert df.count() > 0
