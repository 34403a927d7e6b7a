"""Every registered query against its DuckDB oracle on sf0.001 (the driver's
check runs the same at sf0.01); rows-only queries must run."""

import math

import duckdb
import pytest

from conftest import SF_SMALL
from ledgerline.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    df = catalog.queries()[name](spark, SF_SMALL)
    got = [r.asDict() for r in df.collect()]
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert df.columns
        return
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = [dict(zip(cols, r)) for r in cur.fetchall()]
    assert sorted(cols) == sorted(df.columns)
    assert _rows(got, sorted(cols)) == _rows(want, sorted(cols))
