"""Every query of the catalogue against its SQL, run by DuckDB on the same tables."""

import os
from datetime import datetime

import duckdb
import pytest

from lodestrata.plans import catalogue

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents".split()


def plain(x):
    if isinstance(x, float):
        return round(x, 6)
    return x.replace(tzinfo=None).isoformat() if isinstance(x, datetime) else x


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{DIR}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DIR)
    cur = duck.execute(catalogue.SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    want = sorted((repr([plain(r[columns.index(c)]) for c in order]) for r in cur.fetchall()))
    got = sorted(repr([plain(r[c]) for c in order]) for r in df.collect())
    assert len(got) == len(want)
    assert got == want
    assert got or name == "schema_diff"
