"""Every query with SQL gives DuckDB's rows on the small tables; every other one gives rows."""

import datetime
import glob
import math
import os

import duckdb
import pytest

from strandwise.plans import catalogue

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def shown(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(shown, v)) + "]"
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, db, name):
    df = catalogue.QUERIES[name](spark, FOLDER)
    got = sorted(tuple(map(shown, r)) for r in df.collect())
    if name not in catalogue.SQL:
        assert len(set(df.columns)) == len(df.columns)
        return
    rel = db.execute(catalogue.SQL[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(df.columns)
    at = [names.index(c) for c in df.columns]
    assert got == sorted(tuple(shown(r[i]) for i in at) for r in rel.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
