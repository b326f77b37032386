"""Every registered query runs on the smallest driver tables and equals its SQL in DuckDB."""

import math
import os

import duckdb
import pytest

from spendline.plans import catalog

DIRECTORY = os.environ.get("SPENDLINE_TEST_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="driver tables not available")


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIRECTORY}/{t}.parquet'")
    return con


def text(v):
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(v + 0.0)
    return "NULL" if v is None else repr(v)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    q = catalog.QUERIES[name]
    df = q.run(spark, DIRECTORY)
    columns = sorted(df.columns)
    got = sorted([text(r[c]) for c in columns] for r in df.collect())
    if q.sql is None:
        assert got
        return
    cursor = duck.execute(q.oracle())
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted([text(r[names.index(c)]) for c in columns] for r in cursor.fetchall())
    assert got == want
