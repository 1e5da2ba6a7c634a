"""Every query against its SQL on the smallest test tables."""

import decimal
import os
from collections import Counter

import pytest

from strandline.plans import control_queries as reference, queries as core

duckdb = pytest.importorskip("duckdb")
FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = {**reference.QUERIES, **core.TRAINING}, {**reference.SQL, **core.TRAINING_SQL}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(FOLDER):
        c.execute(f"CREATE VIEW \"{f.removesuffix('.parquet')}\" AS SELECT * FROM '{FOLDER}/{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    return tuple(v) if isinstance(v, list) else v


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    names = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in names) for r in df.collect())
    result = con.execute(SQL[name])
    order = [d[0] for d in result.description]
    assert sorted(order) == names
    want = Counter(tuple(plain(r[order.index(c)]) for c in names) for r in result.fetchall())
    assert got == want


def test_every_sql_has_a_query():
    assert SQL.keys() <= QUERIES.keys()
