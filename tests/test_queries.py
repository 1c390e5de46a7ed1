"""Every registered query of the library against its SQL on the smallest tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

from tideline.plans.registry import QUERIES, SQL, flagship

DATA = os.environ.get("TIDELINE_TEST_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the standard tables aren't there")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    return v.date() if isinstance(v, dt.datetime) and v.time() == dt.time(0) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=str)
    if name in SQL:
        want = db.sql(SQL[name])
        at = [want.columns.index(c) for c in names]
        assert len(want.columns) == len(names)
        assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)
    else:
        assert got


def test_flagship(spark):
    assert flagship(spark, DATA).count() > 0
