"""The queries that SQL can express against their SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from tideline.llm.queries import QUERIES, SQL

DATA = os.environ.get("TIDELINE_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the standard tables aren't there")


def plain(v):
    return (None if math.isnan(v) else float(f"{v:.12g}")) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = QUERIES[name](spark, DATA)
    names, want = sorted(df.columns), db.sql(SQL[name])
    assert sorted(want.columns) == names
    at = [want.columns.index(c) for c in names]
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=str)
    assert got and got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)
