"""Every query with an oracle, on the smallest tables, against DuckDB."""

import os

import duckdb
import pytest

from tallyweb.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_oracle(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = db.sql(catalog.ORACLES[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)
