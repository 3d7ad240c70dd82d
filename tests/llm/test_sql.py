"""The queries that SQL can express, against their SQL."""

import os

import duckdb
import pytest

from ferrule.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, FOLDER), db.sql(queries.ORACLE[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    plain = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    assert sorted(tuple(plain(r[c]) for c in columns) for r in got.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())
