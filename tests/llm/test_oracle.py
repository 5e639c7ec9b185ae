"""The queries that SQL expresses, against their DuckDB oracle."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from pointlake.llm.queries import ORACLE, QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    return None if isinstance(v, float) and math.isnan(v) else round(v, 9) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = duck.execute(ORACLE[name])
    assert sorted(d[0] for d in res.description) == cols
    at = [[d[0] for d in res.description].index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in at) for r in res.fetchall()), key=repr)
    assert got == want


def test_registered_under_their_numbers():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
