"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from pointlake.plans.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 9) if not math.isnan(v) else "nan"
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr), \
        [cols[i] for i in order]


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got, gcols = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(ORACLE[name])
    want, wcols = _rows([d[0] for d in res.description], res.fetchall())
    assert gcols == wcols
    assert got == want


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
          "array<double>": "DOUBLE[]"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_types_match_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
           for f in df.schema.fields}
    want = {r[0]: r[1] for r in duck.execute(f"DESCRIBE ({ORACLE[name]})").fetchall()}
    assert got == want


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry(spark):
    rows = E.entry(spark).collect()
    assert 0 < len(rows) <= 10
