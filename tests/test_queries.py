"""Every registered query of the raster catalogue against its SQL, at the smallest scale."""

import os

import duckdb
import pytest

import terrawarp.plans.block_queries  # noqa: F401  registers its queries
from terrawarp.plans.catalogue import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    fix = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted(([fix(r[i]) for i in order] for r in data), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert got
        return
    want = duck.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, got) == rows(columns, want.fetchall())


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).limit(1).count() == 1
