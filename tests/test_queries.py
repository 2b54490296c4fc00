"""Every registered query against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tallyloom.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    want = duck.execute(registry.ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, want.fetchall())


@pytest.mark.parametrize("name", ["sort_attr", "sort_mixed"])
def test_sorted_queries_keep_their_order(spark, duck, name):
    """Row by row, on the columns sorted by; ties may stand in any order."""
    df = registry.QUERIES[name](spark, SF)
    want = duck.execute(registry.ORACLE[name])
    columns = [d[0] for d in want.description]
    got, rows_want = [[plain(r[c]) for c in columns] for r in df.collect()], [[plain(v) for v in r] for r in want.fetchall()]
    assert sorted(got) == sorted(rows_want)
    assert got == rows_want or [r[-1] for r in got] == [r[-1] for r in rows_want] or [r[0] for r in got] == [r[0] for r in rows_want]


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_model_query_gives_rows(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
