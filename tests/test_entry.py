"""Every registered query agrees with its SQL on the smallest given tables."""

import os

import pytest

import __spark_entry__ as entry_module
from tagloom import workload

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not present")
BUILT, ORACLES = dict(workload.QUERIES), dict(workload.SQL)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def canonical(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    rows = [
        tuple("NULL" if x is None else repr(x + 0.0) if isinstance(x, float) else str(x) for x in row)
        for row in zip(*columns)
    ]
    return names, sorted(rows)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 5 * 24


def test_every_query_has_sql():
    assert set(ORACLES) == set(BUILT)
    assert BUILT.items() <= entry_module.queries().items()
    assert ORACLES.items() <= entry_module.oracle_sql().items()


@pytest.mark.parametrize("name", list(BUILT))
def test_query(spark, duck, name):
    got = canonical(BUILT[name](spark, SF).toArrow())
    expected = canonical(duck.sql(ORACLES[name]).to_arrow_table())
    assert got == expected
    assert got[1]
