"""Every registered query of the library against its SQL on the smallest tables; the driver's contract."""

import glob
import math
import os

import duckdb
import pytest

from readtrack import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = sorted(registry.queries())
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return con


def same(rows):
    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "∅"
        if isinstance(v, bool) or not hasattr(v, "__float__"):
            return str(v).removesuffix(" 00:00:00")
        return f"{float(v):.6g}"

    return sorted(tuple(cell(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    want = duck.sql(sql)
    order = [want.columns.index(c) for c in df.columns]
    assert sorted(want.columns) == sorted(df.columns)
    assert same(rows) == same([tuple(r[i] for i in order) for r in want.fetchall()])


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(registry.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["sender", "chapters", "books"]
