"""The registered queries of this subpackage against their SQL or a brute force, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from readtrack.llm import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return con


def cells(rows):
    return sorted(tuple("∅" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(want.columns) == sorted(df.columns)
    order = [want.columns.index(c) for c in df.columns]
    assert cells(map(tuple, df.collect())) == cells(tuple(r[i] for i in order) for r in want.fetchall())
