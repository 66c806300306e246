"""The co-bucketed pair against a plain rewriting in Python."""

import hashlib
import math
import os
import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from readtrack.llm import op12_cobucket as op
from readtrack.llm import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def key(row):
    def cell(v):
        if v is None:
            return (0,)
        if isinstance(v, str):
            return 1, v.encode()
        return (2, 0) if isinstance(v, float) and math.isnan(v) else (1, v)

    return [cell(v) for v in row]


def sha(parts):
    return hashlib.sha256(",".join(parts).encode()).hexdigest()


def plain(sales, lines, sale_at, sale_key, line_start):
    """(table, bucket) -> (rows in order, lineage, rewritten, joined), from lists of rows whose key is their first cell."""
    b = lambda i: 301 if i is None else zlib.crc32(f"line{i}".encode()) % 300
    times = Counter(r[sale_key] for r in sales)
    out = {}
    for name, rows, bucket, start in (
        ("sales", sales, lambda r: b(r[sale_key]), lambda r: b(r[sale_key]) - (b(r[sale_key]) % 3 == 1)),
        ("sale_lines", lines, lambda r: 301 if r[sale_key] is None else b(r[sale_key]) if times[r[sale_key]] else 300, line_start),
    ):
        final, first = defaultdict(list), Counter()
        for r in rows:
            final[bucket(r)].append(r)
            first[start(r)] += 1
        for k, found in final.items():
            found.sort(key=key)
            lineage = Counter(start(r) for r in found)
            stays = len(lineage) == 1 and first[next(iter(lineage))] == len(found)
            joined = sum(times[r[sale_key]] for r in lines if b(r[sale_key]) == k and r[sale_key] is not None) if k < 300 else 0
            out[name, k] = (found, sha(f"{s}:{lineage[s]}" for s in sorted(lineage)), not stays, joined)
    return out


def check(got, want, root=None):
    assert sorted((r["table_name"], r["bucket"]) for r in got) == sorted(want)
    for r in got:
        rows, lineage, rewritten, joined = want[r["table_name"], r["bucket"]]
        there = pq.ParquetFile(r["path"]).read()
        assert ",".join(there.column_names) == r["columns"]
        read = list(zip(*(there.column(i).to_pylist() for i in range(there.num_columns)), strict=True))
        assert [key(x) for x in read] == [key(x) for x in rows]
        assert (r["n_rows"], r["n_joined"], r["rewritten"], r["lineage_sha256"]) == (len(rows), joined, rewritten, lineage)
        assert r["ids_sha256"] == sha("" if x[0] is None else str(x[0]) for x in rows)
    folders = {os.path.dirname(os.path.dirname(r["path"])) for r in got}
    assert len(folders) <= 1
    for folder in folders:
        assert {os.path.join(d, f) for d, _, fs in os.walk(folder) for f in fs if not f.startswith(".")} == {r["path"] for r in got}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query(spark):
    got = registry.queries()["op12_cobucket_pair"](spark, SF).collect()
    sales, lines = ([tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").collect()] for t in ("sales", "sale_lines"))
    start = lambda r: 0 if r[2] is None else zlib.crc32(str(r[2]).encode()) % 300
    check(got, plain(sales, lines, None, 0, start))
    assert {r["path"] for r in got}.isdisjoint(r["path"] for r in registry.queries()["op12_cobucket_pair"](spark, SF).collect())


def made(spark, n_sales, n_lines, hot):
    sales = [(i, f"s{i % 7}" if i % 5 else None, float(i % 3) if i % 11 else float("nan"), i % 2 == 0 if i % 3 else None) for i in range(n_sales)]
    sales += [sales[3], sales[3], (None, "x", 1.0, True), (-4, "ä", None, None), (-4, "z", None, None)]
    lines = [((i * 7) % (n_sales + 40) if i % 3 else hot, i % 9 if i % 10 else None, ["b", "é", "Z", None][i % 4], float(i % 5)) for i in range(n_lines)]
    lines += [(None, 1, "q", None)] * 3 + [(-4, 2, "q", float("nan"))] + lines[:50]
    s = spark.createDataFrame(sales, "sale_id long, bucket string, c0 double, start boolean")
    r = spark.createDataFrame(lines, "sale_id long, item int, S string, path double")
    return sales, lines, s, r


@pytest.mark.parametrize("run_bytes", [1, 2000, 1 << 25])
def test_odd_rows_and_many_runs(spark, run_bytes, monkeypatch):
    """A hot key, repeated rows, nulls, NaN, clashing names; runs of one batch are merged in several passes."""
    monkeypatch.setattr(op, "CHUNK_BYTES", 64)
    sales, lines, s, r = made(spark, 60, 900, 5)
    b = op.hashed_bucket(F.col("sale_id"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 40)
    try:
        found = op.co_bucket(
            spark, s.repartition(3), r.repartition(5), "sale_id", F.when(b % 3 == 1, b - 1).otherwise(b), F.coalesce(F.crc32(F.col("item").cast("string").cast("binary")) % 300, F.lit(0)),
            ("sales", "sale_lines"), run_bytes=run_bytes, fan_in=3 if run_bytes == 1 else 48,
        ).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    start = lambda r: 0 if r[1] is None else zlib.crc32(str(r[1]).encode()) % 300
    check(found, plain(sales, lines, None, 0, start))


def test_stays(spark):
    """A line table with one item for each bucket: orphans and rows without a key stay where they are, whatever the number."""
    _, _, s, _ = made(spark, 9, 1, 0)
    lines = [(9000, 3, "a", 1.0), (None, 5, "b", 1.0), (9001, 3, "a", 2.0), (None, 5, "b", 0.0)]
    r = spark.createDataFrame(lines, "sale_id long, item int, S string, path double")
    b = op.hashed_bucket(F.col("sale_id"))
    found = op.co_bucket(spark, s.where("sale_id > 2"), r, "sale_id", F.lit(0), F.col("item"), ("sales", "sale_lines")).collect()
    assert sorted((x["bucket"], x["rewritten"], x["n_rows"]) for x in found if x["table_name"] == "sale_lines") == [(300, False, 2), (301, False, 2)]
    assert len(found) > 2 and b is not None


def test_empty(spark):
    _, _, s, r = made(spark, 9, 3, 0)
    zero = F.lit(0)
    assert op.co_bucket(spark, s.limit(0), r.limit(0), "sale_id", zero, zero).collect() == []
    found = op.co_bucket(spark, s.limit(0), r.where("sale_id is not null"), "sale_id", zero, zero).collect()
    assert [(x["bucket"], x["rewritten"], x["n_joined"]) for x in found] == [(300, False, 0)]
    with pytest.raises(ValueError):
        op.co_bucket(spark, s.withColumn("a", F.array("c0")), r, "sale_id", zero, zero)
