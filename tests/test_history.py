"""As-of joins and chat files read in byte ranges, against plain versions."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from readtrack.operators.asof import asof_join
from readtrack.queries import history
from readtrack.sources import chat

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("slices", [1, 5, 32])
def test_asof(spark, slices):
    """A hot key, ties, null keys and times, repeated rows and probes, keys without rows."""
    r = random.Random(slices)
    at = lambda n: dt.datetime(2024, 3, 31, 1) + dt.timedelta(minutes=n)
    left = [(r.choice(["hot"] * 5 + ["a", "b", None, "none"]), at(r.randrange(300)) if r.random() < 0.95 else None, i % 7) for i in range(400)] + [("hot", at(50), 1)] * 2
    right = [(r.choice(["hot"] * 5 + ["a", "b", None]), at(r.randrange(300)) if r.random() < 0.95 else None, r.choice([None, 1, 2]), r.choice(["x", "y", None])) for _ in range(200)]
    right += right[:20]
    lf, rf = spark.createDataFrame(left, "k string, t timestamp_ntz, v int"), spark.createDataFrame(right, "k string, t timestamp_ntz, seq int, state string")
    got = asof_join(lf, rf, ["k"], "t", "t", ["seq", "state"], ["seq"], slices)
    key = lambda v: (v is not None, v or 0) if not isinstance(v, str) else (True, v)
    want = []
    for k, t, v in left:
        near = [x for x in right if x[0] == k and x[1] is not None and t is not None and x[1] <= t] if k is not None else []
        best = max(near, key=lambda x: (x[1], key(x[2]), key(x[3]) if x[3] else (False, ""))) if near else (None,) * 4
        want.append((k, t, v, best[2], best[3]))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_asof_empty_and_clash(spark):
    lf, rf = spark.createDataFrame([("a", 1)], "k string, t int"), spark.createDataFrame([("a", 1, 5)], "k string, t int, x int")
    assert [tuple(r) for r in asof_join(lf, rf.limit(0), ["k"], "t", "t", ["x"]).collect()] == [("a", 1, None)]
    assert asof_join(lf.limit(0), rf, ["k"], "t", "t", ["x"]).count() == 0
    with pytest.raises(ValueError):
        asof_join(lf, rf, ["k"], "t", "t", ["T"])


def test_asof_makes_no_pairs(spark):
    """A key with n rows and n probes: every plan node has about 2 n rows, none n * n; the hot key is in many groups."""
    n = 3000
    lf, rf = spark.range(n).selectExpr("'hot' as k", "id as t"), spark.range(n).selectExpr("'hot' as k", "id as t", "id as x")
    got = asof_join(lf, rf, ["k"], "t", "t", ["x"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "slice" in plan and "Cross" not in plan
    assert got.where("t = x").count() == n


IOS = "﻿\n\n[1/2/24 9.00.01] ~Ann: kej 1\nsecond\n\n third ‎\n[1/2/24 9.00.02] Bob Lee: é 日   x: y\r\n[2/2/24 10.1.1] no header\n[3/2/24 10.11.12] Ann: last\n\n  \n\n"
ANDROID = "1/2/24, 9:00 - group made\nlead\n1/2/2024, 9:01 - Ann: a: b\n\n\ncont\n12/2/24, 19:30 - Bob: ​z\n[1/2/24 9.00.01] Ann: not here"


@pytest.mark.parametrize("most", ["16", "40", "1000", "128m"])
def test_ranges_equal_whole_files(spark, tmp_path, most):
    """Files cut at every few bytes: within headers, continuation lines and characters; broken bytes and empty files among them."""
    r = random.Random(7)
    long = "".join(f"[{i % 28 + 1}/3/24 8.{i % 60:02}.00] M{i % 9}: text {i}\n" + "".join(f"more {j} é\n" for j in range(r.randrange(4))) for i in range(200))
    texts = {"a.txt": IOS.encode(), "b.txt": ANDROID.encode(), "c.txt": b"", "d.txt": b"no header at all\n", "e.txt": long.encode(), "f.txt": b"[1/2/24 9.00.01] A: \xe2\n\xff ok\xc3"}
    for name, body in texts.items():
        (tmp_path / name).write_bytes(body)
    want = chat.parse_chats(chat.read_chats(spark, str(tmp_path)))
    name = F.substring_index("file", "/", -1)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", most)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = chat.parse_files(spark, str(tmp_path)).withColumn("file", name).collect()
        tasks = spark.read.text(str(tmp_path), lineSep="\n").rdd.getNumPartitions()
    finally:
        for k, v in zip(("maxPartitionBytes", "openCostInBytes"), before, strict=True):
            spark.conf.set(f"spark.sql.files.{k}", v)
    assert tasks > 100 or most not in ("16", "40")
    assert sorted(map(str, got)) == sorted(map(str, want.withColumn("file", name).collect()))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_chat_files(spark):
    want = [tuple(r) for r in history.exported(spark, SF).select("timestamp", "sender", "message").collect()]
    assert sorted(tuple(r) for r in history.chat_files(spark, SF).collect()) == sorted(want)
