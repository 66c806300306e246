"""Functions by name, the CoNLL source and the stream, against the operators they stand for."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from readtrack.functions import sql, text
from readtrack.operators import grammar, progress
from readtrack.queries import learning, named, reading
from readtrack.sources import conll
from readtrack.streaming import ingest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_scalar_functions(spark):
    """Each SQL function says what the column function says."""
    sql.register(spark)
    odd = ["", None, "  a \t b \n\n", "​ x  y \n z \r\n", "\n\nKej  3-5, Raja2 s / d 7–8;1 Yoh", "A B", "kej-kej 2:3 sampai mat2 9"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "i int, x string")
    spelt = F.transform(grammar.tokens(F.col("x")), lambda t: F.concat(t["kind"], F.lit(" "), F.regexp_replace(t["value"], r"\s", "")))
    pairs = {"remove_invisible": text.remove_invisible, "normalize_whitespace": text.normalize_whitespace, "clean_text": text.clean_text, "text_key": text.text_key, "line_count": text.line_count, "span_tokens": lambda c: spelt}
    assert set(pairs) == set(sql.SCALAR)
    for name, fn in pairs.items():
        got = df.select("i", F.expr(f"{name}(x)").alias("a"), fn(F.col("x")).alias("b")).collect()
        assert [r["a"] for r in got] == [r["b"] for r in got], name


def test_table_functions(spark):
    sql.register(spark)
    spark.createDataFrame([(1, "kej 3-5; 7"), (2, None), (3, "nothing"), (4, "yoh 1 - mat 2"), (5, "kej 99999999999")], "i int, x string").createOrReplaceTempView("said")
    got = spark.sql("SELECT i, r.* FROM (SELECT i, span_tokens(x) AS t FROM said) s, LATERAL read_refs(s.t) r").collect()
    want = spark.table("said").select("i", F.posexplode(grammar.parse_refs(F.array("x"))).alias("ord", "r")).select("i", "ord", "r.*").collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) > 3
    rows = [("a", i, 0, f"2024-01-0{i + 1} 08:00:00", 1, c, 1, c, True) for i, c in enumerate([1, 2, 5, 9])] + [("b", 1, 0, "2024-01-02 08:00:00", 1, 7, 1, 7, True), ("b", 2, 0, None, 1, 9, 1, 9, True)]
    refs = spark.createDataFrame(rows, "sender string, seq long, ord int, t string, start_id int, start_chapter int, end_id int, end_chapter int, is_valid boolean").withColumn("timestamp", F.col("t").cast("timestamp_ntz")).drop("t")
    refs.createOrReplaceTempView("refs_of_members")
    got = spark.sql("SELECT * FROM fill_gaps(TABLE(refs_of_members) PARTITION BY sender ORDER BY (seq, ord))")
    assert sorted(map(str, got.collect())) == sorted(map(str, progress.persist(refs).select(got.columns).collect()))


@pytest.mark.parametrize("size", [1, 7, 50, 1 << 20])
def test_conll_ranges(spark, tmp_path, size):
    """Whatever the cuts, every sentence is read once: blank lines in a row, a file without a last line end, doc starts, broken bytes, empty files."""
    texts = {"a": "-DOCSTART- O\n\nkej X Y B\n3 I\n\n\n \nok O\n", "b": "\n\n\nlast O\nword B", "c": "", "d": "one O\n", "e": "".join(f"w{i} T{i % 3}\n" + "\n" * (i % 4 == 0) for i in range(60))}
    for name, body in texts.items():
        (tmp_path / f"{name}.conll").write_bytes(body.encode() + (b"\xff\xfe" if name == "d" else b""))
    conll.register(spark)
    want = []
    for name, body in texts.items():
        found = []
        for line in [*body.split("\n"), ""]:
            w = line.split()
            if not w and found:
                want.append((name, [x[0] for x in found], [x[-1] for x in found]))
                found = []
            elif w and w[0] != "-DOCSTART-":
                found.append(w)
    got = spark.read.format("conll").option("range", size).load(str(tmp_path)).select(F.regexp_extract("file", r"(\w)\.conll$", 1), "tokens", "tags").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_conll_round_trip(spark, tmp_path):
    conll.register(spark)
    rows = [(["kej", "é日"], ["B", "I"]), (["ok"], ["O"]), ([], []), (None, None)] * 5
    df = spark.createDataFrame(rows, "tokens array<string>, tags array<string>").repartition(3)
    df.write.format("conll").mode("append").save(str(tmp_path / "out"))
    df.limit(0).write.format("conll").mode("append").save(str(tmp_path / "out"))
    got = spark.read.format("conll").load(str(tmp_path / "out")).select("tokens", "tags").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [r for r in rows if r[0]]))
    assert all(x.startswith("part-") for x in os.listdir(tmp_path / "out") if not x.startswith("."))
    with pytest.raises(Exception, match="not|Not"):
        spark.read.format("conll").load(str(tmp_path / "none")).collect()


@needs
def test_queries(spark):
    """The files hold every message's sentence; the stream in three runs fills gaps as the whole table in one go."""
    want = learning.ambiguous(spark, SF).groupBy(F.array_join("tokens", " "), F.array_join("gold", " ")).count().collect()
    assert sorted(map(tuple, named.conll_files(spark, SF).collect())) == sorted(map(tuple, want))
    got = named.stream_fill_gaps(spark, SF)
    r = reading.refs(spark, SF).withColumn("seq", F.unix_micros(F.col("timestamp").cast("timestamp")))
    once = r.dropDuplicates(["sender", "timestamp"])
    assert once.count() == r.count()
    assert sorted(map(str, got.collect())) == sorted(map(str, progress.persist(once).select(got.columns).collect()))


def test_stream_of_any_session(spark, tmp_path):
    """The number of partitions is no setting of the session's; events without a time or a member, and references without a chapter, end no stream."""
    start = dt.datetime(2024, 1, 1)
    events = [(i, i % 7, start + dt.timedelta(hours=5 * i), "view") for i in range(120)] + [(500, 3, None, "view"), (501, None, start, "view"), (502, 2, start + dt.timedelta(hours=10), "view")]
    spark.createDataFrame(events, "event_id long, user_id long, ts timestamp_ntz, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.unset("spark.sql.shuffle.partitions")
    try:
        got = named.stream_fill_gaps(spark, str(tmp_path))
        assert spark.conf.get("spark.sql.shuffle.partitions", None) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    r = reading.refs(spark, str(tmp_path)).where("seq < 500").withColumn("seq", F.unix_micros(F.col("timestamp").cast("timestamp")))
    assert sorted(map(str, got.collect())) == sorted(map(str, progress.persist(r).select(got.columns).collect()))
    rows = [("a", i, 0, start, 1, c, 1, c, True) for i, c in enumerate([3, None, 6])] + [(None, 3, 0, start, 1, 8, 1, 8, True), ("b", 4, 0, None, 1, 9, 1, 9, True)]
    schema = "sender string, seq long, ord int, timestamp timestamp_ntz, start_id int, start_chapter int, end_id int, end_chapter int, is_valid boolean"
    refs = spark.createDataFrame(rows, schema)
    refs.write.parquet(str(tmp_path / "refs"))
    out = ingest.stream_persist(spark.readStream.schema(schema).parquet(str(tmp_path / "refs")), buckets=2)
    out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(str, progress.persist(refs).collect()))


@needs
def test_files_and_tables(spark):
    """What is written and read back is what was there; tables filled in two batches hold each chapter's first read."""
    plan = reading.reading_plan.expand_plan(reading.plan(spark, SF)).select("date", "day", "book_id", "book_name", "chapter").collect()
    assert sorted(map(str, named.plan_file(spark, SF).collect())) == sorted(map(str, plan))
    m = reading.messages(spark, SF)
    by_day = {}
    for r in m.select(F.to_date("timestamp").alias("d"), "seq", "message").collect():
        n = by_day.setdefault(r["d"], [0, 0, 0])
        for i, x in enumerate((1, int(r["seq"] % 4 != 1), len(f'"{r["message"]}",\n{r["seq"]}'))):
            n[i] += x
    assert {r["day"]: [r["n"], r["reports"], r["chars"]] for r in named.labelled_files(spark, SF).collect()} == by_day
    want = {(r["seq"], f"b{r['book_id'] % 5}") for r in m.select("seq", "book_id").collect() if r["book_id"] % 5 in (1, 3)}
    assert {tuple(r) for r in named.pool_files(spark, SF).collect()} == want
    whole = progress.progress_of(progress.persist(reading.refs(spark, SF))).select("sender", "book_id", "chapter", "date_read").collect()
    assert sorted(map(tuple, named.stored_batches(spark, SF).collect())) == sorted(map(tuple, whole))
