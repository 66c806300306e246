"""Long exports are read in parts, equal texts once, and what a report needs twice is stored."""

import datetime as dt

from pyspark.sql import functions as F

from readtrack import run
from readtrack.queries import domain, whole
from readtrack.sources import chat, store


def test_long_exports(spark, tmp_path):
    """Messages that run over the border of a part: numbered and joined as in a content that is a row."""
    lines = ["1/1/24, 0:00 - Grup dibuat"] + [f"1/1/24, 0:{i % 60:02d} - u{i % 7}: m{i}" if i % 3 else f"more {i}" for i in range(70_000)]
    (tmp_path / "a.txt").write_text("\n".join(lines))
    got = chat.parse_files(spark, str(tmp_path)).drop("file")
    want = chat.parse_chats(spark.createDataFrame([("a", "\n".join(lines))], "file string, content string")).drop("file")
    assert got.count() == want.count() > 40_000 and got.exceptAll(want).isEmpty()


def test_texts_are_read_once(spark, monkeypatch):
    """Three members say the same: one text goes to the rules, and each has its references in order."""
    seen, plain = [], run.raw_references
    monkeypatch.setattr(run, "raw_references", lambda said, *a: seen.append(said.count()) or plain(said, *a))
    rows = [("f", i, dt.datetime(2024, 1, 1, 0, i), f"u{i % 3}", "Kej 1-2, Kel 3" if i < 6 else "halo") for i in range(7)]
    chats = spark.createDataFrame([("f", "\n".join(f"1/1/24, 0:{t.minute:02d} - {who}: {m}" for _, _, t, who, m in rows))], "file string, content string")
    got = run.read(chats).select("sender", "seq", "ord", "start_id", "start_chapter", "end_id", "end_chapter").collect()
    want = [(f"u{i % 3}", i // 3 + 1, o, *r) for i in range(6) for o, r in enumerate([(1, 1, 1, 2), (2, 3, 2, 3)])]
    assert seen == [2] and sorted(map(tuple, got)) == sorted(want)


def test_a_report_reads_what_is_stored(spark, tmp_path, monkeypatch):
    start = dt.datetime(2024, 1, 1)
    events = [(i, i % 9, start + dt.timedelta(hours=2 * i), "view") for i in range(200)] + [(900, None, start, "view"), (901, 3, None, "view")]
    spark.createDataFrame(events, "event_id long, user_id long, ts timestamp_ntz, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    asked, plain = [], run.compliance.summarize
    monkeypatch.setattr(run.compliance, "summarize", lambda *a: asked.append(a) or plain(*a))
    got = whole.QUERIES["chats_to_report"](spark, str(tmp_path))
    who, done = asked[0][0], asked[0][3]
    assert got.count() == 10 and who.count() == 9 and done.count() > 9
    assert all("members-" in x for x in who.inputFiles()) and all("progress-" in x for x in done.inputFiles())
    told = whole.chats(spark, str(tmp_path)).where("sender is not null")
    assert told.count() == 200
    m = domain.messages(spark, str(tmp_path)).where("sender is not null and timestamp is not null").groupBy("sender").count().withColumnRenamed("count", "n")
    assert told.groupBy("sender").agg(F.count("*").alias("n")).exceptAll(m).isEmpty()


def test_a_batch_works_out_references_once(spark):
    rows = [("a", i, 0, dt.datetime(2024, 1, 1 + i), 1, i + 1, 1, i + 1, True, False) for i in range(5)]
    names = "sender string, seq long, ord int, timestamp timestamp_ntz, start_id int, start_chapter int, end_id int, end_chapter int, is_valid boolean, filled boolean"
    seen = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    refs = spark.createDataFrame(rows, names).mapInPandas(counted, names).withColumns({"book_start": F.lit("Kejadian"), "book_end": F.lit("Kejadian")})
    messages = spark.createDataFrame([("a", r[1], r[3], "x") for r in rows], "sender string, seq long, timestamp timestamp_ntz, message string")
    store.create_tables(spark, "once")
    assert store.store_batch("once", messages, refs) and seen.value == 5 and store.stored(spark, "once", "reading_progress").count() == 5
