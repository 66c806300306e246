"""Resolver, normaliser, expansion, gaps, plan and compliance."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from readtrack import catalog
from readtrack.operators import compliance, progress, resolve
from readtrack.plans import reading_plan

RAW = "k int, book_start string, start_chapter int, book_end string, end_chapter int"


def test_catalogue():
    assert len(catalog.books()) == 66 and sum(b[2] for b in catalog.books()) == 1189
    names = [a for a, _, _ in catalog.aliases()]
    assert len(names) == len(set(names)) == 214


@pytest.mark.parametrize("a, b, score", [("kej", "kejadian", 100.0), ("abc", "xyz", 0.0), ("kejadain", "kejadian", None), ("", "x", 0.0), ("abcd", "bcda", None)])
def test_partial_ratio(a, b, score):
    got = resolve.partial_ratio(a, b)
    assert got == resolve.partial_ratio(b, a)
    assert got == score if score is not None else 80 <= got < 100


def test_resolver(spark):
    rows = [(1, "Kejadian"), (2, "KEJ"), (3, "Kejadain"), (4, "zzqq"), (5, ""), (6, None), (7, "1  Kor")]
    got = {r["k"]: (r["b_id"], r["b_method"]) for r in resolve.resolve(spark.createDataFrame(rows, "k int, t string"), "t", "b").collect()}
    assert got == {1: (1, "exact"), 2: (1, "exact"), 3: (1, "fuzzy"), 4: (None, "failed"), 5: (None, None), 6: (None, None), 7: (46, "exact")}
    off = resolve.resolve(spark.createDataFrame(rows, "k int, t string"), "t", "b", fuzzy=False)
    assert off.where("k = 3").first()["b_method"] == "failed"


def test_normalise(spark):
    rows = [
        (1, "kej", None, None, None), (2, "kej", None, "kel", None), (3, "kej", 3, None, None), (4, "kej", 48, "kel", None), (5, "kej", 99, None, None), (6, "zzqq", 1, None, None),
        (7, "kej", 1, "zzqq", 2), (8, "wahyu", 3, None, 2), (9, "mat", 1, "kej", 5), (10, "kej", 0, None, None), (11, "kej", 2, "kej", 4),
    ]
    got = {r["k"]: (r["book_start"], r["start_chapter"], r["book_end"], r["end_chapter"], r["is_valid"]) for r in resolve.normalize(spark.createDataFrame(rows, RAW), fuzzy=False).collect()}
    assert got == {
        1: ("Kejadian", 1, "Kejadian", 50, True), 2: ("Kejadian", 1, "Keluaran", 40, True), 3: ("Kejadian", 3, "Kejadian", 3, True), 4: ("Kejadian", 48, "Keluaran", 40, True),
        5: ("Kejadian", 99, "Kejadian", 99, False), 8: ("Wahyu", 3, "Wahyu", 2, False), 9: ("Matius", 1, "Kejadian", 5, True), 10: ("Kejadian", 0, "Kejadian", 0, False), 11: ("Kejadian", 2, "Kejadian", 4, True),
    }


def test_expand(spark):
    rows = [(1, 1, 49, 2, 2), (2, 65, 1, 3, 1), (3, 1, 5, 1, 3)]
    df = progress.expand(spark.createDataFrame(rows, "k int, start_id int, start_chapter int, end_id int, end_chapter int"))
    got = {k: [(r["book_id"], r["chapter"]) for r in df.where(F.col("k") == k).orderBy("pos").collect()] for k in (1, 2, 3)}
    assert got[1] == [(1, 49), (1, 50), (2, 1), (2, 2)]
    assert got[2] == [(65, 1), *((66, c) for c in range(1, 23))]  # an end book that comes first is never met
    assert got[3] == []


REFS = "sender string, seq long, ord int, timestamp timestamp_ntz, start_id int, start_chapter int, end_id int, end_chapter int, is_valid boolean"


def ref(seq, ord_, chapter, end=None, book=1, sender="a", day=1, ok=True):
    return (sender, seq, ord_, dt.datetime(2024, 1, day, 8), book, chapter, book, end or chapter, ok)


def test_gaps(spark):
    rows = [ref(1, 0, 3), ref(2, 0, 6), ref(3, 0, 9), ref(3, 1, 12), ref(4, 0, 2, book=2), ref(5, 0, 20, 21), ref(6, 0, 8, sender="b"), (None, *ref(7, 0, 1)[1:]), ref(8, 0, 60, ok=False)]
    got = {(r["sender"], r["seq"], r["ord"]): (r["start_chapter"], r["end_chapter"], r["filled"]) for r in progress.persist(spark.createDataFrame(rows, REFS)).collect()}
    assert got == {
        ("a", 1, 0): (3, 3, False), ("a", 2, 0): (4, 6, True), ("a", 3, 0): (7, 9, True), ("a", 3, 1): (10, 12, True), ("a", 4, 0): (2, 2, False), ("a", 5, 0): (20, 21, False),
        ("b", 6, 0): (8, 8, False), ("a", 8, 0): (60, 60, False),
    }


def test_first_read_wins(spark):
    rows = [ref(1, 0, 1, 3), ref(2, 0, 3, 4, day=2), ref(2, 1, 4, day=2)]
    p = progress.progress_of(spark.createDataFrame(rows, REFS))
    assert sorted((r["chapter"], r["date_read"].day) for r in p.collect()) == [(1, 1), (2, 1), (3, 1), (4, 2)]
    again = progress.progress_of(spark.createDataFrame(rows, REFS), p.where("chapter <= 2"))
    assert sorted(r["chapter"] for r in again.collect()) == [3, 4]
    last = progress.last_read(p.select("sender", "date_read", "book_id", "chapter"), F.lit("2024-01-01").cast("date")).first()
    assert (last["book_id"], last["chapter"]) == (1, 3)


def test_plan_and_compliance(spark):
    day = dt.date(2024, 1, 1)
    rows = [(1, day, "Kejadian", 50, "Keluaran", None, None, 0), (2, dt.date(2024, 1, 2), "Rut", 1, None, 2, " x ", 1), (2, dt.date(2024, 1, 2), "Rut", 2, "", None, "y", 2)]
    plan = spark.createDataFrame(rows, "day int, date date, book_start string, start_chapter int, book_end string, end_chapter int, emoji string, row_no long")
    c = reading_plan.expand_plan(plan)
    assert c.where("day = 1").count() == 41 and c.where("day = 2").count() == 3
    assert {r["date"].day: r["header"] for r in reading_plan.headers(c).collect()} == {1: "Kej 50 - Kel 40", 2: "Rut 1 - 2"}
    assert {r["date"].day: r["emoji"] for r in reading_plan.plan_emoji(plan).collect()} == {1: reading_plan.EMOJI, 2: "x"}
    read = [("b", 8, "Rut", 1, dt.date(2024, 1, 2)), ("b", 8, "Rut", 2, dt.date(2024, 1, 2)), ("a", 8, "Rut", 1, dt.date(2024, 1, 2))]
    p = spark.createDataFrame(read, "sender string, book_id int, book_name string, chapter int, date_read date")
    got = {r["sender"]: (r["assigned"], r["completed"], r["completion_rate"], r["is_complete"]) for r in compliance.check_all(c, p, "2024-01-02").collect()}
    assert got == {"a": (3, 1, 0.333, False), "b": (3, 3, 1.0, True)}
    nobody = compliance.check_member(c, p, "zoe", "2024-01-05").first()
    assert (nobody["assigned"], nobody["completion_rate"], nobody["is_complete"]) == (0, 1.0, True)
    who = spark.createDataFrame([("b",), ("a",), ("c",)], "name string")
    lines = [r["line"] for r in compliance.summarize(who, c, reading_plan.plan_emoji(plan), p, "2024-01-02").orderBy("line_no").collect()]
    assert lines == ["Rut 1 - 2", "1. a Rut 1", "2. b x", "3. c "]


def test_upserts(spark):
    t = [dt.datetime(2024, 1, 1, 8, m) for m in range(3)]
    m = spark.createDataFrame([(0, "a", t[0], "x"), (1, "a", t[0], "y"), (2, "b", t[1], "z"), (3, None, t[2], "w")], "seq long, sender string, timestamp timestamp_ntz, message string")
    assert sorted(r["message"] for r in progress.new_messages(m).collect()) == ["x", "z"]
    assert [r["message"] for r in progress.new_messages(m, m.where("seq = 2")).collect()] == ["x"]
    assert sorted(r["seq"] for r in progress.pending(m.where("sender is not null"), m.where("seq = 0")).collect()) == [2]
    assert [r["name"] for r in progress.new_members(m, spark.createDataFrame([("a",)], "name string")).collect()] == ["b"]
    assert progress.rejected(m).count() == 1
