"""Cleaning, chat files, rules and the span grammar."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from readtrack.functions import patterns, text
from readtrack.operators import grammar, spans, tagging
from readtrack.sources import chat, files


def value(spark, fn, x, kind="string"):
    return spark.createDataFrame([(x,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "fn, x, want",
    [
        (text.remove_invisible, "a‎b‏c﻿d​e‌f‍g‪h‫\n\ti\r", "abcdefgh\n\ti"), (text.remove_invisible, None, ""), (text.remove_invisible, "", ""),
        (text.normalize_whitespace, "a \t  b\n  c  \n\n", "a b\nc"), (text.normalize_whitespace, "\n\n a\n\n b", "a\n\nb"), (text.normalize_whitespace, "", ""),
        (text.preprocess, "a\nb\U0001f44dc", "a b \U0001f44d c"), (text.preprocess, "  x   y ", "x y"), (text.isolate_markdown, "*Gal 3-6* ok", "* Gal 3-6 * ok"), (text.text_key, " 1  Kor ", "1 kor"),
    ],
)
def test_cleaning(spark, fn, x, want):
    assert value(spark, fn, x) == want


def test_preprocess_list(spark):
    assert value(spark, text.preprocess_list, [1, 2], "array<int>") == "1 2"


IOS = "[1/2/24 8.05.01] ~Ana: Kej 1\nmore\n\nlast\n[2/2/24 9.00.00] Budi: Kej 2 selesai\n"
ANDROID = "old line\n3/8/20, 7:15 - Ana: Ef 1: ok\n3/8/2020, 7:16 - Budi: Ef 2\n3/8/20, 7:17 - Ana left\n99/99/99, 7:18 - Ana: Ef 3"


def test_chats(spark):
    df = spark.createDataFrame([("i", IOS), ("a", ANDROID), ("e", ""), ("n", None)], "file string, content string")
    got = {(r["file"], r["msg_seq"]): (str(r["timestamp"]), r["sender"], r["message"]) for r in chat.parse_chats(df).collect()}
    assert got == {
        ("i", 1): ("2024-02-01 08:05:01", "Ana", "Kej 1\nmore\n\nlast"), ("i", 2): ("2024-02-02 09:00:00", "Budi", "Kej 2 selesai"), ("a", 1): ("2020-08-03 07:15:00", "Ana", "Ef 1: ok"),
        ("a", 2): ("None", "Budi", "Ef 2"), ("a", 3): ("2020-08-03 07:17:00", None, "Ana left"), ("a", 4): ("None", "Ana", "Ef 3"),
    }


def test_read_chats(spark, tmp_path):
    (tmp_path / "x.txt").write_bytes(b"1/2/20, 7:15 - Ana: caf\xff Ef 1")
    assert chat.parse_chats(chat.read_chats(spark, str(tmp_path))).first()["message"] == "caf Ef 1"


def test_ios_headers_without_spaces(spark):
    content = "[1/2/24 8.05.01]  ~ Ana: Kej 1\n[1/2/24 8.06.01]B: Kej 2\n[1/2/24 8.07.01] C:Kej 3\n[1/2/24  8.08.01]~D :  Kej 4"
    got = [(r["sender"], r["message"]) for r in chat.parse_chats(spark.createDataFrame([("f", content)], "file string, content string")).orderBy("msg_seq").collect()]
    assert got == [("Ana", "Kej 1"), ("B", "Kej 2"), ("C", "Kej 3"), ("D", "Kej 4")]


def test_only_bad_bytes_go(spark, tmp_path):
    for i, data in enumerate([b"\xc3\x28 \xef\xbf\xbd ok", "é \ufffd 📖".encode(), b"\xf0\x9f\x93 \xed\xa0\x80x\xc0\xaf", "\ufffd".encode() + b"\xff" + "é\n".encode()]):
        (tmp_path / f"{i}.txt").write_bytes(data)
        got = {r["file"][-5:]: r["content"] for r in chat.read_chats(spark, str(tmp_path)).collect()}
        assert got[f"{i}.txt"] == data.decode("utf-8", "ignore")


def plain_rules(texts):
    """The same shapes by Python's expressions, names as a plain list."""
    import re

    from readtrack.catalog import aliases

    names = "|".join(re.escape(n) for n in sorted({a for a, _, _ in aliases()}, key=lambda n: (-len(n), n)))
    tree, spans.any_of = spans.any_of, lambda _: f"(?:{names})"
    try:
        shapes = [re.compile(p.removeprefix(spans.FLAGS).replace(r"\x{2013}", "\u2013").replace(r"\x{2014}", "\u2014"), re.I) for p, _, _ in spans.patterns()]
    finally:
        spans.any_of = tree
    for t in texts:
        kept = []
        for p in shapes:
            for m in p.finditer(t):
                if all(m.end() <= a or b <= m.start() for a, b, _ in kept):
                    kept.append((m.start(), m.end(), m.group()))
        yield sorted(kept)


def test_rules_in_running_text(spark):
    import random

    r = random.Random(11)
    bits = ["kej", "Kejadian", "1 raja - raja", "2 raja2", "hakim2", "1Sam.", "i sam", "mat.", "yoh", "1 yoh", "kid agung", "why", "amin", "dan", "3", "12", "١٢", "1:2", "4:5", "-", " – ", "--", "\u00a0", " sampai ", " to ", ", ", "\n", "baca ", "xkej", "ſ", ".", ":", "7x", "\ue000", "\ue001", "📖"]
    texts = ["".join(r.choice(bits) + r.choice(["", " ", " "]) for _ in range(r.randint(1, 14))) for _ in range(600)]
    got, structures = rules(spark, *texts)
    assert got == list(plain_rules(texts))
    assert any(len(x) > 2 for x in got) and [x for x in structures if any(y[2] for y in x)]
    assert rules(spark, "Kej\u00a0١٢ - ١٣")[1] == [[("Kej", 12, None, 13)]]


def rules(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", spans.found(F.col("t")).alias("m"))
    rows = df.select("i", spans.as_spans(F.col("m")).alias("s"), spans.as_structures(F.col("m")).alias("r")).orderBy("i").collect()
    return [[(s["start"], s["end"], s["text"]) for s in r["s"]] for r in rows], [[tuple(x) for x in r["r"]] for r in rows]


def test_rules(spark):
    s, r = rules(spark, "Kej 1 - Kel 2:5", "baca Kej 1:1 - 2:5, lalu Mat. 3", "Gal 6 - Ef 2 ok", "Wahyu", "bukan", None, "Kej 1-3 lalu Kel 4 sampai 6", "kejx 1 kej")
    assert s[0] == [(0, 5, "Kej 1"), (8, 15, "Kel 2:5")]
    assert r[1] == [("Kej", 1, None, 2), ("Mat", 3, None, None)]
    assert r[2] == [("Gal", 6, "Ef", 2)] and r[3] == [("Wahyu", None, None, None)] and s[4] == [] and s[5] == []
    assert r[6] == [("Kej", 1, None, 3), ("Kel", 4, None, 6)]
    assert [x[2] for x in s[7]] == ["kej"]
    for found in s:
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:], strict=False))


CASES = [
    (["Kej 1"], [("kej", 1, None, None)]), (["Wahyu"], [("wahyu", None, None, None)]), (["1 Kor 13"], [("1 kor", 13, None, None)]), (["2 Raja-Raja 1"], [("2 raja-raja", 1, None, None)]),
    (["Kej 2 sampai 5"], [("kej", 2, None, 5)]), (["Gal 6 - Ef 1"], [("gal", 6, "ef", 1)]), (["Mzm - Yes"], [("mzm", None, "yes", None)]),
    (["Kej 1, 2, 3"], [("kej", c, None, None) for c in (1, 2, 3)]), (["Kej 1:1-5"], [("kej", 1, None, None)]), (["Kel 3", "4"], [("kel", 3, None, None), ("kel", 4, None, None)]),
    (["Kej 1, Kel 2"], [("kej", 1, None, None), ("kel", 2, None, None)]), ([" "], []), (["???"], []), (["1-3 Yoh"], [("1 yoh", None, "3 yoh", None)]),
    (["hakim-hakim 6 - hakim-hakim 7"], [("hakim-hakim", 6, None, 7)]), (["Kej 1:1-2:5"], [("kej", 1, None, 2)]), (["Amos, Obaja"], [("amos", None, None, None), ("obaja", None, None, None)]),
    ([], []), (None, []),
]


def test_grammar(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, s array<string>")
    got = [[tuple(x) for x in r["r"]] for r in df.select("i", grammar.parse_refs(F.col("s")).alias("r")).orderBy("i").collect()]
    assert got == [c[1] for c in CASES]


@pytest.mark.parametrize("x, want", [("raja2", ["WORD raja-raja"]), ("s/d", ["RANGE s/d"]), ("3 – 4", ["NUM 3", "RANGE –", "NUM 4"]), ("sdh", ["RANGE sd", "WORD h"]), ("", [])])
def test_tokens(spark, x, want):
    assert [f"{t['kind']} {t['value']}" for t in value(spark, grammar.tokens, x)] == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([("NUM", "1"), ("NUM", "7"), ("WORD", "kej"), ("WORD", "raja"), ("RANGE", "-"), ("COLON", ":"), ("COMMA", ","), ("SEMI", ";")]), max_size=9), max_size=3))
def test_grammar_ends(messages):
    found = grammar.parse([([k for k, _ in s], [v for _, v in s]) for s in messages])
    assert all(r[0] for r in found)


def test_patterns(spark):
    cases = {"Kej 1:1 - 2:3": "cross_chapter_verse", "Kej 1:1-5": "verse_range", "Kej 1:1": "single_verse", "Gal 6 - Ef 1": "cross_book", "Kej 1-3": "chapter_range", "Kej 1": "single_chapter", "Kej": "book_only"}
    for ref, want in cases.items():
        assert value(spark, lambda x: patterns.pattern_of(x, F.array(x)), ref) == want
    assert value(spark, lambda x: patterns.pattern_of(x, F.array(x)), "_Kej 1_") == "noisy"
    assert value(spark, lambda x: patterns.pattern_of(x, F.array(x, x)), "Kej 1") == "multi"


def test_bio(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d", "e"], ["I-X", "I-X", "O", "B-X", "B-X"]), ([], [])], "t array<string>, g array<string>")
    rows = [[(x["start"], x["end"], x["text"]) for x in (r["s"] or [])] for r in df.select(tagging.char_spans(F.col("t"), F.col("g")).alias("s")).collect()]
    assert rows == [[(0, 3, "a b"), (6, 7, "d"), (8, 9, "e")], []]


def test_conll(spark, tmp_path):
    (tmp_path / "x.conll").write_text("-DOCSTART- O\n\nKej _ _ B-BIBLE_REF\n1 _ _ I-BIBLE_REF\n\nok _ _ O\n")
    rows = files.read_conll(spark, str(tmp_path / "x.conll")).orderBy("sent").collect()
    assert [(r["text"], r["tags"]) for r in rows] == [("Kej 1", ["B-BIBLE_REF", "I-BIBLE_REF"]), ("ok", ["O"])]


def test_other_files(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"books":[{"id":1,"name":"Kejadian","aliases":["kej"],"testament":"old","chapters":50}]}')
    assert files.read_catalog(spark, str(tmp_path / "c.json")).first()["chapters"] == 50
    (tmp_path / "p.csv").write_text("day,date,book_start,start_chapter,book_end,end_chapter,emoji\n1,2024-01-01,Kejadian,1,,3,\n")
    row = files.read_plan(spark, str(tmp_path / "p.csv")).first()
    assert (row["end_chapter"], row["book_end"], str(row["date"])) == (3, None, "2024-01-01")
    (tmp_path / "m.csv").write_text('timestamp,sender,message,category\n2024-01-01 08:00:00,a,"x\ny", Report \nbad,b,z,not report\n')
    got = files.read_labelled(spark, str(tmp_path / "m.csv")).orderBy("sender").collect()
    assert [(r["message"], r["is_report"], r["timestamp"] is None) for r in got] == [("x\ny", True, False), ("z", False, True)]
    files.write_csv(spark.range(2), str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 2
