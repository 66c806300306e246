"""Registered queries over all rows of their tables."""

import glob
import os

import duckdb
import pytest

from readtrack import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return con


def without(name, bound):
    """The query's SQL less a bound on its rows."""
    return registry.oracle_sql()[name].replace(bound, "")


def rows(spark, name, sf=SF):
    return [tuple(r) for r in registry.queries()[name](spark, sf).collect()]


def test_ios_exports_every_message(spark, duck):
    got = rows(spark, "chat_parse_ios")
    want = duck.sql(without("chat_parse_ios", " WHERE seq % 50 < 40")).fetchall()
    assert sorted(got) == sorted(want) and len(got) == duck.sql("select count(*) from events").fetchall()[0][0]


def spelt(alias):
    """A book as the grammar spells it: a digit stands apart, parts are joined, a trailing 2 doubles the word."""
    alias = alias.replace(" - ", "-")
    alias = f"{alias[0]} {alias[1:].strip()}" if alias[0].isdigit() else alias
    return f"{alias[:-1]}-{alias[:-1].split()[-1]}" if alias[-1] == "2" else alias


@pytest.mark.parametrize("name", ["parse_refs", "explode_refs"])
def test_every_book_is_parsed(spark, name):
    from readtrack.queries.domain import messages

    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    want = []
    for m in messages(spark, SF).collect():
        until = m["last"] if m["last"] > m["first"] else None
        book = spelt(m["alias"])
        want.append((m["seq"], book, m["first"], None, until) if name == "parse_refs" else (m["seq"], 0, book, m["first"], until))
    assert sorted(rows(spark, name), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("name", ["gap_fill", "gap_fill_window"])
def test_gaps_of_long_histories(spark, tmp_path, name):
    """One member with a third of all rows."""
    import datetime

    start = datetime.datetime(2024, 1, 1)
    events = [(i, 7 if i % 3 == 0 else i % 40 + 100, start + datetime.timedelta(minutes=i)) for i in range(3000)]
    spark.createDataFrame(events, "event_id long, user_id long, ts timestamp_ntz").write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.sql(f"create view events as select * from read_parquet('{tmp_path}/events.parquet/*.parquet')")
    got = rows(spark, name, str(tmp_path))
    assert len(got) == 3000 and sorted(got) == sorted(con.sql(without(name, " WHERE k <= 70")).fetchall())


def test_android_exports_long_conversations(spark, tmp_path):
    turns = [(1, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(250)] + [(2, 0, "user", "hello")]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = [(f, n, who, said) for f, n, _, who, said in rows(spark, "chat_parse_android", str(tmp_path))]
    assert sorted(got) == sorted((str(c), t + 1, r, x) for c, t, r, x in turns)


def test_bootstrap_takes_a_thousand_rounds(spark, monkeypatch):
    import inspect

    from readtrack.operators import evaluate

    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    asked, plain = [], evaluate.bootstrap
    bound = inspect.signature(plain).bind
    monkeypatch.setattr(evaluate, "bootstrap", lambda *a, **b: asked.append(bound(*a, **b)) or plain(*a, **b))
    low, mean, high = rows(spark, "bootstrap_ci")[0]
    asked[-1].apply_defaults()
    assert asked[-1].arguments["rounds"] == 1000 and low < mean < high
