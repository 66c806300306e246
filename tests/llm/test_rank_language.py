"""Ranked search against a plain scoring of every document, and language identification against plain kernels and held-out labels."""

import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from readtrack.llm import op11_rank as rank
from readtrack.llm import op13_language as lang
from readtrack.llm import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_rank(docs, items, k=10):
    counted = [(i, Counter(WORD.findall((t or "").translate(UPPER)))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for q, text in items:
        asked = Counter(WORD.findall(text.translate(UPPER)))
        found = []
        for i, c in counted:
            m = 25 + (75 * sum(c.values()) * n) // length
            s = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, r in asked.items() if t in c)
            if s > 0 and i is not None:
                found.append((-s, i))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return out


DOCS = [
    (1, "Alpha beta, gamma"), (2, "alpha ALPHA beta"), (3, None), (4, ""), (5, "... --- !!!"), (None, "alpha delta"), (6, "Ünïcode Éa ünïcode x_y"),
    (7, "alpha beta, gamma"), (7, "alpha beta, gamma"), (8, "beta " * 5000 + "gamma"), (9, "Αlpha 数 beta1 beta"), (10, "délta delta\x00beta"),
]
ITEMS = [(0, "Alpha beta gamma"), (1, "alpha alpha x y É éa"), (2, ""), (3, "nowhere"), (4, "beta BETA beta Beta"), (5, "Αlpha ünïcode"), (6, "alpha"), (None, "beta")]


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", 3) for i, t in docs], "doc_id long, text string, item_id string, rank int")
    return d.select("doc_id", "text"), spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")


@pytest.mark.parametrize("shard_docs", [1, 2, 1 << 15])
def test_rank_small(spark, shard_docs):
    d, i = frames(spark, DOCS, [*ITEMS, (6, "zz"), (7, None)])
    want = plain_rank(DOCS, [x for x in ITEMS if x[0] is not None])
    for bytes_ in (16 << 20, 8):
        assert sorted(map(tuple, rank.rank(d, i, shard_docs=shard_docs, item_bytes=bytes_).collect())) == want
    assert rank.rank(d.limit(0), i).count() == 0 and rank.rank(d, i.limit(0)).count() == 0


def test_rank_ties_and_trees(spark):
    """Many equal scores over several levels of the tree: the smallest ids win, wherever they lie."""
    rng = np.random.default_rng(1)
    words = [f"w{j}" for j in range(40)]
    docs = [(int(i), " ".join(rng.choice(words, rng.integers(1, 12)))) for i in rng.permutation(3000)]
    docs += [(5000 - i, "w1 w2 w3 w3") for i in range(1500)]
    items = [(0, "w1 w2 w3"), (1, "w3 w3 w9 w10 w11"), (2, " ".join(words)), (3, "w39")]
    d, i = frames(spark, docs, items)
    assert sorted(map(tuple, rank.rank(d, i).collect())) == plain_rank(docs, items)
    assert sorted(map(tuple, rank.rank(d.repartition(3), i, shard_postings=700).collect())) == plain_rank(docs, items)


def test_rank_opens_few_nodes():
    """With one document far ahead, its path alone is opened."""
    term = np.zeros(40_000, np.int64)
    impact = np.full(40_000, 5, np.int64)
    impact[31_234] = 1000
    tree, opened = rank.MaxTree(term, np.arange(40_000), impact), []
    below = tree.below
    tree.below = lambda level, *a: (opened.append(level), below(level, *a))[1]
    assert tree.search(np.array([0]), np.array([3]), np.arange(40_000), 1, []) == [(-3000, 31_234)]
    assert opened == [4, 3, 2, 1]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def plain_grams(text):
    s = re.sub(r"[^\w]|[\d_]", " ", text.lower())
    s = "".join(c if c.isalpha() else " " for c in s)
    s = f" {' '.join(s.split())} "
    return {s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)} - {' '} if s.strip() else set()


def test_kernel():
    """Counts by presence matrices are those of the sets of n-grams."""
    texts = ["Der schnelle Fuchs", "the quick  brown-fox 12 jumps", "數 über É", "a", "  x1y2 ", "aaaa aaaa"]
    marks = lang.Landmarks(texts[:3])
    found = [lang.grams(t) for t in texts]
    assert [len(g) for g in found] == [len(plain_grams(t)) for t in texts]
    want = [[len(plain_grams(a) & plain_grams(b)) for b in texts[:3]] for a in texts]
    assert marks.shared(found).astype(int).tolist() == want
    lang.FEATURES, before = 7, lang.FEATURES
    try:
        assert marks.shared(found).astype(int).tolist() == want
    finally:
        lang.FEATURES = before
    long = "ab cd " * 200_000
    assert len(lang.grams(long)) == len(plain_grams("ab cd ab")) and not len(lang.grams("12 _ !"))


def test_ridge():
    """The Nyström solution with every row a landmark is kernel ridge regression itself."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(12, 30))
    k, y, w = x @ x.T, np.eye(3)[rng.integers(0, 3, 12)], np.full(12, 1 / 12)
    got = lang.solve(k, (k * w[:, None]).T @ k, (k * w[:, None]).T @ y, 0.01)
    assert np.allclose(k @ got, k @ np.linalg.solve(k + 0.01 * 12 * np.eye(12), y))


def test_languages_odd(spark):
    words = {"aa": ["lorem", "ipsa", "dolor"], "bb": ["zwick", "krumm", "pflug"]}
    rng = np.random.default_rng(2)
    docs = [(i, " ".join(rng.choice(words[c], 6)), c) for i in range(60) for c in [("aa", "bb")[i % 3 == 0]]]
    odd = [(100, None, "aa"), (101, "", "bb"), (102, "12 !?", "bb"), (None, "lorem dolor", "bb"), (5, docs[5][1], "aa"), (103, "krumm " * 40_000, None), (104, "数", None)]
    d = spark.createDataFrame([(*r, "e", 1.0) for r in docs + odd], "doc_id long, text string, lang string, lang_pred string, score double")
    got = {}
    for r in lang.identify(d).collect():
        got.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert all(got[i][0][0] == c for i, _, c in docs) and len(got[5]) == 2 and got[None][0][0] == "aa" and got[103][0][0] == "bb"
    assert [got[i] for i in (100, 101, 102)] == [[("und", 0.0)]] * 3 and got[104] == [("aa", 0.0)]
    assert all(0 <= s <= 1 for x in got.values() for _, s in x)
    assert lang.identify(d.limit(0)).count() == 0
    assert {r["lang_pred"] for r in lang.identify(d.where("lang is null")).collect()} == {"und"}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query(spark):
    """Held-out accuracy over the whole table."""
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()}
    got = registry.queries()["op13_string_kernel_language"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs) and all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 for r in got)
    asked = [r for r in got if r["held_out"] and docs[r["doc_id"]]["lang"] and r["lang_pred"] != "und"]
    assert len(asked) > 30 and np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in asked]) >= 0.97
    for r in got:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in docs[r["doc_id"]]["text"] or ""))
