"""The pipeline's near-copy stage on planted pairs of known similarity."""

import random

import pytest

import corpus_pipeline
from readtrack.llm import op4_simhash

SCHEMA = "doc_id long, text string"


def similarity(a, b):
    a, b = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (a.split(), b.split()))
    return len(a & b) / len(a | b)


def pair(r, low, high):
    """Two texts of 100 to 400 words whose similarity is within the bounds."""
    while True:
        base = ["".join(r.choice("abcdefghij") for _ in range(r.randint(3, 9))) for _ in range(r.randint(104, 404))]
        other = list(base)
        while similarity(" ".join(base), " ".join(other)) >= high:
            other[r.randrange(len(other))] = "w%d" % r.randrange(10**9)
        if similarity(" ".join(base), " ".join(other)) >= low:
            return " ".join(base), " ".join(other)


def kept(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    return {x["doc_id"] for x in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}


def brute(texts):
    stay = []
    for i, t in enumerate(texts):
        if all(similarity(texts[k], t) < 0.8 for k in stay):
            stay.append(i)
    return set(stay)


@pytest.mark.parametrize("group", [512, 8])
def test_planted_pairs(spark, group, monkeypatch):
    monkeypatch.setattr(op4_simhash, "GROUP", group, raising=False)
    monkeypatch.setattr(op4_simhash, "LEADERS", max(3, group // 8), raising=False)
    r = random.Random(3)
    texts = [x for _ in range(60) for x in pair(r, 0.65, 0.75)] + [x for _ in range(60) for x in pair(r, 0.80, 0.85)]
    left = kept(spark, texts)
    assert left == brute(texts)
    assert set(range(120)) <= left and not {i for i in range(120, 240) if i % 2} & left


@pytest.mark.parametrize("group", [512, 8])
def test_chain(spark, group, monkeypatch):
    """Each text is near its neighbours alone: what stays is not near anything else that stays."""
    monkeypatch.setattr(op4_simhash, "GROUP", group, raising=False)
    monkeypatch.setattr(op4_simhash, "LEADERS", max(3, group // 8), raising=False)
    r = random.Random(4)
    base = ["w%d" % r.randrange(10**9) for _ in range(600)]
    texts = [" ".join(base[k : k + 200]) for k in range(0, 400, 10)]
    assert kept(spark, texts) == brute(texts)
