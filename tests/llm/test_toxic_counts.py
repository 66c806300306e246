"""Documents that share their least feature hash count one by one."""

import math
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from readtrack.llm import op5_toxic

BIG = os.environ.get("TEST_BIG_DIR", "/root/testdata/sf0.1")


def test_common_least_hash(spark):
    least = min(("word%d" % i for i in range(20000)), key=lambda w: zlib.crc32(f"={w}".encode()))
    names = ["".join(chr(97 + i // 26**k % 26) for k in range(3)) for i in range(400)]
    rows, labels = [], []
    for i, n in enumerate(names):
        rows.append((i, f"{least} {n}pqrs {n}tuvw" + (" vilename" if i % 4 == 0 else "")))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame([*rows, *rows[:50]], "doc_id long, text string")
    model = op5_toxic.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert "=vilename" in model.weights
    assert model.score("some vilename here") > model.score("some other here")


def packed(docs):
    return np.repeat(np.arange(len(docs)), [len(d) for d in docs]), np.array([f for d in docs for f in d], np.int64)


def test_risk_against_plain_sums():
    """The trained weights' non-negative risk, computed document by document, is below that of any other weights tried."""
    r = random.Random(2)
    text = lambda toxic: sorted({*(3 + r.randrange(40) for _ in range(5)), *(r.sample(range(3), 2) if toxic else [])})
    pos = [text(True) for _ in range(120)]
    unl = [text(r.random() < 0.2) for _ in range(400)]
    size = 43
    both, p, u = packed(pos + unl), np.array([1.0] * 120 + [0.0] * 400), np.array([0.0] * 120 + [1.0] * 400)
    theta = op5_toxic.train(lambda t: op5_toxic.sums(t, *both, p, u), size, 120, 400, 0.2, decay=0.0)

    def risk(weights):
        g = lambda doc: weights[-1] + sum(weights[f] for f in doc)
        loss = lambda z: math.log1p(math.exp(-z)) if z > -30 else -z
        plus = sum(loss(g(d)) for d in pos) / len(pos)
        negative = sum(loss(-g(d)) for d in unl) / len(unl) - 0.2 * sum(loss(-g(d)) for d in pos) / len(pos)
        return 0.2 * plus + max(0.0, negative)

    least = risk(theta)
    rng = np.random.default_rng(4)
    assert least < risk(np.zeros(len(theta))) / 2
    assert all(least <= risk(theta + rng.normal(0, size, len(theta))) + 0.01 for size in (0.3, 1.0, 3.0) for _ in range(20))


def test_sums_count_equal_sets_together():
    """Counted sets give the sums of the documents one by one, and the gradients are those of the losses."""
    rng = np.random.default_rng(0)
    docs = [sorted(rng.choice(4, rng.integers(0, 4), replace=False).tolist()) for _ in range(50)]
    p = rng.integers(0, 2, 50).astype(float)
    distinct = sorted({tuple(d) for d in docs})
    folded = [sum(p[i] for i, d in enumerate(docs) if tuple(d) == s) for s in distinct], [float(sum(tuple(d) == s for d in docs)) for s in distinct]
    theta = rng.normal(size=5)
    one = op5_toxic.sums(theta, *packed(docs), p, np.ones(50))
    assert np.allclose(one, op5_toxic.sums(theta, *packed(distinct), np.array(folded[0]), np.array(folded[1])))
    for j in range(5):
        step = np.eye(5)[j] * 1e-6
        near = [op5_toxic.sums(theta + d * step, *packed(docs), p, np.ones(50))[:3] for d in (1, -1)]
        assert np.allclose((near[0] - near[1]) / 2e-6, one[3:].reshape(3, 5)[:, j], atol=1e-4)


def test_unlabelled_texts_are_learnt_from(spark):
    """A word of the labelled toxic documents that unlabelled documents all have, though no other labelled one has it, loses its weight."""
    docs = [(i, "other words" if i % 5 else "vilename common") for i in range(200)] + [(1000 + i, f"common plain{i % 7}") for i in range(2000)]
    labels = [(i, int(i % 5 == 0)) for i in range(200)]
    d, lab = spark.createDataFrame([(i, f"{t} w{i}") for i, t in docs], "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = op5_toxic.fit(d, lab, prior=0.05)
    assert model.weights["=vilename"] > 4 * abs(model.weights["=common"]) and model.score("common plain3") < 0.3 < 0.7 <= model.score("vilename common")


@pytest.mark.skipif(not os.path.isdir(BIG), reason="no test tables")
def test_held_out_recall(spark):
    """On held-out rows, 0.7 catches nine in ten of the toxic and few of the clean documents; both held in one place."""
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    found = op5_toxic.score(docs, op5_toxic.fit(docs, labels)).where(op5_toxic.held_out(F.col("doc_id"))).join(labels, "doc_id")
    n = {r["toxic"]: (r["hit"], r["n"]) for r in found.groupBy("toxic").agg(F.count(F.when(F.col("score") >= 0.7, 1)).alias("hit"), F.count("*").alias("n")).collect()}
    assert n[1][0] >= 0.9 * n[1][1] and n[0][0] <= 0.02 * n[0][1]
