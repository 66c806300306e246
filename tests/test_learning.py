"""Training of the random field over all sentences, minimising, subword pieces, and distributions, against plain versions."""

import itertools
import random

import numpy as np
import pytest

from readtrack.operators import alignment, analytics, crf
from readtrack.operators.optimize import minimise


def test_minimise_with_l1():
    """Of a quadratic function the least with L1 is known: each coordinate is drawn to 0 by the penalty, or is 0."""
    a, target = np.array([1.0, 4.0, 0.5, 2.0]), np.array([3.0, -2.0, 0.1, 0.0])
    x, seen = minimise(lambda x: (float((a * (x - target) ** 2).sum() / 2), a * (x - target)), np.zeros(4), np.array([1.0, 1.0, 1.0, 0.0]), tolerance=1e-12)
    assert np.allclose(x, np.sign(target) * np.maximum(0, np.abs(target) - np.array([1, 1, 1, 0]) / a), atol=1e-5) and x[2] == 0
    assert all(b <= a + 1e-12 for a, b in itertools.pairwise(seen))


def test_minimise_badly_scaled():
    q = np.diag([1.0, 1e3, 1e-2]) + 0.01
    want = np.linalg.solve(q, np.ones(3))
    x, _ = minimise(lambda x: (float(x @ q @ x / 2 - x.sum()), q @ x - 1), np.zeros(3), steps=200, tolerance=1e-14)
    assert np.allclose(x, want, rtol=1e-3)


def sentences(n=60, seed=1):
    r, out = random.Random(seed), []
    for _ in range(n):
        w, k = r.choice(["kej", "yoh", "mat"]), str(r.randint(1, 9))
        out.append(r.choice([(["baca", w, k], ["O", "B", "I"]), ([w, "datang", "jam", k], ["O"] * 4), ([w, k], ["B", "I"]), (["ok"], ["O"])]))
    return out


def plain_risk(data, labels, names, w, t, l2):
    """Every tagging of every sentence, one by one."""
    known, total = {f: i for i, f in enumerate(names)}, 0.0
    for tokens, tags in data:
        score = [[sum(w[known[f], y] for f in crf.features(tokens, i) if f in known) for y in range(len(labels))] for i in range(len(tokens))]
        worth = lambda ys: sum(score[i][y] for i, y in enumerate(ys)) + sum(t[a, b] for a, b in itertools.pairwise(ys))  # noqa: E731, B023
        total += np.log(sum(np.exp(worth(ys)) for ys in itertools.product(range(len(labels)), repeat=len(tokens)))) - worth([labels.index(y) for y in tags])
    return total + l2 * ((w**2).sum() + (t**2).sum())


def test_block_against_all_taggings():
    data, labels = sentences(12), ["B", "I", "O"]
    names = sorted({f for t, _ in data for i in range(len(t)) for f in crf.features(t, i)})
    rng = np.random.default_rng(0)
    w, t = rng.normal(size=(len(names), 3)) * 0.3, rng.normal(size=(3, 3)) * 0.3
    of = lambda rows: crf.Block(*crf.Block.of(rows, {y: i for i, y in enumerate(labels)}, {f: i for i, f in enumerate(names)}, None))
    found = of([(*x, 1) for x in data]).sums(w, t)
    assert np.isclose(found[0], plain_risk(data, labels, names, w, t, 0.0))
    assert np.allclose(of([(*x, 2) for x in data]).sums(w, t), 2 * found)
    grad = found[1:]
    for j in rng.choice(w.size, 10, replace=False):
        step = np.zeros(w.size)
        step[j] = 1e-5
        near = [plain_risk(data, labels, names, w + d * step.reshape(w.shape), t, 0.0) for d in (1, -1)]
        assert np.isclose((near[0] - near[1]) / 2e-5, grad[j], atol=1e-4)
    for j in range(9):
        step = np.eye(9)[j].reshape(3, 3) * 1e-5
        near = [plain_risk(data, labels, names, w, t + d * step, 0.0) for d in (1, -1)]
        assert np.isclose((near[0] - near[1]) / 2e-5, grad[w.size + j], atol=1e-4)


@pytest.mark.parametrize("block", [8, 16384])
def test_all_sentences_train(spark, block, monkeypatch):
    """Trained on the workers, whatever the blocks and partitions, weights are those of a plain training; L1 leaves few features, and its risk is least."""
    monkeypatch.setattr(crf, "BLOCK", block)
    data = sentences()
    df = spark.createDataFrame([*data, ([], []), (None, None), (["a"], ["O", "B"]), ([None], ["O"])], "tokens array<string>, gold array<string>").repartition(5)
    model, plain = crf.fit(df, tolerance=1e-9), crf.learn(data, tolerance=1e-9)
    assert set(model.known) == set(plain.known) and len(model.known) < len({f for t, _ in data for i in range(len(t)) for f in crf.features(t, i)})
    for x in (model, plain):
        order = [x.known[f] for f in sorted(x.known)]
        x.sorted = x.weights[order]
    assert np.allclose(model.sorted, plain.sorted, atol=0.02) and np.allclose(model.steps, plain.steps, atol=0.02)
    risk = lambda w, t: plain_risk(data, plain.labels, list(plain.known), w, t, crf.L2) + crf.L1 * np.abs(w).sum()
    rng = np.random.default_rng(3)
    least = risk(plain.weights, plain.steps)
    assert all(least <= risk(plain.weights + rng.normal(0, 0.05, plain.weights.shape), plain.steps) + 1e-3 for _ in range(10))
    assert all(model.tag(t) == g for t, g in data)


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([([], [])], "tokens array<string>, gold array<string>")
    assert crf.fit(df).tag(["a", "b"]) == ["O", "O"] and crf.learn([]).tag([]) == []


def test_pieces():
    trie = alignment.Trie(["a", "ab", "abc", "##d", "##de", "##f", "b", "日"])
    assert [trie.cut(w) for w in ("abcde", "abd", "abdf", "ax", "", "b" * 101, "日d", "##d")] == [["abc", "##de"], ["ab", "##d"], ["ab", "##d", "##f"], ["[UNK]"], [], ["[UNK]"], ["日", "##d"], ["##d"]]


def test_align(spark):
    df = spark.createDataFrame([(1, ["abcde", "", "zz", "a"], ["B", "O", "I", "X"], "p"), (2, None, ["O"], "p"), (3, [], [], "p"), (4, ["a", "b"], ["B"], "p")], "id int, t array<string>, g array<string>, _x string")
    got = {r["id"]: (r["pieces"], r["words"], r["labels"]) for r in alignment.align(df, "t", "g", ["a", "abc", "##de", "b"], ["O", "B", "I"]).collect()}
    assert got[1] == (["[CLS]", "abc", "##de", "[UNK]", "a", "[SEP]"], [None, 0, 0, 2, 3, None], [-100, 1, -100, 2, -100, -100])
    assert got[2] == (None, None, None) and got[3][0] == ["[CLS]", "[SEP]"] and got[4][2] == [-100, 1, -100, -100]
    assert [len(r["pieces"]) for r in alignment.align(df.where("id = 1"), "t", "g", ["a", "abc", "##de"], ["O"], most=4).collect()] == [4]


def test_density_and_box(spark):
    rng = np.random.default_rng(5)
    data = {"a": rng.normal(50, 9, 400).round(1).tolist() + [200.0, -40.0], "b": [3.0] * 5, "c": rng.exponential(2, 300).tolist(), None: [1.0, 2.0, 4.0]}
    df = spark.createDataFrame([(g, v) for g, x in data.items() for v in x] + [("a", None)], "g string, v double")
    curves = {}
    for r in analytics.density(df, "g", "v", bins=2000, points=11).collect():
        curves.setdefault(r["g"], []).append((r["point"], r["place"], r["density"]))
    assert set(curves) == {"a", "c", None}
    for g, rows in curves.items():
        x = np.array(data[g])
        h = x.std(ddof=1) * len(x) ** -0.2
        for _, at, got in sorted(rows):
            assert np.isclose(got, np.exp(-0.5 * ((at - x) / h) ** 2).mean() / (h * np.sqrt(2 * np.pi)), rtol=1e-2, atol=1e-6)
    for r in analytics.box(df, "g", "v").collect():
        x = np.array(data[r["g"]])
        q = np.quantile(x, [0.25, 0.5, 0.75])
        inside = (x >= q[0] - 1.5 * (q[2] - q[0])) & (x <= q[2] + 1.5 * (q[2] - q[0]))
        assert np.allclose([r["q1"], r["median"], r["q3"]], q) and (r["low"], r["high"], r["outliers"], r["n"]) == (x[inside].min(), x[inside].max(), (~inside).sum(), len(x))
