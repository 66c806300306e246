"""Exact top-k and the hash-prefix forest against brute force."""

import numpy as np
import pytest

from readtrack.llm import op3_forest, op10_topk
from readtrack.llm.vectors import clean

SCHEMA = "vec_id long, embedding array<float>, extra string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "e", 7) for i, v in rows], SCHEMA)


def brute(rows, picked, k, score):
    out = []
    for q in sorted({i for i, _ in rows if picked(i)}):
        own = min(v for i, v in rows if i == q)
        best = sorted((-score(own, v), i) for i, v in rows if i != q and len(v) == len(own))[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return out


def products(rows):
    return lambda a, b: int(np.floor(256 * np.array(a, np.float64)) @ np.floor(256 * np.array(b, np.float64)))


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(i, tuple(float(x) for x in rng.normal(size=8).astype(np.float32))) for i in range(300)]
    rows += [(300 + i, rows[4][1]) for i in range(120)]  # ties
    rows += [(500, (1.0, 2.0)), (501, (2.0, 1.0)), (7, rows[8][1])]  # another length, a repeated id
    odd = [(600, None), (602, (float("nan"),) * 8), (603, (float("inf"),) * 8), (604, (None,) * 8), (None, rows[0][1])]
    v = clean(frame(spark, rows + odd), "vec_id", "embedding")
    got = op10_topk.exact_top_k(v, v.where("id % 50 = 0"), 5, shard_bytes=64 * 64)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, lambda i: i % 50 == 0, 5, products(rows))


def test_top_k_large_numbers_and_few(spark):
    rows = [(0, (3e30, -1.0)), (1, (3e30, 2.0)), (2, (-3e30, 2.0))]
    v = clean(frame(spark, rows), "vec_id", "embedding")
    got = sorted(tuple(r) for r in op10_topk.exact_top_k(v, v.where("id = 0"), 5).collect())
    assert got == [(0, 1, 1, 2**63 - 1), (0, 2, 2, -(2**63))]
    assert op10_topk.exact_top_k(v.limit(0), v.limit(0), 5).count() == 0


def in_order(a, b):
    out = 0.0
    for x, y in zip(a, b, strict=True):
        out += float(x) * float(y)
    return out


def test_forest(spark):
    rng = np.random.default_rng(5)
    rows = [(i, tuple(float(x) for x in rng.normal(size=16).astype(np.float32))) for i in range(1500)]
    rows += [(3000 + i, rows[40][1]) for i in range(60)] + [(2000, (0.0,) * 16)]
    v = clean(frame(spark, rows + [(2001, None), (2002, (None,) * 16), (None, (1.0,) * 16)]), "vec_id", "embedding")
    found = op3_forest.forest_search(v, v.where("id % 20 = 0"), 20, shard_bytes=300 * 128)
    exact = spark.createDataFrame(brute([r for r in rows if r[0] != 2000], lambda i: i % 20 == 0, 20, in_order), "query_id long, rank int, vec_id long, score double")
    assert op3_forest.recall(found, exact) >= 0.9
    assert found.groupBy("query_id").count().where("count <> 20").count() == 0
    got, known = [tuple(r) for r in found.collect()], dict(rows)
    # The score is the same in every tile, to the last bit, so ties go to smaller ids.
    assert all(s == in_order(known[q], known[i]) for q, _, i, s in got)
    assert all([r for _, r, _, _ in own] == list(range(1, 21)) and own == sorted(own, key=lambda x: (-x[3], x[2])) for own in ([g for g in sorted(got) if g[0] == q] for q in {g[0] for g in got}))
    assert 2000 not in {g[0] for g in got} and op3_forest.forest_search(v.limit(0), v.limit(0), 20).count() == 0


@pytest.mark.parametrize("spread", [0.0, 0.5])
def test_forest_recall_of_a_whole_shard(spread):
    """8,192 rows without clusters, in the registered query's own settings; norms alike or not."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(8192, 64))
    x = x / np.linalg.norm(x, axis=1)[:, None] * np.exp(spread * rng.normal(size=8192))[:, None]
    ids, q = np.arange(8192), np.arange(0, 8192, 80)
    scored, plain = [], op3_forest.best_of
    op3_forest.best_of = lambda q, near, *rest: scored.append(len(near)) or plain(q, near, *rest)
    try:
        asked, found, _ = op3_forest.searcher(ids, x, 20)(q, x[q])
    finally:
        op3_forest.best_of = plain
    score = x[q] @ x.T
    score[np.arange(len(q)), q] = -np.inf
    want = np.argsort(-score, axis=1)[:, :20]
    hit = np.mean([len(set(w) & set(found[asked == i])) / 20 for i, w in zip(q, want, strict=True)])
    assert hit >= 0.9 and sum(scored) / len(q) / 8192 < 0.65, (hit, sum(scored) / len(q) / 8192)


def test_forest_small_tables_are_whole(spark):
    rows = [(i, (float(i + 1), 1.0)) for i in range(5)]
    v = clean(frame(spark, rows), "vec_id", "embedding")
    assert op3_forest.forest_search(v, v.where("id = 9"), 20).count() == 0
    got = [(r["rank"], r["vec_id"]) for r in op3_forest.forest_search(v, v.where("id = 0"), 20).orderBy("rank").collect()]
    assert got == [(1, 4), (2, 3), (3, 2), (4, 1)]


@pytest.mark.parametrize("k", [1, 3])
def test_tops_of_a_tile(k):
    from readtrack.llm.vectors import top_of

    s = np.array([[1.0, 5, 5, 2], [-np.inf, 0, -np.inf, -1]])
    rows, cols = top_of(s, k)
    want = [(r, c) for r in range(2) for c in sorted(range(4), key=lambda c: (-s[r, c], c))[:k] if s[r, c] > -np.inf]
    assert list(zip(rows.tolist(), cols.tolist(), strict=True)) == want


def test_extreme_norms(spark):
    rows = [(0, (1e308, 1e308)), (1, (1e-308, 0.0)), (2, (1.0, 1.0)), (20, (1e-300, 1e-300))]
    v = clean(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in op3_forest.forest_search(v, v.where("id = 20"), 2).collect())
    assert got == [(20, 1, 0), (20, 2, 2)]


@pytest.mark.parametrize("tiles", [1, 16, 17, 300])
def test_merge_tree(spark, tiles):
    from readtrack.llm.vectors import merge_top

    rows = [(q, v, float((v * 7 + q) % 50), v % tiles) for q in range(3) for v in range(400)]
    got = sorted(tuple(r) for r in merge_top(spark.createDataFrame(rows, "query_id long, vec_id long, score double, tile long"), 4, tiles).collect())
    want = [(q, r, v, -s) for q in range(3) for r, (s, v) in enumerate(sorted((-s, v) for a, v, s, _ in rows if a == q)[:4], 1)]
    assert got == want


def test_tiles_of_a_shard(spark, monkeypatch):
    """Several tiles in one shard answer the same queries."""
    from readtrack.llm import vectors

    rng = np.random.default_rng(8)
    rows = [(i, tuple(float(x) for x in rng.normal(size=4).astype(np.float32))) for i in range(900)]
    v = clean(frame(spark, rows), "vec_id", "embedding")
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 64)
    monkeypatch.setattr(vectors, "TILES", 1000)
    got = op10_topk.exact_top_k(v, v.where("id % 50 = 0"), 5, shard_bytes=256)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, lambda i: i % 50 == 0, 5, products(rows))
