"""Approximate nearest neighbours by a hash-prefix forest.

Each shard of rows holds `trees` sorted arrays of `bits`-long hash strings (signs of random
projections). A query descends every tree to its longest-prefix match, and all trees ascend
together, one bit at a time, until what they reached counts `width` rows for each neighbour asked and `share` of
the rows besides; those candidates alone are scored, by inner product in double precision on the original vectors, summed in the order of
components, so that a pair's score is the same in every tile. To rank inner products by angle, vectors get one
more component that levels their norms; rows whose norms differ by more than RATIO are in trees of
their own (bands), searched from the largest norms down, and a band whose norms can't give a better product than the k found is left out.

Vectors null, zero, or holding null or non-finite components take no part, nor rows without an id.
Rows that share the query's id count as its own. Where a query id repeats, its least vector is the
query. Vectors of different lengths are never compared; an empty table gives an empty result. Ties go to the smaller id.
Further columns, whatever their names, are not read.

Vectors without any clusters (isotropic) are the hardest case for hashing. `recall` measures it against brute force on any query set.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .vectors import SHARD_BYTES, clean, tiled

TREES, BITS, WIDTH, SHARE, RATIO = 128, 16, 12, 0.35, 1.25
FOUND = "query_id long, vec_id long, score double, tile long"


def planes(dim: int, trees: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim + 1, trees * bits), np.float32)


def strings(x: np.ndarray, pad: np.ndarray, proj: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """Hash strings of each row and tree, first bit highest. Rows are scaled to norms of about one."""
    out = np.empty((len(x), trees), np.int64)
    weight = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
    for at in range(0, len(x), 1024):
        part = slice(at, at + 1024)
        out[part] = (np.c_[x[part], pad[part]].astype(np.float32) @ proj > 0).reshape(-1, trees, bits) @ weight
    return out


class Forest:
    """The trees of rows whose norms are alike; their sorted arrays lie end to end."""

    def __init__(self, x: np.ndarray, norms: np.ndarray, proj: np.ndarray, trees: int, bits: int):
        self.bits, self.trees, self.n, self.top = bits, trees, len(x), float(norms.max())
        pad = np.sqrt(np.maximum(0, self.top**2 - norms**2))
        keys = strings(x, pad, proj, trees, bits).T
        order = np.argsort(keys, axis=1, kind="stable")
        self.first = np.arange(trees, dtype=np.int64) << bits
        self.keys = (np.take_along_axis(keys, order, 1) + self.first[:, None]).ravel()
        self.order = order.astype(np.int32).ravel()

    def ranges(self, asked: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(queries, trees) begins and ends of the rows that share a prefix of `level` bits."""
        drop = self.bits - level
        first = (asked >> drop << drop) + self.first
        return np.searchsorted(self.keys, first), np.searchsorted(self.keys, first + (1 << drop))

    def candidates(self, asked: np.ndarray, want: int) -> list[np.ndarray]:
        """For each query, the rows reached when all trees have ascended until there are `want`."""
        want = min(want, self.n)
        out: list = [None] * len(asked)
        left = np.arange(len(asked))
        for level in range(self.bits, -1, -1):
            lo, hi = self.ranges(asked[left], level)
            sizes = hi - lo
            open_ = []
            for j, i in enumerate(left.tolist()):
                if sizes[j].sum() >= want:  # below that even repeats don't reach `want`
                    ends = np.cumsum(sizes[j])
                    at = np.repeat(lo[j] - ends + sizes[j], sizes[j]) + np.arange(ends[-1])
                    reached = np.zeros(self.n, bool)
                    reached[self.order[at]] = True
                    found = np.flatnonzero(reached)
                    if len(found) >= want or level == 0:
                        out[i] = found
                        continue
                open_.append(i)
            left = np.array(open_, np.int64)
            if not len(left):
                break
        return out


def in_order(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of q with rows, each summed from the first component to the last."""
    out = np.zeros(len(rows))
    for x, column in zip(q.tolist(), rows.T, strict=True):
        out += x * column
    return out


def best_of(q: np.ndarray, near: np.ndarray, data: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The candidates that may be among the k best, and their scores: a product leaves out those that are worse beyond any rounding."""
    rows = data[near]
    rough = rows @ q
    if len(near) > k:
        slack = 1e-12 * np.abs(q).sum() * np.abs(rows).max()
        keep = rough >= np.partition(rough, len(near) - k)[len(near) - k] - slack
        near, rows = near[keep], rows[keep]
    return near, in_order(q, rows)


def bands(norms: np.ndarray, ratio: float) -> list[np.ndarray]:
    """Rows by norm, largest first: those of a band have at least its largest norm over `ratio`."""
    order = np.argsort(-norms, kind="stable")
    sorted_, out, at = -norms[order], [], 0
    while at < len(order):
        end = int(np.searchsorted(sorted_, sorted_[at] / ratio, side="right"))
        out.append(np.sort(order[at : max(end, at + 1)]))
        at = max(end, at + 1)
    return out


def forest_search(
    vectors: DataFrame, queries: DataFrame, k: int, trees: int = TREES, bits: int = BITS, width: int = WIDTH, share: float = SHARE, ratio: float = RATIO, seed: int = 42, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """The k nearest found of each query: query_id, rank, vec_id, score. Both frames as `clean` gives them."""
    some = F.exists("vec", lambda x: x != 0)
    return tiled(vectors.where(some), queries.where(some), k, FOUND, lambda ids, data: searcher(ids, data, k, trees, bits, width, share, ratio, seed), shard_bytes)


def searcher(ids: np.ndarray, data: np.ndarray, k: int, trees: int = TREES, bits: int = BITS, width: int = WIDTH, share: float = SHARE, ratio: float = RATIO, seed: int = 42):
    """A shard's forests, and the function that answers queries' (ids, data) from them. Rows come by ascending id."""
    proj, biggest = planes(data.shape[1], trees, bits, seed), np.finfo(np.float64).max

    def norms_of(x):
        big = np.abs(x).max(axis=1)
        return np.minimum(big * np.sqrt(((x / big[:, None]) ** 2).sum(1)), biggest)

    norms = norms_of(data)
    scale = 1 / norms.max()
    own = [(at, Forest(data[at] * scale, norms[at] * scale, proj, trees, bits)) for at in bands(norms, ratio)]

    def ask(qi, q):
        lengths = norms_of(q)
        asked = strings(q / lengths[:, None], np.zeros(len(q)), proj, trees, bits)
        best = [(np.empty(0, np.int64), np.empty(0))] * len(qi)
        for rows, f in own:
            open_ = [i for i, (at, score) in enumerate(best) if len(at) < k or score[-1] <= lengths[i] * (f.top / scale) * (1 + 1e-9)]
            for i, found in zip(open_, f.candidates(asked[open_], width * k + int(share * f.n)), strict=True):
                near = rows[found]
                near, scores = best_of(q[i], near[ids[near] != qi[i]], data, k)
                at, score = np.append(best[i][0], near), np.append(best[i][1], scores)
                first = np.lexsort((ids[at], -score))[:k]
                best[i] = at[first], score[first]
        return np.repeat(qi, [len(at) for at, _ in best]), ids[np.concatenate([at for at, _ in best])], np.concatenate([score for _, score in best])

    return ask


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact (query_id, vec_id) pairs that were found."""
    total = exact.count()
    return found.join(exact, ["query_id", "vec_id"], "left_semi").count() / total if total else 1.0


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = clean(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return forest_search(vectors, vectors.where(F.col("id") % 20 == 0), 20)
