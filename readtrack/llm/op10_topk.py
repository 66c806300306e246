"""Exact top-k by integer inner product: tiled matrix products, partial selection, merged lists.

Components become floor(scale * x). A shard of vectors meets the queries a few hundred at a time: one matrix product a
tile, a partial selection of its best, and a tree that merges each query's lists. Vectors that are null or hold null
or non-finite components take no part; nor do rows without an id. Rows that share the query's id count as its own and are no
candidates. Where a query id repeats, its least vector is the query. Vectors of different lengths
are never compared. An empty table gives an empty result. A product that leaves the range of a long
is held at the nearest end of that range. Further columns, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .vectors import SHARD_BYTES, clean, tiled, top_of

EXACT = 2.0**53
FOUND = "query_id long, vec_id long, score long, tile long"


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int, scale: float = 256.0, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The k candidates of highest integer product for each query; both frames hold (id, vec) as `clean` gives them."""

    def search(ci, data):
        c = np.floor(scale * data)

        def ask(qi, data):
            q = np.floor(scale * data)
            if q.shape[1] * np.abs(q).max(initial=0) * np.abs(c).max(initial=0) < EXACT:
                score = q @ c.T
                score[qi[:, None] == ci[None, :]] = -np.inf
                rows, cols = top_of(score, k)
                return qi[rows], ci[cols], score[rows, cols].astype(np.int64)
            return beyond_doubles(q, c, qi, ci, k)

        return ask

    return tiled(vectors, queries, k, FOUND, search, shard_bytes)


def beyond_doubles(q, c, qi, ci, k):
    """The same in whole numbers of any size."""
    found = []
    whole = [[int(x) for x in y] for y in c]
    for i, y in zip(qi.tolist(), q, strict=True):
        y = [int(x) for x in y]
        scores = ((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(y, z, strict=True)))), j) for j, z in zip(ci.tolist(), whole, strict=True) if j != i)
        found += [(i, j, -s) for s, j in sorted(scores)[:k]]
    return tuple(np.array([x[n] for x in found], np.int64) for n in range(3))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = clean(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return exact_top_k(vectors, vectors.where(F.col("id") % 50 == 0), 5)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""
