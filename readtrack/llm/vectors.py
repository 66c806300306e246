"""Vectors packed into small blocks, shards of them that meet the queries one after another, and merged lists."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import parts

BLOCK_SCHEMA = "block long, dim int, ids binary, data binary"
BLOCK_BYTES, SHARD_BYTES, QUERY_ROWS, FAN_IN = 1 << 13, 1 << 22, 512, 16
TILES = 16  # shards that a task prepares together, so that the queries travel once for all of them


def clean(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec): rows with an id and a vector whose components are all present and finite."""
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.select(F.col(id_col).cast("long").alias("id"), v.alias("vec")).where(
        F.col("id").isNotNull() & F.col("vec").isNotNull() & ~F.coalesce(bad, F.lit(True))
    )


def pack(df: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, vec) -> blocks of vectors of one length, of at most `block_bytes` (one vector at least); no shuffle."""

    def run(batches):
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            vec = batch.column(1)
            flat = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            dims = vec.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            begins = np.cumsum(dims) - dims
            out = defaultdict(list)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                data = flat[begins[at][:, None] + np.arange(dim)]
                rows = max(1, block_bytes // (8 * max(1, dim)))
                for k in range(0, len(at), rows):
                    made += 1
                    for name, x in (("block", part << 32 | made), ("dim", dim), ("ids", ids[at[k : k + rows]].tobytes()), ("data", data[k : k + rows].tobytes())):
                        out[name].append(x)
            if out:
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("data", pa.binary())]))

    return df.select("id", "vec").mapInArrow(run, BLOCK_SCHEMA)


def tiled(vectors: DataFrame, queries: DataFrame, k: int, schema: str, search: Callable, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The k best of each query: query_id, rank, vec_id, score. `search(ids, data)` prepares a shard and gives a function of queries' ids and data.

    Every shard meets the query blocks of its length: an equi-join on the shard's number in which the shard's blocks stream by first and
    are prepared once, in tiles of `shard_bytes`, then the queries' blocks, QUERY_ROWS queries at a time. Rows are small blocks, so no batch is large.
    """
    total = vectors.agg(F.sum(8 * F.size("vec"))).first()[0] or 0
    tiles = parts(total, shard_bytes, 1)
    shards = max(parts(tiles, TILES), min(tiles, vectors.sparkSession.sparkContext.defaultParallelism))
    held = pack(vectors).withColumns({"shard": F.pmod(F.xxhash64("block"), F.lit(shards)).cast("int"), "asks": F.lit(False)})
    asked = pack(distinct_queries(queries)).withColumns({"shard": F.explode(F.sequence(F.lit(0), F.lit(shards - 1))), "asks": F.lit(True)})
    dealt = held.unionByName(asked).repartition(shards, "shard", "dim").sortWithinPartitions("shard", "dim", "asks", "block")

    def run(batches):
        at, blocks, ready, waiting, rows, size = None, [], [], [], 0, 0

        def whole(pairs, dim):
            ids = np.concatenate([np.frombuffer(i, np.int64) for i, _ in pairs])
            order = np.argsort(ids, kind="stable")
            return ids[order], np.concatenate([np.frombuffer(d).reshape(len(i) // 8, dim) for i, d in pairs])[order]

        def answers():
            asked = whole(waiting, at[1])
            for ask in ready:
                found = ask(*asked)
                yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in found), pa.array(np.full(len(found[0]), at[0], np.int64))], ["query_id", "vec_id", "score", "tile"])

        for batch in batches:
            for shard, dim, asks, ids, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (shard, dim) != at:
                    if waiting:
                        yield from answers()
                    at, blocks, ready, waiting, rows, size = (shard, dim), [], [], [], 0, 0
                if not asks:
                    if blocks and size + len(data) > shard_bytes:
                        ready.append(search(*whole(blocks, dim)))
                        blocks, size = [], 0
                    blocks.append((ids, data))
                    size += len(data)
                    continue
                if blocks:
                    ready.append(search(*whole(blocks, dim)))
                    blocks = []
                if not ready:
                    continue
                waiting.append((ids, data))
                rows += len(ids) // 8
                if rows >= QUERY_ROWS:
                    yield from answers()
                    waiting, rows = [], 0
        if waiting:
            yield from answers()

    return merge_top(dealt.select("shard", "dim", "asks", "ids", "data").mapInArrow(run, schema), k, shards)


def merge_top(found: DataFrame, k: int, tiles: int) -> DataFrame:
    """(query_id, vec_id, score, tile) -> query_id, rank, vec_id, score: a tree that merges each query's lists of FAN_IN tiles at a time."""
    order = [F.col("score").desc(), F.col("vec_id").asc()]
    while tiles > FAN_IN:
        near = found.withColumn("tile", F.expr(f"tile div {FAN_IN}"))
        found = near.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "tile").orderBy(*order))).where(F.col("rank") <= k).drop("rank")
        tiles = parts(tiles, FAN_IN)
    last = Window.partitionBy("query_id").orderBy(*order)
    return found.withColumn("rank", F.row_number().over(last).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_of(score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k largest of each row, ties to the smaller column; -inf never counts."""
    n = score.shape[1]
    if n > k:
        least = np.partition(score, n - k, axis=1)[:, n - k]
        rows, cols = np.nonzero((score >= least[:, None]) & (score > -np.inf))
    else:
        rows, cols = np.nonzero(score > -np.inf)
    order = np.lexsort((cols, -score[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    place = np.arange(len(rows)) - np.repeat(starts, np.diff(np.append(starts, len(rows))))
    return rows[place < k], cols[place < k]


def distinct_queries(df: DataFrame) -> DataFrame:
    """One vector for each query id: the least, where an id repeats."""
    return df.groupBy("id").agg(F.min("vec").alias("vec"))
