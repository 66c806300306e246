"""Shared plumbing of the training-data operators."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache, reduce

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: spark.checkpoint.dir, or one of our own where it is unset and all is one machine (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return own_dir()


@cache
def own_dir() -> str:
    return tempfile.mkdtemp(prefix="readtrack-")


def file_system(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def qualified(spark: SparkSession, uri: str) -> str:
    """A path with its scheme, as tasks that write files themselves need it; the folder is made."""
    store, path = file_system(spark, uri)
    store.mkdirs(path)
    return store.makeQualified(path).toString()


def remove(spark: SparkSession, *uris: str) -> None:
    for uri in uris:
        store, path = file_system(spark, uri)
        store.delete(path, True)


OPENED: list[Scratch] = []


@contextmanager
def ended_after() -> Iterator[None]:
    """What is kept meanwhile is deleted at the end: for a step whose result is written elsewhere by then."""
    before = len(OPENED)
    yield
    for one in OPENED[before:]:
        one.end()
    del OPENED[before:]


class Scratch:
    """Tables written to the shared folder to cut lineage; a lost executor costs no recomputation beyond them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/readtrack-{uuid.uuid4().hex}"
        fs_path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self._fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(fs_path)
        self._fs.deleteOnExit(fs_path)
        OPENED.append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def folder(self, name: str) -> str:
        """A folder in the shared one, as a URI, for files that tasks write themselves."""
        found = self._fs.makeQualified(self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name)))
        self._fs.mkdirs(found)
        return found.toString()

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str, release: bool = True) -> None:
        """Deletes tables that no later plan reads, and lets Spark clean the shuffles behind them."""
        for name in names:
            self._fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name)), True)
        if release:
            self.release()

    def end(self) -> None:
        """Deletes everything kept here; no later plan may read it."""
        self._fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self.root), True)
        self.release()

    def release(self) -> None:
        gc.collect()
        self.spark._jvm.System.gc()


def fresh(name: str, taken: list[str]) -> str:
    """A column name like `name` that none of `taken` is, in either case."""
    known = {x.lower() for x in taken}
    while name.lower() in known:
        name += "_"
    return name


def slices(batch, column: int, most: int = 4 << 20):
    """A batch in parts of about `most` bytes of a text or binary column (one row at least), so that what is made of a part stays small."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def numbered(df: DataFrame, name: str, order: list, scratch: Scratch, ranges: list | None = None) -> DataFrame:
    """Adds the rows' numbers from 0 in an order, sorted in ranges on all workers; only a count a range comes to the driver.

    ranges: what begins the order and is short, since the driver samples it; all of the order, unless given.
    """
    placed = scratch.keep(df.repartitionByRange(*(ranges or order)).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id()), f"numbered-{name}")
    part = F.shiftright(F.col(name), 33)
    counts = sorted(tuple(r) for r in placed.groupBy(part.alias("range")).count().collect())
    starts, at = [], 0
    for k, n in counts:
        starts.append((k, at))
        at += n
    if not starts:
        return placed
    offset = F.element_at(F.create_map(*[F.lit(x) for pair in starts for x in pair]), part)
    return placed.withColumn(name, offset + F.col(name).bitwiseAND((1 << 33) - 1))


BATCH_ROWS = 2000


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """From now on in this session, at most `rows` rows go to Python at a time: documents are long, and both sides hold a batch. A lower setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    spark.conf.set(key, str(rows if now <= 0 else min(rows, now)))


def parts(rows: int, per_part: int, least: int = 1) -> int:
    return max(least, -(-rows // per_part))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(a, b) links of long ids -> (node, root), root the least id of its component.

    Alternating large-star and small-star steps; each is one aggregation and one join, written to
    the shared folder, until no link changes. Nodes without links are not returned.
    """
    both = lambda e: e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        e.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )

    def mark(e: DataFrame) -> tuple:
        return tuple(
            e.agg(
                F.count("*"),
                F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")),
            ).first()
        )

    now = scratch.keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        f"{name}-0",
    )
    step, seen = 0, mark(now)
    while True:
        step += 1
        pairs = both(now)
        low = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            pairs.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        )
        large = scratch.keep(large, f"{name}-{step}-l")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.*")
            .where("a <> b")
            .distinct()
        )
        now = scratch.keep(small, f"{name}-{step}")
        got = mark(now)
        scratch.drop(f"{name}-{step - 1}", f"{name}-{step}-l", release=False)
        if got == seen:
            break
        seen = got
    root = now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return root.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
