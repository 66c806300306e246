"""A pair of tables bucketed alike by a key: two-phase external sort with runs on the shared storage.

Map tasks hold a bounded number of bytes, sort them by bucket, key and the other columns, and spill them as one run: a file of Arrow
streams, one for each bucket in it. What Spark shuffles is the list of these streams alone. A task that has a bucket
merges its streams chunk by chunk by a heap of the chunks' last rows and writes one Parquet file as it goes. Of more than FAN_IN
streams, groups are merged into longer ones first, each group by a task of its own; so a bucket of any size takes no more memory than a small one.

Both tables are first written in numbered files, then bucketed: a starting file that already has exactly the rows of a final file stays.
The right table's buckets are merged beside the left table's sorted keys; rows whose key the left table lacks become one more sorted
run, from which the bucket after the hashed ones is merged, and rows without a key make up the one after that.

Every table written is complete or not there (files are moved to their names when they are closed), and what a task found is in
Spark's own tables on the shared folder, so a lost executor costs the tasks that it ran. The driver gets one row a
file, and there are `buckets + 2` files a table at most.

Defined results: an empty table has no file; nulls come first, NaN last, strings go by their bytes; rows that are equal all stay;
rows without a key join nothing; a left row without a key is in the last bucket, like a right one. Further columns, whatever their names, are carried and sorted by. Columns of arrays, maps and
structs have no order here and are an error.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, parts, qualified, remove, shared_dir, table

BUCKETS, SALT = 300, "line"
RUN_BYTES, CHUNK_BYTES, GROUP_BYTES, FAN_IN = 32 << 20, 1 << 19, 8 << 20, 48
RUN = "bucket int, path string, at long, n_rows long"
FILE = f"{RUN}, n_joined long, ids string, lineage string, only int"
RESULT = "table_name string, path string, columns string, ids_sha256 string, lineage_sha256 string, bucket long, n_rows long, n_joined long, rewritten boolean"


# -- rows in order ------------------------------------------------------------------------------


def sort_table(held: pa.Table, first: list[int], data: list[int]) -> pa.Table:
    """The rows by columns `first`, then by `data`: nulls first, NaN last."""
    cols = []
    for i in [*first, *data]:
        x = held.column(i)
        if pa.types.is_floating(x.type):
            odd = pc.is_nan(x)
            cols.append(pc.if_else(odd, float("inf"), x))
            if pc.any(odd).as_py():
                cols.append(odd.cast(pa.int8()))
        else:
            cols.append(x.cast(pa.int8()) if pa.types.is_boolean(x.type) else x)
    keys = pa.table(cols, [f"k{i}" for i in range(len(cols))])
    return held.take(pc.sort_indices(keys, sort_keys=[(n, "ascending") for n in keys.column_names], null_placement="at_start"))


def row_key(batch, row: int, columns: list[int]) -> tuple:
    """A row as a tuple that compares as the rows do."""

    def cell(v):
        if v is None:
            return (0,)
        if isinstance(v, str):
            return 1, v.encode()
        return (2, 0) if v != v else (1, v)

    return tuple(cell(batch.column(c)[row].as_py()) for c in columns)


class Held:
    """The chunk of a run that is in memory, and how far it was taken."""

    def __init__(self, batches: Iterator[pa.RecordBatch], columns: list[int]):
        self.batches, self.columns, self.batch, self.at = batches, columns, None, 0

    def load(self) -> bool:
        self.batch = next((b for b in self.batches if b.num_rows), None)
        self.at = 0
        if self.batch is not None:
            key = self.batch.column(self.columns[0])
            self.nulls = key.null_count
            self.keys = key.slice(self.nulls).to_numpy(zero_copy_only=False) if pa.types.is_integer(key.type) else None
            self.last = row_key(self.batch, self.batch.num_rows - 1, self.columns)
        return self.batch is not None

    def until(self, bound: tuple) -> int:
        """How many of the chunk's rows are not behind the bound."""
        lo, hi = self.at, self.batch.num_rows
        if self.last <= bound:
            return hi
        if self.keys is not None:  # by the key first, so that few whole rows are looked at
            near = (0, self.nulls) if bound[0] == (0,) else tuple(self.nulls + int(np.searchsorted(self.keys, bound[0][1], side)) for side in ("left", "right"))
            lo, hi = max(lo, near[0]), max(self.at, near[1])
        return bisect_right(range(hi), bound, lo, hi, key=lambda k: row_key(self.batch, k, self.columns))


def merged(runs: list[Iterator[pa.RecordBatch]], columns: list[int]) -> Iterator[pa.Table]:
    """Sorted runs as one, a part at a time.

    The heap has each run's last row in memory. What isn't behind the least of them is complete: it is cut off every chunk, put in order and given out;
    then the run that bounded it loads its next chunk.
    """
    held = [Held(r, columns) for r in runs]
    heap = [(h.last, i) for i, h in enumerate(held) if h.load()]
    heapq.heapify(heap)
    while heap:
        bound, i = heap[0]
        cut = []
        for _, k in heap:
            h = held[k]
            end = h.until(bound)
            if end > h.at:
                cut.append(h.batch.slice(h.at, end - h.at))
                h.at = end
        if cut:  # else its last rows were equal to another chunk's, and went with it
            part = pa.Table.from_batches(cut)
            yield sort_table(part, [], columns) if len(cut) > 1 else part
        if held[i].load():
            heapq.heapreplace(heap, (held[i].last, i))
        else:
            heapq.heappop(heap)


# -- files --------------------------------------------------------------------------------------


def storage(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def url(root: str, path: str) -> str:
    """The URI of a path within the root's store."""
    return root + path.removeprefix(storage(root)[1])


def shown(spark: SparkSession, uri: str) -> str:
    """A URI as readers like it best: a plain path, where plain paths are of the same store."""
    plain = uri.startswith("file:") and spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:")
    return storage(uri)[1] if plain else uri


class RunFile:
    """A file of the shared folder that sorted streams are written to, one behind the other."""

    def __init__(self, folder: str):
        self.store, root = storage(folder)
        self.path = f"{root}/{uuid.uuid4().hex}.arrows"
        self.out = None

    def write(self, tables: Iterator[pa.Table]) -> tuple[int, int]:
        """Where the stream begins, and its rows."""
        if self.out is None:
            self.out = self.store.open_output_stream(self.path)
        at, rows, writer = self.out.tell(), 0, None
        for t in tables:
            if writer is None:
                writer = pa.ipc.new_stream(self.out, t.schema, options=pa.ipc.IpcWriteOptions(compression="lz4"))
            if t.num_rows:
                writer.write_table(t, max_chunksize=max(64, CHUNK_BYTES * t.num_rows // max(1, t.nbytes)))
                rows += t.num_rows
        if writer is not None:
            writer.close()
        return at, rows

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


def stream_of(store, path: str, at: int) -> Iterator[pa.RecordBatch]:
    with store.open_input_file(path) as f:
        f.seek(at)
        yield from pa.ipc.open_stream(f)


class TableFile:
    """One Parquet file, written in order: moved to its name when it is whole. Nothing is made where no row comes."""

    def __init__(self, root: str, name: str, columns: list[str], key: int):
        self.store, base = storage(root)
        self.draft, self.path = f"{base}/_drafts/{uuid.uuid4().hex}", f"{base}/{name}"
        self.columns, self.key, self.rows, self.ids = columns, key, 0, hashlib.sha256()
        self.writer, self.waiting, self.size = None, [], 0

    def add(self, part: pa.Table) -> None:
        if not part.num_rows:
            return
        ids = pc.fill_null(part.column(self.key).cast(pa.string()), "").combine_chunks()
        text = pc.binary_join(pa.ListArray.from_arrays([0, len(ids)], ids), ",")[0].as_py()
        self.ids.update((b"," if self.rows else b"") + text.encode())
        self.rows += part.num_rows
        self.waiting.append(part.rename_columns(self.columns))
        self.size += part.nbytes
        if self.size >= GROUP_BYTES:
            self.flush()

    def flush(self) -> None:
        whole = pa.concat_tables(self.waiting).combine_chunks()
        if self.writer is None:
            self.store.create_dir(self.draft.rpartition("/")[0], recursive=True)
            self.out = self.store.open_output_stream(self.draft)
            self.writer = pq.ParquetWriter(self.out, whole.schema, compression="zstd", store_schema=False)
        self.writer.write_table(whole)
        self.waiting, self.size = [], 0

    def close(self) -> bool:
        if not self.rows:
            return False
        if self.waiting:
            self.flush()
        self.writer.close()
        self.out.close()
        self.store.create_dir(self.path.rpartition("/")[0], recursive=True)
        if self.store.get_file_info(self.path).is_file:  # of another attempt, with the same rows
            self.store.delete_file(self.path)
        self.store.move(self.draft, self.path)
        return True


def record(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], [n for n, _ in fields])


# -- the two phases -----------------------------------------------------------------------------


def spill(folder: str, columns: list[int], run_bytes: int) -> Callable:
    """Map phase: (bucket, start, data columns) -> a row for each sorted stream."""

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = sort_table(pa.Table.from_batches(held), [0], columns)
        bucket = rows.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
        out, file = [], RunFile(folder)
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            at, n = file.write(iter([rows.slice(lo, hi - lo)]))
            out.append((int(bucket[lo]), file.path, at, n))
        file.close()
        return record(RUN, out)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size >= run_bytes:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    return run


def by_bucket(batches) -> Iterator[tuple[int, list[tuple[str, int]]]]:
    """The streams of one bucket and group after another; they come sorted."""
    now, found = None, []
    for batch in batches:
        for bucket, group, path, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (bucket, group) != now:
                if found:
                    yield now[0], found
                now, found = (bucket, group), []
            found.append((path, at))
    if found:
        yield now[0], found


def lengthen(folder: str, columns: list[int]) -> Callable:
    """Merge phase, before the last: the streams of a group become one."""

    def run(batches):
        store, _ = storage(folder)
        file, out = RunFile(folder), []
        for bucket, streams in by_bucket(batches):
            at, n = file.write(merged([stream_of(store, *s) for s in streams], columns))
            out.append((bucket, file.path, at, n))
        file.close()
        if out:
            yield record(RUN, out)

    return run


def files_of(root: str, name: str, names: list[str], columns: list[int], beside: dict[int, str] | None = None, hashed: int = 0, orphans: str = "") -> Callable:
    """Merge phase, last: a bucket's streams become a file. The first `hashed` buckets are merged beside the left table's files, and rows whose key these lack go to a run of orphans."""
    data = list(range(2, 2 + len(names)))
    key = columns[0]

    def run(batches):
        store, _ = storage(root)
        for bucket, streams in by_bucket(batches):
            file, starts, joined = TableFile(root, name.format(bucket), names, key - 2), {}, 0
            near = Keys(store, beside.get(bucket), names[key - 2]) if beside is not None and bucket < hashed else None
            aside = RunFile(orphans) if near else None

            def known(parts_):
                """The rows that stay here are written; the others are given on."""
                nonlocal joined
                for part in parts_:
                    if near:
                        times = near.times(part.column(key).combine_chunks())
                        joined += int(times.sum())
                        rest, part = part.filter(pa.array(times == 0)), part.filter(pa.array(times > 0))
                        if rest.num_rows:
                            yield rest
                    number, n = np.unique(part.column(1).to_numpy(), return_counts=True)
                    for s, k in zip(number.tolist(), n.tolist(), strict=True):
                        starts[s] = starts.get(s, 0) + k
                    file.add(part.select(data))

            found = known(merged([stream_of(store, *s) for s in streams], columns))
            if aside:
                at, n = aside.write(found)
                aside.close()
                if n:
                    yield record(FILE, [(bucket, aside.path, at, n, 0, "", "", -1)])
            else:
                list(found)
            if file.close():
                lineage = ",".join(f"{s}:{starts[s]}" for s in sorted(starts))
                only = next(iter(starts)) if len(starts) == 1 else -1
                yield record(FILE, [(bucket, file.path, -1, file.rows, joined, file.ids.hexdigest(), hashlib.sha256(lineage.encode()).hexdigest(), only)])

    return run


class Keys:
    """The left table's sorted keys of a bucket, a chunk at a time, as far as they are asked for."""

    def __init__(self, store, path: str | None, column: str):
        self.batches = self.read(store, path, column) if path else iter(())
        self.held, self.last = np.empty(0, np.int64), None

    @staticmethod
    def read(store, path, column):
        with store.open_input_file(path) as f:
            for batch in pq.ParquetFile(f).iter_batches(batch_size=65536, columns=[column]):
                yield batch.column(0).drop_null().to_numpy(zero_copy_only=False)

    def times(self, keys: pa.Array) -> np.ndarray:
        """How often each of these ascending keys, none below those asked for before, is in the left table."""
        asked = keys.to_numpy(zero_copy_only=False)
        out = np.zeros(len(asked), np.int64)
        known = 0
        if self.last and len(asked):  # the key that the last part ended with
            known = int(np.searchsorted(asked, self.last[0], "right"))
            out[:known] = self.last[1]
        asked, found = asked[known:], out[known:]
        if not len(asked):
            return out
        while True:
            if not len(self.held):
                self.held = next(self.batches, None)
                if self.held is None:
                    self.held = np.empty(0, np.int64)
                    break
            found += np.searchsorted(self.held, asked, "right") - np.searchsorted(self.held, asked, "left")
            self.held = self.held[np.searchsorted(self.held, asked[-1], "right") :]
            if len(self.held):
                break
        self.last = (asked[-1], found[-1])
        return out


class Sorter:
    """Sorted files of a table, one for each bucket, through runs in a folder of their own."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, buckets: int, run_bytes: int, fan_in: int):
        self.spark, self.root, self.schema, self.names = spark, root, schema, schema.names
        if bad := [f.name for f in schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]:
            raise ValueError(f"columns without an order: {bad}")
        if not isinstance(schema[key].dataType, T.IntegralType):
            raise ValueError("the key is a whole number")
        first = 2 + self.names.index(key)
        self.columns = [first, *(i for i in range(2, 2 + len(self.names)) if i != first)]
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
        self.tasks, self.run_bytes, self.fan_in, self.buckets = min(buckets + 2, tasks), run_bytes, fan_in, buckets

    def __enter__(self) -> Sorter:
        """For one sort: its runs and lists are deleted at the end."""
        self.scratch = Scratch(self.spark)
        return self

    def __exit__(self, *_) -> None:
        self.scratch.end()

    def stored(self, files: Iterable) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*[url(self.root, r["path"]) for r in files])

    def runs(self, df: DataFrame, bucket: Column, start: Column, label: str) -> DataFrame:
        """Spills a table; the list of its streams."""
        folder = self.scratch.folder(f"{label}-runs")
        placed = df.select(bucket.cast("int"), start.cast("int"), *[F.col(f"`{c}`") for c in df.columns]).toDF(*[f"c{i}" for i in range(len(df.columns) + 2)])
        return self.scratch.keep(placed.mapInArrow(spill(folder, self.columns, self.run_bytes), RUN), f"{label}-index")

    def shorter(self, index: DataFrame, label: str) -> DataFrame:
        """Lists of at most about `fan_in` streams a bucket."""
        level = 0
        while (most := index.groupBy("bucket").count().agg(F.max("count")).first()[0] or 0) > self.fan_in:
            level += 1
            folder, groups = self.scratch.folder(f"{label}-{level}-runs"), parts(most, self.fan_in)
            dealt = index.withColumn("group", F.pmod(F.xxhash64("path", "at"), F.lit(groups)).cast("int"))
            dealt = dealt.repartition(self.tasks * min(groups, 64), "bucket", "group").sortWithinPartitions("group", "bucket", "path", "at")
            index = self.scratch.keep(dealt.select("bucket", "group", "path", "at").mapInArrow(lengthen(folder, self.columns), RUN), f"{label}-{level}-index")
            self.scratch.drop(f"{label}-runs" if level == 1 else f"{label}-{level - 1}-runs", release=False)
        return index

    def files(self, index: DataFrame, name: str, label: str, beside: dict[int, str] | None = None) -> DataFrame:
        """Merges each bucket's streams into its file: a row for each file, and for each run of orphans."""
        orphans = self.scratch.folder(f"{label}-orphans") if beside is not None else ""
        dealt = self.shorter(index, label).repartition(self.tasks, "bucket").sortWithinPartitions("bucket", "path", "at")
        dealt = dealt.select("bucket", F.lit(0).alias("group"), "path", "at")
        return self.scratch.keep(dealt.mapInArrow(files_of(self.root, name, self.names, self.columns, beside, self.buckets, orphans), FILE), f"{label}-files")


def hashed_bucket(key: Column, buckets: int = BUCKETS, salt: str = SALT) -> Column:
    """The bucket of a key by its salted crc32; rows without a key are in the last, and the one before is left to orphans."""
    return F.coalesce(F.crc32(F.concat(F.lit(salt), key.cast("string")).cast("binary")) % buckets, F.lit(buckets + 1)).cast("int")


def first_files(work: Sorter, df: DataFrame, start: Column) -> dict:
    """Writes the numbered files that a table starts in: number -> what is known of the file."""
    with work:
        return {r["bucket"]: r for r in work.files(work.runs(df, start, start, "start"), "start-{:05d}.parquet", "start").collect()}


def settled(work: Sorter, begun: dict, start: Column, bucket: Column) -> dict[int, int]:
    """Starting files that are a final file already, where the key alone decides on the bucket: number -> bucket."""
    pairs = work.stored(begun.values()).groupBy(start.alias("s"), bucket.alias("b")).agg(F.count("*").alias("n"))
    whole = pairs.groupBy("b").agg(F.sum("n").alias("n"), F.min("s").alias("s"), F.count("*").alias("k")).where("k = 1").collect()
    return {r["s"]: r["b"] for r in whole if begun[r["s"]]["n_rows"] == r["n"]}


def final_files(work: Sorter, begun: dict, stays: dict[int, int], start: Column, bucket: Column, beside: dict[int, str] | None = None) -> list[dict]:
    """Writes the bucketed files and deletes what they replace: a dict for each file that is there in the end."""
    found: list = []
    moving = [r for s, r in sorted(begun.items()) if s not in stays]
    if moving:
        with work:
            made = work.files(work.runs(work.stored(moving), bucket, start, "bucket"), "bucket-{:05d}.parquet", "bucket", beside)
            found = made.where("at < 0").collect()
            if beside is not None:
                orphans = made.where("at >= 0").select(F.lit(work.buckets).alias("bucket"), "path", "at", "n_rows")
                found += work.files(orphans, "bucket-{:05d}.parquet", "orphans").collect()
    for r in found:  # a file with exactly a starting file's rows isn't needed: that one stays
        if r["only"] >= 0 and begun[r["only"]]["n_rows"] == r["n_rows"]:
            stays[r["only"]] = r["bucket"]
    out, gone = [], []
    for s, r in begun.items():
        if s not in stays:
            gone.append(r["path"])
            continue
        lineage = hashlib.sha256(f"{s}:{r['n_rows']}".encode()).hexdigest()
        out.append({"path": r["path"], "bucket": stays[s], "n_rows": r["n_rows"], "ids": r["ids"], "lineage": lineage, "rewritten": False, "n_joined": 0})
    for r in found:
        stayed = next((x for x in out if x["bucket"] == r["bucket"]), None)
        if stayed:
            stayed["n_joined"] = r["n_joined"]
            gone.append(r["path"])
        else:
            out.append({**{k: r[k] for k in ("path", "bucket", "n_rows", "ids", "lineage", "n_joined")}, "rewritten": True})
    remove(work.spark, *[url(work.root, p) for p in gone], f"{work.root}/_drafts")
    return out


def co_bucket(
    spark: SparkSession,
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_start: Column,
    right_start: Column,
    names: tuple[str, str] = ("left", "right"),
    buckets: int = BUCKETS,
    salt: str = SALT,
    root: str | None = None,
    run_bytes: int = RUN_BYTES,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """Writes both tables under a folder of their own, in starting files and then bucketed: a row for each final file."""
    uri = qualified(spark, root or f"{shared_dir(spark)}/co-bucketed-{uuid.uuid4().hex}")
    bucket = hashed_bucket(F.col(f"`{key}`"), buckets, salt)
    works = [Sorter(spark, f"{uri}/{n}", df.schema, key, buckets, run_bytes, fan_in) for n, df in zip(names, (left, right), strict=True)]
    begun = first_files(works[0], left, left_start)
    lefts = final_files(works[0], begun, settled(works[0], begun, left_start, bucket) if begun else {}, left_start, bucket)
    begun = first_files(works[1], right, right_start)
    kept = final_files(works[1], begun, {}, right_start, bucket, {r["bucket"]: r["path"] for r in lefts})
    out = [(n, ",".join(df.columns), r) for n, df, files in zip(names, (left, right), (lefts, kept), strict=True) for r in files]
    joined = {r["bucket"]: r["n_joined"] for r in kept}
    rows = [
        (name, shown(spark, url(uri, r["path"])), columns, r["ids"], r["lineage"], r["bucket"], r["n_rows"], joined.get(r["bucket"], 0), r["rewritten"])
        for name, columns, r in sorted(out, key=lambda x: (x[0], x[2]["bucket"]))
    ]
    return spark.createDataFrame(rows, RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales, lines = table(spark, sf_dir, "sales"), table(spark, sf_dir, "sale_lines")
    b = hashed_bucket(F.col("sale_id"))
    item = F.coalesce(F.crc32(F.col("item_id").cast("string").cast("binary")) % BUCKETS, F.lit(0))
    return co_bucket(spark, sales, lines, "sale_id", F.when(b % 3 == 1, b - 1).otherwise(b), item, ("sales", "sale_lines"))
