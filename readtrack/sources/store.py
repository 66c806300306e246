"""The persisted tables: members, messages, references, reading progress. Keys are natural; uniqueness is kept by the writers.

A batch is all or nothing. Its rows carry its name in every table and are seen only once the batch is in the log of
commits: a folder of numbered files, the next of which only one writer can create. A batch that breaks off leaves rows that no
reader sees; one that another batch overtook begins anew on what that batch left.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import progress
from .shared import kept

TABLES = {
    "members": "name STRING",
    "messages": "sender STRING, timestamp TIMESTAMP_NTZ, seq BIGINT, raw_text STRING, processed_at TIMESTAMP",
    "refs": "sender STRING, timestamp TIMESTAMP_NTZ, seq BIGINT, ord INT, book_start STRING, start_chapter INT, book_end STRING, end_chapter INT, is_valid BOOLEAN",
    "reading_progress": "sender STRING, book_id INT, book_name STRING, chapter INT, date_read DATE, seq BIGINT, ord INT",
}
TRIES = 5


class Log:
    """The database's commits: file n holds the name of the n-th batch. One that holds none is of a writer that broke off."""

    def __init__(self, spark: SparkSession, database: str):
        place = spark.sql(f"DESCRIBE DATABASE {database}").where("info_name = 'Location'").first()["info_value"]
        self.spark, self.path = spark, f"{place}/_commits"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self.fs.mkdirs(self._path(self.path))

    def next(self) -> int:
        return len(self.fs.listStatus(self._path(self.path)))

    def batches(self, before: int) -> DataFrame:
        """(batch): the names in the files up to a number."""
        files = [f"{self.path}/{n:012d}" for n in range(before)]
        if not files:
            return self.spark.createDataFrame([], "batch string")
        return self.spark.read.text(files).select(F.col("value").alias("batch"))

    def add(self, n: int, batch: str) -> bool:
        """False where another batch is the n-th already: the file system lets one writer create a file."""
        try:
            out = self.fs.create(self._path(f"{self.path}/{n:012d}"), False)
        except Exception as e:
            if "exist" in str(e).lower():
                return False
            raise
        out.write(bytearray(batch.encode()))
        out.close()
        return True


def create_tables(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, columns in TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}, batch STRING) USING parquet")


def stored(spark: SparkSession, database: str, name: str, before: int | None = None) -> DataFrame:
    """A table's rows of committed batches (those of the log's first `before`)."""
    log = Log(spark, database)
    return spark.table(f"{database}.{name}").join(log.batches(log.next() if before is None else before), "batch", "left_semi").drop("batch")


def store_batch(database: str, messages: DataFrame, refs: DataFrame, processed_at: Column | None = None) -> str | None:
    """Stores a batch: new members and messages, valid references, chapters read for the first time. Its name, or None if there is nothing new.

    What is new is worked out once and kept for all tables. messages: seq, sender, timestamp, message; refs: what `persist` gives, with book_start and book_end.
    """
    spark = messages.sparkSession
    log = Log(spark, database)
    for _ in range(TRIES):
        n, batch = log.next(), uuid.uuid4().hex
        have = {t: stored(spark, database, t, n) for t in TABLES}
        pending = kept(progress.pending(messages, have["messages"]), "pending")
        if pending.isEmpty():
            return None
        own = pending.select("sender", "seq").distinct()
        mine = kept(refs.join(own, ["sender", "seq"], "left_semi"), "mine")
        fresh = {
            "members": progress.new_members(pending, have["members"]),
            "refs": mine.where("is_valid").join(have["refs"].select("sender", "seq", "ord"), ["sender", "seq", "ord"], "left_anti"),
            "reading_progress": progress.progress_of(mine, have["reading_progress"]),
            "messages": progress.new_messages(pending.select("seq", "sender", "timestamp", F.col("message").alias("raw_text")), have["messages"]).withColumn(
                "processed_at", processed_at if processed_at is not None else F.current_timestamp()
            ),
        }
        for name, rows in fresh.items():
            table = f"{database}.{name}"
            rows.withColumn("batch", F.lit(batch)).select(*spark.table(table).columns).write.insertInto(table)
        if log.add(n, batch):
            return batch
    raise RuntimeError(f"{TRIES} other batches came first")


def members(spark: SparkSession, database: str) -> DataFrame:
    return stored(spark, database, "members")


def unprocessed(messages: DataFrame) -> DataFrame:
    return messages.where("processed_at is null")


def progress_by_date(table: DataFrame, date, sender: str | None = None) -> DataFrame:
    out = table.where(F.col("date_read") == F.lit(date).cast("date"))
    return out if sender is None else out.where(F.col("sender") == sender)
