"""Chats as streams: files arrive whole, messages are processed once, members' gaps are filled as they write."""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import date
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..catalog import books
from ..operators.progress import PERSISTED, USABLE, Reader, new_messages
from ..sources.chat import decoded, parse_chats

#: Fixed value: more than a book has chapters.
CANON = 1000


def stream_chats(spark: SparkSession, path: str) -> DataFrame:
    """(file, content) of each chat export that arrives in the folder."""
    raw = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(path)
    return raw.select(F.col("path").alias("file"), decoded(F.col("content")).alias("content"))


def store_messages(chats: DataFrame, path: str, checkpoint: str):
    """Starts a query that appends each batch's new messages to the parquet table at `path`; a message stored before is left out."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        messages = parse_chats(batch).withColumnRenamed("msg_seq", "seq")
        try:
            stored = spark.read.parquet(path).where(F.col("batch") < batch_id)
        except Exception as e:  # the table begins with the first batch
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            stored = None
        if stored is not None:  # only what lies in the batch's own time can be in it again
            first, last = messages.agg(F.min("timestamp"), F.max("timestamp")).first()
            stored = stored.where(F.col("timestamp").between(*(F.lit(x.isoformat(" ")).cast("timestamp_ntz") for x in (first, last)))) if first else stored.limit(0)
        fresh = new_messages(messages, stored).withColumn("batch", F.lit(batch_id))
        # A repeated batch replaces its own partition, so it is stored once.
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    return chats.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def fill_gaps(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A batch's references of a bucket of members, their gaps filled. State, as JSON: of each member the chapters read so far by day (at most the canon's)."""
    known = json.loads(state.get[0]) if state.exists else {}
    chapters, out = {b[0]: b[2] for b in books()}, []
    for sender, rows in groupby(pd.concat(list(frames)).sort_values(["sender", "seq", "ord"]).itertuples(index=False), lambda r: r.sender):
        read = {divmod(c, CANON): date.fromisoformat(day) for day, found in known.get(sender, {}).items() for c in found}
        reader = Reader(read)
        out += [reader.take(r, chapters) for r in rows]
        days: dict[str, list[int]] = {}
        for (book, chapter), day in reader.read.items():
            days.setdefault(day.isoformat(), []).append(book * CANON + chapter)
        known[sender] = days
    state.update((json.dumps(known),))
    yield pd.DataFrame(out, columns=[c.split()[0] for c in PERSISTED.split(", ")])


def stream_persist(refs: DataFrame, buckets: int = 2048) -> DataFrame:
    """`persist` over a stream of normalised references. Members share state in buckets of their hash, whose number holds for a checkpoint's life: Python is called once a bucket and batch, not once a member."""
    placed = refs.where(USABLE).withColumn("bucket", F.pmod(F.xxhash64("sender"), F.lit(buckets)))
    return placed.groupBy("bucket").applyInPandasWithState(fill_gaps, PERSISTED, "read string", "append", GroupStateTimeout.NoTimeout)


def resume_once(messages: DataFrame, delay: str = "1 day") -> DataFrame:
    """Messages of a stream once each by (sender, timestamp), as far back as the delay."""
    at = messages.withColumn("event_time", F.col("timestamp").cast("timestamp")).withWatermark("event_time", delay)
    return at.dropDuplicatesWithinWatermark(["sender", "timestamp"]).drop("event_time")
