"""Reading progress: ranges to chapters, first read wins, gaps filled member by member.

Inputs carry their order (seq: the message's place, ord: the reference's place in it).
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..catalog import books, chapters_of, name_of
from .asof import asof_join

PERSISTED = "sender string, seq long, ord int, timestamp timestamp_ntz, start_id int, start_chapter int, end_id int, end_chapter int, is_valid boolean, filled boolean"


def chapter_list(start_id: Column, start: Column, end_id: Column, end: Column) -> Column:
    """array<struct<book_id,chapter>> of a range; a range whose end book comes first runs to the last book."""
    last = F.when(start_id <= end_id, end_id).otherwise(F.lit(len(books())))

    def of_book(b):
        low = F.when(b == start_id, start).otherwise(1)
        high = F.when(b == end_id, end).otherwise(chapters_of(b))
        ids = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
        return F.transform(ids, lambda c: F.struct(b.alias("book_id"), c.alias("chapter")))

    return F.flatten(F.transform(F.sequence(start_id, last), of_book))


def expand(refs: DataFrame) -> DataFrame:
    """One row a chapter of each reference (start_id, start_chapter, end_id, end_chapter), its other columns kept."""
    chapters = chapter_list(F.col("start_id"), F.col("start_chapter"), F.col("end_id"), F.col("end_chapter"))
    rest = [c for c in refs.columns if c not in ("start_id", "start_chapter", "end_id", "end_chapter")]
    out = refs.select(*rest, F.posexplode(chapters).alias("pos", "c"))
    return out.select(*rest, "pos", "c.book_id", name_of(F.col("c.book_id")).alias("book_name"), "c.chapter")


def first_reads(read: DataFrame, order: list[str], known: DataFrame | None = None) -> DataFrame:
    """The first row of each (sender, book_id, chapter) by `order` that `known` doesn't hold yet."""
    key = ["sender", "book_id", "chapter"]
    rest = [c for c in read.columns if c not in key]
    by = F.struct(*order, *[c for c in rest if c not in order])
    first = read.groupBy(*key).agg(F.min(by).alias("first")).select(*key, "first.*").select(*read.columns)
    return first.join(known.select(*key), key, "left_anti") if known is not None else first


def new_members(messages: DataFrame, members: DataFrame | None = None) -> DataFrame:
    names = messages.where("sender is not null").select(F.col("sender").alias("name")).distinct()
    return names.join(members.select("name"), "name", "left_anti") if members is not None else names


def new_messages(messages: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """The first message of each (sender, timestamp), unless stored."""
    key = ["sender", "timestamp"]
    rest = [c for c in messages.columns if c not in key]
    first = messages.where("sender is not null and timestamp is not null").groupBy(*key).agg(F.min(F.struct("seq", *[c for c in rest if c != "seq"])).alias("f"))
    out = first.select(*key, "f.*").select(*messages.columns)
    return out.join(stored.select(*key), key, "left_anti") if stored is not None else out


def pending(messages: DataFrame, processed: DataFrame) -> DataFrame:
    """Messages whose (sender, timestamp) was not processed before; duplicates within the batch stay."""
    return messages.join(processed.select("sender", "timestamp").distinct(), ["sender", "timestamp"], "left_anti")


def rejected(messages: DataFrame) -> DataFrame:
    return messages.where("sender is null or timestamp is null")


def gap_fill(refs: DataFrame, last_book: str, last_chapter: str) -> DataFrame:
    """Single chapters of the last read book that lie beyond its next chapter start at that next chapter."""
    fits = (F.col("start_id") == F.col("end_id")) & (F.col("start_chapter") == F.col("end_chapter")) & (F.col(last_book) == F.col("start_id")) & (F.col(last_chapter) + 1 < F.col("start_chapter"))
    return refs.withColumn("start_chapter", F.when(F.coalesce(fits, F.lit(False)), F.col(last_chapter) + 1).otherwise(F.col("start_chapter")))


def last_read(progress: DataFrame, until: Column | None = None) -> DataFrame:
    """Each sender's last chapter by date, book and chapter, on or before `until`."""
    p = progress.where(F.col("date_read") <= until) if until is not None else progress
    best = F.max(F.struct("date_read", "book_id", "chapter")).alias("b")
    return p.groupBy("sender").agg(best).select("sender", "b.*")


def last_read_at(progress: DataFrame, probes: DataFrame, date: str = "date") -> DataFrame:
    """`probes` (sender, a date, further columns) with each sender's last chapter on or before that date: for many dates at once."""
    return asof_join(probes, progress, ["sender"], date, "date_read", ["date_read", "book_id", "chapter"], ["book_id", "chapter"])


class Reader:
    """One member's state: at most a row a chapter of the canon."""

    def __init__(self, read: dict[tuple[int, int], object] | None = None):
        self.message, self.reference = None, None
        self.read: dict[tuple[int, int], object] = {}
        self.by_date: dict[object, tuple[int, int]] = {}
        self.days: list = []  # ascending
        for chapter, day in (read or {}).items():
            self.mark(chapter, day)

    def mark(self, chapter: tuple[int, int], day) -> None:
        self.read[chapter] = day
        if day not in self.by_date:
            insort(self.days, day)
        self.by_date[day] = max(self.by_date.get(day, (0, 0)), chapter)

    def last(self, day) -> tuple[int, int] | None:
        at = bisect_right(self.days, day)
        return self.by_date[self.days[at - 1]] if at else None

    def add(self, day, start: tuple[int, int], end: tuple[int, int], chapters: dict[int, int]) -> None:
        for book in range(start[0], (end[0] if start[0] <= end[0] else len(chapters)) + 1):
            for ch in range(start[1] if book == start[0] else 1, (end[1] if book == end[0] else chapters[book]) + 1):
                if (book, ch) not in self.read:
                    self.mark((book, ch), day)

    def take(self, r, chapters: dict[int, int]) -> tuple:
        """A row of PERSISTED from the member's next reference (a row of its fields), its gap filled."""
        day = r.timestamp.date()
        if r.seq != self.message:
            self.message, self.reference = r.seq, self.last(day)
        start, end, filled = (int(r.start_id), int(r.start_chapter)), (int(r.end_id), int(r.end_chapter)), False
        if r.is_valid:
            last = self.reference
            if start == end and last and last[0] == start[0] and last[1] + 1 < start[1]:
                start, filled = (start[0], last[1] + 1), True
            self.reference = end
            self.add(day, start, end, chapters)
        return (r.sender, r.seq, r.ord, r.timestamp, *start, *end, r.is_valid, filled)


USABLE = " and ".join(f"{c} is not null" for c in ("sender", "timestamp", "start_id", "start_chapter", "end_id", "end_chapter"))


def unusable(refs: DataFrame) -> DataFrame:
    """References that `persist` leaves out: without a sender, a time, a book or a chapter."""
    return refs.where(f"not ({USABLE})")


def persist(refs: DataFrame) -> DataFrame:
    """Normalised references (sender, seq, ord, timestamp, ids, chapters, is_valid) with their gaps filled, in each member's order.

    A message's first reference looks back to the last chapter read by its date; each later one to
    the reference before it. Members stream by in order, so only one member's chapters are held.
    """
    chapters = {b[0]: b[2] for b in books()}
    names = [c.split()[0] for c in PERSISTED.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sender, reader = None, Reader()
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                if r.sender != sender:
                    sender, reader = r.sender, Reader()
                rows.append(reader.take(r, chapters))
            yield pd.DataFrame(rows, columns=names)

    r = refs.where(USABLE)
    r = r.select("sender", "seq", "ord", "timestamp", "start_id", "start_chapter", "end_id", "end_chapter", "is_valid")
    return r.repartition("sender").sortWithinPartitions("sender", "seq", "ord").mapInPandas(run, PERSISTED)


def progress_of(persisted: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """sender, book_id, book_name, chapter, date_read, seq, ord: first reads of valid references."""
    read = expand(persisted.where("is_valid")).withColumn("date_read", F.to_date("timestamp"))
    cols = ["sender", "book_id", "book_name", "chapter", "date_read", "seq", "ord"]
    return first_reads(read.select(*cols), ["seq", "ord"], known)


def totals(messages: DataFrame, processed: DataFrame, persisted: DataFrame) -> DataFrame:
    """refs, chapters_attempted, chapters_new, skipped, resumed of a batch."""
    ok = persisted.where("is_valid")
    size = F.size(chapter_list(F.col("start_id"), F.col("start_chapter"), F.col("end_id"), F.col("end_chapter")))
    refs = persisted.agg(F.count_if("is_valid").alias("refs"), F.coalesce(F.sum(F.when(F.col("is_valid"), size)), F.lit(0)).alias("chapters_attempted"), F.count_if(~F.col("is_valid")).alias("skipped"))
    new = progress_of(ok).agg(F.count("*").alias("chapters_new"))
    resumed = messages.join(processed.select("sender", "timestamp").distinct(), ["sender", "timestamp"], "left_semi").agg(F.count("*").alias("resumed"))
    one = lambda df: df.withColumn("one", F.lit(1))  # noqa: E731  each has one row
    return one(refs).join(one(new), "one").join(one(resumed), "one").drop("one")


def running_last(refs: DataFrame) -> DataFrame:
    """For streams of new chapters alone: the reference before, by window; equal to `persist` where nothing is read twice."""
    w = Window.partitionBy("sender").orderBy("seq", "ord")
    return refs.withColumn("last_book", F.lag("end_id").over(w)).withColumn("last_chapter", F.lag("end_chapter").over(w))
