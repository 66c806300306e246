"""Who has read what the plan asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.reading_plan import EMOJI, NO_READING, headers
from .numbering import numbered
from .progress import last_read

CHAPTER = "array<struct<book_name:string,chapter:int>>"


def compliance(pairs: DataFrame, chapters: DataFrame, progress: DataFrame) -> DataFrame:
    """For each (sender, date): assigned, completed, missing (in plan order), completion_rate, is_complete. Nothing assigned is complete."""
    read = progress.select(F.col("sender").alias("p_sender"), F.col("date_read").alias("p_date"), F.col("book_name").alias("p_book"), F.col("chapter").alias("p_chapter")).distinct()
    asked = pairs.join(chapters, "date", "left")
    on = [asked["sender"] == read["p_sender"], asked["date"] == read["p_date"], asked["book_name"] == read["p_book"], asked["chapter"] == read["p_chapter"]]
    met = asked.join(read, on, "left")
    done, there = F.col("p_chapter").isNotNull(), F.col("chapter").isNotNull()
    item = F.struct("row_no", "seq", "book_name", "chapter")
    g = met.groupBy("sender", "date").agg(
        F.count_if(there).alias("assigned"),
        F.count_if(there & done).alias("completed"),
        F.array_sort(F.collect_list(F.when(there & ~done, item))).alias("m"),
    )
    missing = F.transform("m", lambda x: F.struct(x["book_name"].alias("book_name"), x["chapter"].alias("chapter")))
    rate = F.when(F.col("assigned") == 0, 1.0).otherwise(F.round(F.col("completed") / F.col("assigned"), 3))
    return g.select("sender", "date", "assigned", "completed", missing.cast(CHAPTER).alias("missing"), rate.alias("completion_rate"), (F.size("m") == 0).alias("is_complete"))


def check_member(chapters: DataFrame, progress: DataFrame, sender: str, date) -> DataFrame:
    """One row, for unknown members too."""
    one = progress.sparkSession.range(1).select(F.lit(sender).alias("sender"), F.lit(date).cast("date").alias("date"))
    return compliance(one, chapters, progress)


def check_all(chapters: DataFrame, progress: DataFrame, date=None) -> DataFrame:
    """Members with a read chapter on the date; every date with reads when none is given."""
    who = progress.select("sender", F.col("date_read").alias("date")).distinct()
    return compliance(who if date is None else who.where(F.col("date") == F.lit(date).cast("date")), chapters, progress)


def summarize(members: DataFrame, chapters: DataFrame, emoji: DataFrame, progress: DataFrame, date) -> DataFrame:
    """line_no, line: the day's header, then every member by name with the day's emoji or the last chapter read."""
    day = F.lit(date).cast("date")
    who = members.select(F.col("name").alias("sender"))
    state = compliance(who.withColumn("date", day), chapters, progress).select("sender", ((F.col("assigned") > 0) & F.col("is_complete")).alias("done"))
    last = last_read(progress.select("sender", "date_read", "book_id", "chapter"), day)
    names = progress.select("book_id", "book_name").distinct()
    last = last.join(F.broadcast(names), "book_id").select("sender", F.concat(F.left("book_name", F.lit(3)), F.lit(" "), F.col("chapter")).alias("at"))
    spark = members.sparkSession
    marks = spark.range(1).select(day.alias("date")).join(emoji, "date", "left").join(headers(chapters), "date", "left")
    marks = marks.select(F.coalesce("emoji", F.lit(EMOJI)).alias("mark"), F.coalesce("header", F.lit(NO_READING)).alias("header"))
    rows = who.join(state, "sender").join(last, "sender", "left").join(F.broadcast(marks.select("mark")).withColumn("one", F.lit(1)), F.lit(1) == F.col("one"))
    told = F.when(F.col("done"), F.col("mark")).otherwise(F.coalesce("at", F.lit("")))
    body = numbered(rows, "line_no", "sender").select("line_no", F.concat(F.col("line_no").cast("string"), F.lit(". "), F.col("sender"), F.lit(" "), told).alias("line"))
    return marks.select(F.lit(0).alias("line_no"), F.col("header").alias("line")).unionByName(body)
