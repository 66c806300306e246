"""The dated reading plan, expanded to chapters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import book_table, chapters_of, name_of
from ..operators.progress import chapter_list

EMOJI = "\U0001f4a5"


def expand_plan(plan: DataFrame) -> DataFrame:
    """date, day, row_no, seq, book_id, book_name, chapter, in file order (row_no); duplicates stay.

    A row of two books without an end chapter runs to the end of its end book. Rows with an unknown start book give nothing.
    """
    spark = plan.sparkSession
    ids = book_table(spark).select("book_id", F.lower("name").alias("key"))
    s, e = (F.broadcast(ids.select(F.col("book_id").alias(f"{x}_id"), F.col("key").alias(f"{x}_key"))) for x in "se")
    p = plan.join(s, F.lower(F.trim("book_start")) == F.col("s_key")).join(e, F.lower(F.trim("book_end")) == F.col("e_key"), "left")
    one = F.col("e_id").isNull() | (F.col("e_id") == F.col("s_id"))
    end_id = F.when(one, F.col("s_id")).otherwise(F.col("e_id"))
    end = F.when(one, F.coalesce("end_chapter", "start_chapter")).otherwise(F.coalesce("end_chapter", chapters_of(F.col("e_id"))))
    rows = p.select("date", "day", "row_no", F.posexplode(chapter_list(F.col("s_id"), F.col("start_chapter"), end_id, end)).alias("seq", "c"))
    return rows.select("date", "day", "row_no", "seq", "c.book_id", name_of(F.col("c.book_id")).alias("book_name"), "c.chapter")


def plan_emoji(plan: DataFrame, default: str = EMOJI) -> DataFrame:
    """date, emoji: the first row's, trimmed; the default where it is missing."""
    first = plan.groupBy("date").agg(F.min_by(F.struct(F.col("emoji").alias("e")), "row_no").alias("f"))
    return first.select("date", F.coalesce(F.nullif(F.trim("f.e"), F.lit("")), F.lit(default)).alias("emoji"))


def by_date(chapters: DataFrame, date) -> DataFrame:
    return chapters.where(F.col("date") == F.lit(date)).orderBy("row_no", "seq")


def by_day(chapters: DataFrame, day: int) -> DataFrame:
    return chapters.where(F.col("day") == day).orderBy("row_no", "seq")


def dates(plan: DataFrame) -> DataFrame:
    return plan.select("date").distinct().orderBy("date")


def total_days(plan: DataFrame) -> DataFrame:
    return plan.agg(F.countDistinct("day").alias("total_days"))


def headers(chapters: DataFrame) -> DataFrame:
    """date, header: "Abc 1", "Abc 1 - 3" or "Abc 50 - Xyz 2" (names by their first three characters)."""
    at = F.struct("row_no", "seq")
    first, last = F.min_by(F.struct("book_name", "chapter"), at), F.max_by(F.struct("book_name", "chapter"), at)
    g = chapters.groupBy("date").agg(first.alias("f"), last.alias("l"), F.count("*").alias("n"), F.countDistinct("book_name").alias("b"))
    short = lambda s: F.concat(F.left(F.col(f"{s}.book_name"), F.lit(3)), F.lit(" "), F.col(f"{s}.chapter"))
    header = F.when(F.col("b") > 1, F.concat(short("f"), F.lit(" - "), short("l"))).when(F.col("n") > 1, F.concat(short("f"), F.lit(" - "), F.col("l.chapter"))).otherwise(short("f"))
    return g.select("date", header.alias("header"))


NO_READING = "No reading scheduled"
