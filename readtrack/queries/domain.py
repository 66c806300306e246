"""Chat data derived from the driver's tables, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import books, books_sql, chapters_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, sender, timestamp, message ("kej 3-5") and what it says (book_id, first, last) from events."""
    e = table(spark, sf_dir, "events")
    known = F.array(*[F.array(*[F.lit(a) for a in b[3]]) for b in books()])
    m = e.select(
        F.col("event_id").alias("seq"), F.concat(F.lit("user_"), F.col("user_id")).alias("sender"), F.col("ts").alias("timestamp"),
        (F.col("event_id") % 66 + 1).cast("int").alias("book_id"), "event_type",
    )
    c = chapters_of(F.col("book_id"))
    m = m.withColumn("first", (F.col("seq") % c + 1).cast("int")).withColumn("last", F.least(F.col("first") + F.col("seq") % 3, c).cast("int"))
    own = F.get(known, F.col("book_id") - 1)
    alias = F.get(own, (F.col("seq") % F.size(own)).cast("int"))
    text = F.concat(alias, F.lit(" "), F.col("first"), F.when(F.col("last") > F.col("first"), F.concat(F.lit("-"), F.col("last"))).otherwise(""))
    return m.withColumn("alias", alias).withColumn("message", text)


def refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, ord, sender, timestamp, start_id, start_chapter, end_id, end_chapter, is_valid as the messages mean them."""
    m = messages(spark, sf_dir)
    return m.select("seq", F.lit(0).alias("ord"), "sender", "timestamp", F.col("book_id").alias("start_id"), F.col("first").alias("start_chapter"), F.col("book_id").alias("end_id"), F.col("last").alias("end_chapter"), F.lit(True).alias("is_valid"))


MESSAGES = f"""{books_sql()},
raw AS (SELECT event_id AS seq, 'user_' || user_id AS sender, ts AS "timestamp", CAST(event_id % 66 + 1 AS INTEGER) AS book_id, event_type FROM events),
msg AS (
  SELECT r.*, c.name, c.chapters, c.aliases[CAST(seq % len(c.aliases) AS INTEGER) + 1] AS alias, CAST(seq % c.chapters + 1 AS INTEGER) AS first,
         CAST(least(seq % c.chapters + 1 + seq % 3, c.chapters) AS INTEGER) AS last
  FROM raw r JOIN cat c USING (book_id)
),
msgs AS (SELECT *, alias || ' ' || first || CASE WHEN last > first THEN '-' || last ELSE '' END AS message FROM msg)"""


def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each day on which somebody wrote: two chapters of a book or, each seventh day, the end of one book and the start of the next."""
    d = table(spark, sf_dir, "events").select(F.date_diff(F.to_date("ts"), F.lit("2024-01-01")).alias("i")).distinct()
    b = (F.col("i") * 2 % 65 + 1).cast("int")
    names = F.array(*[F.lit(x[1]) for x in books()])
    cross = F.col("i") % 7 == 6
    start = F.when(cross, chapters_of(b)).otherwise(1).cast("int")
    return d.select(
        (F.col("i") + 1).alias("day"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")).alias("date"), F.get(names, b - 1).alias("book_start"), start.alias("start_chapter"),
        F.when(cross, F.get(names, b)).alias("book_end"), F.when(cross, 1).otherwise(F.least(F.lit(2), chapters_of(b))).cast("int").alias("end_chapter"),
        F.when(F.col("i") % 3 == 0, F.lit("\U0001f4d6")).alias("emoji"), F.col("i").cast("long").alias("row_no"),
    )


PLAN = """
days AS (SELECT CAST(i AS INTEGER) AS i, CAST(i * 2 % 65 + 1 AS INTEGER) AS b FROM (SELECT DISTINCT CAST(ts AS DATE) - DATE '2024-01-01' AS i FROM events)),
pl AS (
  SELECT i, CAST(DATE '2024-01-01' + i AS DATE) AS date, i + 1 AS day, b, i % 7 = 6 AS crosses, s.name AS s_name, s.chapters AS s_chapters, e.name AS e_name
  FROM days JOIN cat s ON s.book_id = b JOIN cat e ON e.book_id = b + 1
),
chap AS (
  SELECT date, day, i AS row_no, 0 AS seq, b AS book_id, s_name AS book_name, CASE WHEN crosses THEN s_chapters ELSE 1 END AS chapter FROM pl
  UNION ALL SELECT date, day, i, 1, b + 1, e_name, 1 FROM pl WHERE crosses
  UNION ALL SELECT date, day, i, 1, b, s_name, 2 FROM pl WHERE NOT crosses AND s_chapters > 1
)"""

PROGRESS = """
reads AS (SELECT sender, book_id, name AS book_name, unnest(range(first, last + 1)) AS chapter, CAST("timestamp" AS DATE) AS date_read, seq FROM msgs),
progress AS (
  SELECT sender, book_id, book_name, CAST(chapter AS INTEGER) AS chapter, date_read, seq FROM (
    SELECT *, row_number() OVER (PARTITION BY sender, book_id, chapter ORDER BY seq) AS rn FROM reads) WHERE rn = 1
)"""

#: A book as the grammar spells it: a digit stands apart, the halves of a doubled word are joined, a trailing 2 doubles the word.
SPELT = "regexp_replace(regexp_replace(replace(alias, ' - ', '-'), '^([0-9])([a-z])', '\\1 \\2'), '([a-z]+)2$', '\\1-\\1')"
