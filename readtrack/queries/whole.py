"""From chat exports to reading progress and the day's report, end to end.

Each event is a message of running text: its event id chooses what it says and how. References to several books in one
message, numbered and doubled books, verses that cross chapters, ranges in words and over books, whole books, second lines,
unknown books, small talk and lines of the system occur. The SQL knows what each message means and reads no text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import run
from ..catalog import books, chapters_of
from ..sources.chat import parse_files
from ..sources.shared import new_folder
from .domain import MESSAGES, PLAN, messages, plan
from .reading import HEADER

DAY = "2024-01-14"


def chats(s, d):
    """Messages of sixteen chats, written as Android exports (a file each, in order) and read in ranges; each member writes in one."""
    m = messages(s, d)
    names = F.array(*[F.lit(b[1].lower()) for b in books()])
    own, t = F.get(names, F.col("book_id") - 1), F.col("seq") % 8
    after = F.col("book_id") % 66
    more, more_chapters = F.get(names, after), chapters_of((after + 1).cast("int"))
    several = F.col("last") > F.col("first")
    joined = lambda a, mark, b="": F.concat("alias", F.lit(" "), "first", F.lit(a), F.lit(mark), "last", F.lit(b))
    plain = F.when(several, joined("", "-")).otherwise(own)
    said = (
        F.when(t == 0, F.concat(F.lit("sudah baca "), plain, F.lit(" ya \U0001f64f")))
        .when(t == 1, F.concat(plain, F.lit(" lalu "), more, F.when(more_chapters > 1, F.lit(" 1-2")).otherwise("")))
        .when(t == 2, F.concat(F.when(several, joined(":3", " - ", ":4")).otherwise(own), F.lit(" amin")))
        .when(t == 3, F.when(several, joined("", " sampai ")).otherwise(F.upper(own)))
        .when(t == 4, F.lit("halo semua, apa kabar?"))
        .when(t == 5, F.when(F.col("book_id") < 66, F.concat(own, F.lit(" "), chapters_of(F.col("book_id")), F.lit(" - "), more, F.lit(" 1"))).otherwise(own))
        .when(t == 6, F.concat(F.lit("*"), plain, F.lit("*\nselesai semua")))
        .otherwise(F.lit("qqqq 3 selesai"))
    )
    line = F.concat(F.date_format("timestamp", "d/M/yy, H:mm"), F.lit(" - "), "sender", F.lit(": "), said)
    user = F.regexp_extract("sender", r"\d+", 0).cast("int")
    told = m.select((user % 16).alias("chat"), "timestamp", "seq", line.alias("value")).where("value is not null")
    start = s.range(16).select(F.col("id").cast("int").alias("chat"), F.lit(None).cast("timestamp_ntz").alias("timestamp"), F.lit(None).cast("long").alias("seq"), F.lit("1/1/24, 0:00 - Grup dibuat").alias("value"))
    folder = new_folder(s, "exports")
    told.unionByName(start).repartition(16, "chat").sortWithinPartitions("chat", "timestamp", "seq").select("chat", "value").write.partitionBy("chat").text(folder)
    return parse_files(s, folder)


def progress_of_chats(s, d):
    return run.progress.progress_of(run.read_messages(chats(s, d))).select("sender", "book_id", "chapter", "date_read")


QUERIES = {
    "chats_to_progress": progress_of_chats,
    "chats_to_report": lambda s, d: run.report_messages(chats(s, d), plan(s, d), DAY),
}

#: Of messages of one sender and minute the first counts; what is read twice counts once.
DONE = f"""WITH {MESSAGES}, {PLAN},
firsts AS (SELECT *, row_number() OVER (PARTITION BY sender, date_trunc('minute', "timestamp") ORDER BY "timestamp", seq) AS nth FROM msgs),
kept AS (SELECT m.*, CAST(m."timestamp" AS DATE) AS day, seq % 8 AS t, last > first AS several, c.book_id AS more_id, c.chapters AS more_chapters
  FROM firsts m JOIN cat c ON c.book_id = m.book_id % 66 + 1 WHERE nth = 1),
said AS (
  SELECT sender, day, book_id, CASE WHEN several THEN first ELSE 1 END AS a, CASE WHEN several THEN last ELSE chapters END AS b FROM kept WHERE t IN (0, 1, 2, 3, 6)
  UNION ALL SELECT sender, day, more_id, 1, least(2, more_chapters) FROM kept WHERE t = 1 AND more_chapters > 1
  UNION ALL SELECT sender, day, more_id, 1, 1 FROM kept WHERE t = 1 AND more_chapters = 1
  UNION ALL SELECT sender, day, book_id, chapters, chapters FROM kept WHERE t = 5 AND book_id < 66
  UNION ALL SELECT sender, day, more_id, 1, 1 FROM kept WHERE t = 5 AND book_id < 66
  UNION ALL SELECT sender, day, book_id, 1, chapters FROM kept WHERE t = 5 AND book_id = 66
),
each AS (SELECT sender, day, book_id, unnest(range(a, b + 1)) AS chapter FROM said),
pr AS (SELECT sender, CAST(e.book_id AS INTEGER) AS book_id, c.name AS book_name, CAST(chapter AS INTEGER) AS chapter, min(day) AS date_read
  FROM each e JOIN cat c USING (book_id) GROUP BY 1, 2, 3, 4)"""
SQL = {
    "chats_to_progress": f"{DONE} SELECT sender, book_id, chapter, date_read FROM pr",
    "chats_to_report": f"""{DONE}, day AS (SELECT DATE '{DAY}' AS d), who AS (SELECT DISTINCT sender FROM msgs),
lastr AS (SELECT sender, left(book_name, 3) || ' ' || chapter AS pos FROM (SELECT *, row_number() OVER (PARTITION BY sender ORDER BY date_read DESC, book_id DESC, chapter DESC) AS rn FROM pr, day WHERE date_read <= d) WHERE rn = 1),
st AS (SELECT w.sender, bool_and(pr.sender IS NOT NULL) AS done FROM who w JOIN day ON true JOIN chap c ON c.date = d
  LEFT JOIN pr ON pr.sender = w.sender AND pr.date_read = d AND pr.book_name = c.book_name AND pr.chapter = c.chapter GROUP BY w.sender),
numbered AS (SELECT row_number() OVER (ORDER BY sender) AS n, sender, done, pos FROM st LEFT JOIN lastr USING (sender))
SELECT 0 AS line_no, {HEADER} AS line FROM chap, day WHERE date = d
UNION ALL SELECT CAST(n AS INTEGER), n || '. ' || sender || ' ' || CASE WHEN done THEN (SELECT CASE WHEN i % 3 = 0 THEN chr(128214) ELSE chr(128165) END FROM pl, day WHERE date = d) ELSE coalesce(pos, '') END FROM numbered""",
}
