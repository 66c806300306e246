"""Books resolved, ranges expanded, gaps filled, plans compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import aliases, name_of
from ..operators import compliance, evaluate, grammar, progress, resolve
from ..plans import reading_plan
from .domain import MESSAGES, PLAN, PROGRESS, SPELT, messages, plan, refs, table


def raw(s, d):
    """Raw references as the grammar reads them, with keys."""
    m = messages(s, d)
    return m.select("seq", "sender", "timestamp", F.posexplode(grammar.parse_refs(F.array("message"))).alias("ord", "r")).select("seq", "sender", "timestamp", "ord", "r.*")


def odd(s, d):
    """Messages' books, one in five misspelt by a dropped or added letter, one in eleven unknown."""
    n = F.col("seq")
    key = F.when(n % 11 == 0, F.lit("qqqq")).when(n % 5 == 0, F.concat(F.col("alias"), F.lit("x"))).otherwise(F.upper("alias"))
    return messages(s, d).select("seq", key.alias("book"))


def misspelt(s, d):
    """Raw references to books, one in five misspelt and one in eleven unknown, and what they mean."""
    raw_ = odd(s, d).join(messages(s, d).select("seq", "first"), "seq").select("seq", F.lit(0).alias("pos"), F.col("book").alias("book_start"), F.col("first").alias("start_chapter"), F.lit(None).cast("string").alias("book_end"), F.lit(None).cast("int").alias("end_chapter"))
    name = name_of(F.col("book_id"))
    gold = messages(s, d).select("seq", F.lit(0).alias("pos"), name.alias("book_start"), F.col("first").alias("start_chapter"), name.alias("book_end"), F.col("first").alias("end_chapter"))
    return raw_, gold


def cross(s, d):
    """Ranges over two or three books, one in ten the wrong way round."""
    r = refs(s, d).select("seq", "start_id", "start_chapter", (F.col("start_id") + F.col("seq") % 3).alias("e"))
    end = F.when(F.col("seq") % 10 == 0, F.greatest(F.col("start_id") - 1, F.lit(1))).otherwise(F.least("e", F.lit(66))).cast("int")
    return r.select("seq", "start_id", "start_chapter", end.alias("end_id"), F.lit(1).alias("end_chapter"))


def normalised(s, d):
    n = F.col("seq") % 4
    m = messages(s, d).select(
        "seq", "sender", F.col("alias").alias("book_start"), F.when(n > 0, F.col("first")).alias("start_chapter"),
        F.when(n == 3, F.col("alias")).when(n == 2, F.lit("why")).alias("book_end"), F.when(n == 3, F.col("last") + 40).alias("end_chapter"),
    )
    return resolve.normalize(m, fuzzy=False)


NORMAL = f"""WITH {MESSAGES},
nn AS (SELECT *, seq % 4 AS n FROM msgs),
z AS (
  SELECT seq, sender, name AS book_start, CASE WHEN n > 0 THEN first ELSE 1 END AS start_chapter, CASE WHEN n = 2 THEN 'Wahyu' ELSE name END AS book_end,
         CASE n WHEN 0 THEN chapters WHEN 1 THEN first WHEN 2 THEN 22 ELSE last + 40 END AS end_chapter, book_id AS start_id, CASE WHEN n = 2 THEN 66 ELSE book_id END AS end_id, chapters, n
  FROM nn
), v AS (
  SELECT *, start_chapter >= 1 AND start_chapter <= chapters AND end_chapter <= CASE WHEN end_id = 66 THEN 22 ELSE chapters END
            AND (start_id <> end_id OR start_chapter <= end_chapter) AS is_valid FROM z
)"""


def ups(s, d):
    """Each member's new chapters alone: chapter numbers rise with the message number, in long histories beyond the book's own, so that none is read twice."""
    e = table(s, d, "events").select(F.col("event_id").alias("seq"), F.concat(F.lit("user_"), F.col("user_id")).alias("sender"), F.col("ts").alias("timestamp"))
    from pyspark.sql import Window

    k = F.row_number().over(Window.partitionBy("sender").orderBy("timestamp", "seq"))
    r = e.withColumn("k", k).withColumn("ch", (2 * F.col("k") + F.col("seq") % 2).cast("int"))
    return r.select("k", "sender", F.col("k").cast("long").alias("seq"), F.lit(0).alias("ord"), "timestamp", F.lit(19).alias("start_id"), F.col("ch").alias("start_chapter"), F.lit(19).alias("end_id"), F.col("ch").alias("end_chapter"), F.lit(True).alias("is_valid"))


UPS = """WITH e AS (SELECT event_id AS id, 'user_' || user_id AS sender, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
r AS (SELECT sender, k AS seq, CAST(2 * k + id % 2 AS INTEGER) AS ch FROM e),
l AS (SELECT *, lag(ch) OVER (PARTITION BY sender ORDER BY seq) AS last FROM r)"""


def reads(s, d):
    return progress.progress_of(refs(s, d))


def chapters(s, d):
    return reading_plan.expand_plan(plan(s, d))


def planned_reads(s, d):
    """Every member reads the day's first chapter on days that its number divides, all of it on every tenth day."""
    who = table(s, d, "events").select(F.concat(F.lit("user_"), F.col("user_id")).alias("sender"), F.col("user_id").alias("u")).distinct()
    step = F.col("u") % 5 + 1
    days = F.filter(F.sequence(F.lit(1), F.lit(30)), lambda x: (x % 10 == 0) | (x % step == 0))
    each = who.select("sender", F.explode(days).alias("r_day"))
    met = chapters(s, d).join(each, (F.col("day") == F.col("r_day")) & ((F.col("day") % 10 == 0) | (F.col("seq") == 0)))
    return met.select("sender", "book_id", "book_name", "chapter", F.col("date").alias("date_read"))


READS = """who AS (SELECT DISTINCT user_id AS u, 'user_' || user_id AS sender FROM events),
pr AS (SELECT sender, book_id, book_name, chapter, date AS date_read FROM chap JOIN who ON day % 10 = 0 OR (day % (u % 5 + 1) = 0 AND seq = 0))"""
ALL = f"""WITH {MESSAGES}, {PLAN}, {READS},
pairs AS (SELECT DISTINCT sender, date_read AS date FROM pr),
met AS (SELECT p.sender, p.date, c.row_no, c.seq, c.book_name, c.chapter, pr.sender IS NOT NULL AS done FROM pairs p JOIN chap c ON c.date = p.date
  LEFT JOIN pr ON pr.sender = p.sender AND pr.date_read = p.date AND pr.book_name = c.book_name AND pr.chapter = c.chapter),
g AS (SELECT sender, date, count(*) AS assigned, count(*) FILTER (done) AS completed,
  coalesce(string_agg(book_name || ' ' || chapter, ', ' ORDER BY row_no, seq) FILTER (NOT done), '') AS missing FROM met GROUP BY sender, date)
SELECT sender, date, assigned, completed, missing, round(completed / assigned, 3) AS completion_rate, missing = '' AS is_complete FROM g"""


def flat(df):
    return df.withColumn("missing", F.array_join(F.transform("missing", lambda m: F.concat_ws(" ", m["book_name"], m["chapter"].cast("string"))), ", "))


def members(s, d):
    return table(s, d, "events").select(F.concat(F.lit("user_"), F.col("user_id")).alias("name")).distinct()


SUMMARY_DAY = "2024-01-14"
QUERIES = {
    "progress_per_member": lambda s, d: reads(s, d).groupBy("sender").agg(F.count("*").alias("chapters"), F.countDistinct("book_id").alias("books")),
    "alias_exact_join": lambda s, d: resolve.resolve(messages(s, d).select("seq", "alias"), "alias", "b", fuzzy=False).select("seq", "alias", F.col("b_id").alias("book_id"), F.col("b_method").alias("method")),
    "alias_fuzzy_join": lambda s, d: resolve.resolve(odd(s, d), "book", "b").select("seq", "book", F.col("b_id").alias("book_id"), F.col("b_method").alias("method"), F.col("b_score").alias("score")),
    "fuzzy_stress": lambda s, d: evaluate.stress(odd(s, d).select(F.col("book").alias("query"), F.lit(None).cast("int").alias("expected")).distinct()).select("query", "found", "method"),
    "norm_ablation_fuzzy": lambda s, d: evaluate.ablation(*misspelt(s, d), "seq"),
    "resolver_stats": lambda s, d: resolve.statistics(resolve.resolve(odd(s, d).withColumn("book", F.when(F.col("seq") % 5 == 0, "qqqq").otherwise(F.col("book"))), "book", "b", fuzzy=False), "b_method"),
    "normalize_refs": lambda s, d: normalised(s, d).select("seq", "sender", "book_start", "start_chapter", "book_end", "end_chapter", "is_valid"),
    "validate_refs": lambda s, d: normalised(s, d).groupBy("is_valid").agg(F.count("*").alias("n")),
    "expand_ranges": lambda s, d: progress.expand(refs(s, d)).select("seq", "book_id", "book_name", "chapter"),
    "expand_cross_book": lambda s, d: progress.expand(cross(s, d)).groupBy("seq").agg(F.count("*").alias("chapters"), F.min("book_id").alias("first_book"), F.max("book_id").alias("last_book"), F.sum("chapter").alias("chapter_sum")),
    "progress_dedupe": lambda s, d: reads(s, d).select("sender", "book_id", "book_name", "chapter", "date_read", "seq"),
    "resume_anti_join": lambda s, d: progress.pending(messages(s, d), messages(s, d).where("seq % 3 = 0")).select("seq", "sender", "timestamp"),
    "member_upsert": lambda s, d: progress.new_members(messages(s, d), messages(s, d).where("seq < 100").select(F.col("sender").alias("name"))),
    "message_upsert": lambda s, d: progress.new_messages(messages(s, d).select("seq", "sender", F.date_trunc("HOUR", "timestamp").cast("timestamp_ntz").alias("timestamp"), "message")),
    "gap_fill": lambda s, d: progress.persist(ups(s, d)).select("sender", "seq", "start_chapter", "end_chapter", "filled"),
    "gap_fill_window": lambda s, d: progress.gap_fill(progress.running_last(ups(s, d)), "last_book", "last_chapter").select("sender", "seq", "start_chapter", "end_chapter"),
    "batch_totals": lambda s, d: progress.totals(messages(s, d), messages(s, d).where("seq % 3 = 0"), refs(s, d).withColumn("is_valid", F.col("seq") % 7 > 0)),
    "last_read_asof": lambda s, d: progress.last_read(reads(s, d).select("sender", "date_read", "book_id", "chapter"), F.lit("2024-01-20").cast("date")),
    "plan_expand": lambda s, d: chapters(s, d).select("date", "day", "book_id", "book_name", "chapter", "seq"),
    "plan_emoji": lambda s, d: reading_plan.plan_emoji(plan(s, d)),
    "plan_days": lambda s, d: reading_plan.total_days(plan(s, d)),
    "header_format": lambda s, d: reading_plan.headers(chapters(s, d)),
    "compliance_member": lambda s, d: flat(compliance.check_member(chapters(s, d), planned_reads(s, d), "user_3", SUMMARY_DAY)),
    "compliance_all": lambda s, d: flat(compliance.check_all(chapters(s, d), planned_reads(s, d))),
    "daily_summary": lambda s, d: compliance.summarize(members(s, d), chapters(s, d), reading_plan.plan_emoji(plan(s, d)), planned_reads(s, d), SUMMARY_DAY),
    "explode_refs": lambda s, d: raw(s, d).select("seq", "ord", "book_start", "start_chapter", "end_chapter"),
}

#: A book with one letter more: every name within it, or that it is within, matches wholly; the first of the catalogue wins.
NEAR = f"""WITH {MESSAGES},
al AS (SELECT book_id, a, row_number() OVER (ORDER BY book_id, k) AS o FROM (SELECT book_id, unnest(aliases) AS a, generate_subscripts(aliases, 1) AS k FROM cat)),
fz AS (SELECT alias, arg_min(al.book_id, o) AS near_id FROM (SELECT DISTINCT alias FROM msgs) JOIN al ON contains(alias || 'x', a) OR contains(a, alias || 'x') GROUP BY alias),
od AS (SELECT m.*, near_id, CASE WHEN seq % 11 = 0 THEN 'qqqq' WHEN seq % 5 = 0 THEN alias || 'x' ELSE upper(alias) END AS book,
  CASE WHEN seq % 11 = 0 THEN 'failed' WHEN seq % 5 = 0 THEN 'fuzzy' ELSE 'exact' END AS method FROM msgs m JOIN fz USING (alias))"""
FOUND = "CASE method WHEN 'fuzzy' THEN near_id WHEN 'exact' THEN book_id END"
ACCURATE = ", ".join(f"round(avg(CAST({x} AS INTEGER)), 4) AS {c}_accuracy" for x, c in (("found AND own", "book_start"), ("found", "start_chapter"), ("found AND own", "book_end"), ("found", "end_chapter")))
HEAD = "left(first(book_name ORDER BY row_no, seq), 3) || ' ' || first(chapter ORDER BY row_no, seq)"
TAIL_BOOK = "left(last(book_name ORDER BY row_no, seq), 3) || ' '"
TAIL = "last(chapter ORDER BY row_no, seq)"
HEADER = f"CASE WHEN count(DISTINCT book_name) > 1 THEN {HEAD} || ' - ' || {TAIL_BOOK} || {TAIL} WHEN count(*) > 1 THEN {HEAD} || ' - ' || {TAIL} ELSE {HEAD} END"
SQL = {
    "progress_per_member": f"WITH {MESSAGES}, {PROGRESS} SELECT sender, count(*) AS chapters, count(DISTINCT book_id) AS books FROM progress GROUP BY sender",
    "alias_exact_join": f"WITH {MESSAGES} SELECT seq, alias, book_id, 'exact' AS method FROM msgs",
    "alias_fuzzy_join": f"{NEAR} SELECT seq, book, {FOUND} AS book_id, method, CASE WHEN method <> 'failed' THEN 100.0 END AS score FROM od",
    "fuzzy_stress": f"{NEAR} SELECT DISTINCT book AS query, {FOUND} AS found, method FROM od",
    "norm_ablation_fuzzy": f"""{NEAR},
st AS (SELECT 'exact' AS strategy, method = 'exact' AS found, true AS own FROM od UNION ALL SELECT 'fuzzy', method <> 'failed', coalesce({FOUND} = book_id, false) FROM od)
SELECT strategy, count(*) AS total, count(*) FILTER (found AND own) AS correct, count(*) FILTER (NOT found) AS skipped, round(avg(CAST(found AND own AS INTEGER)), 4) AS accuracy, {ACCURATE} FROM st GROUP BY strategy""",
    "resolver_stats": f"WITH {MESSAGES} SELECT CASE WHEN seq % 11 = 0 OR seq % 5 = 0 THEN 'failed' ELSE 'exact' END AS method, count(*) AS n FROM msgs GROUP BY 1",
    "normalize_refs": f"{NORMAL} SELECT seq, sender, book_start, CAST(start_chapter AS INTEGER) AS start_chapter, book_end, CAST(end_chapter AS INTEGER) AS end_chapter, is_valid FROM v",
    "validate_refs": f"{NORMAL} SELECT is_valid, count(*) AS n FROM v GROUP BY is_valid",
    "expand_ranges": f"WITH {MESSAGES} SELECT seq, book_id, name AS book_name, CAST(unnest(range(first, last + 1)) AS INTEGER) AS chapter FROM msgs",
    "expand_cross_book": f"""WITH {MESSAGES},
x AS (SELECT seq, book_id AS s, first, CAST(CASE WHEN seq % 10 = 0 THEN greatest(book_id - 1, 1) ELSE least(book_id + seq % 3, 66) END AS INTEGER) AS e FROM msgs),
y AS (SELECT seq, c.book_id, unnest(range(CASE WHEN c.book_id = s THEN first ELSE 1 END, 1 + CASE WHEN c.book_id = e THEN 1 ELSE c.chapters END)) AS ch
      FROM x JOIN cat c ON c.book_id >= s AND (c.book_id <= e OR s > e))
SELECT seq, count(*) AS chapters, min(book_id) AS first_book, max(book_id) AS last_book, CAST(sum(ch) AS BIGINT) AS chapter_sum FROM y GROUP BY seq""",
    "progress_dedupe": f"WITH {MESSAGES}, {PROGRESS} SELECT sender, book_id, book_name, chapter, date_read, seq FROM progress",
    "resume_anti_join": f"WITH {MESSAGES} SELECT seq, sender, \"timestamp\" FROM msgs m WHERE NOT EXISTS (SELECT 1 FROM msgs p WHERE p.seq % 3 = 0 AND p.sender = m.sender AND p.\"timestamp\" = m.\"timestamp\")",
    "member_upsert": "SELECT DISTINCT 'user_' || user_id AS name FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_id < 100)",
    "message_upsert": f"WITH {MESSAGES} SELECT seq, sender, \"timestamp\", message FROM (SELECT seq, sender, date_trunc('hour', \"timestamp\") AS \"timestamp\", message, row_number() OVER (PARTITION BY sender, date_trunc('hour', \"timestamp\") ORDER BY seq) AS rn FROM msgs) WHERE rn = 1",
    "gap_fill": f"{UPS} SELECT sender, seq, CAST(CASE WHEN last + 1 < ch THEN last + 1 ELSE ch END AS INTEGER) AS start_chapter, ch AS end_chapter, coalesce(last + 1 < ch, false) AS filled FROM l",
    "gap_fill_window": f"{UPS} SELECT sender, seq, CAST(CASE WHEN last + 1 < ch THEN last + 1 ELSE ch END AS INTEGER) AS start_chapter, ch AS end_chapter FROM l",
    "batch_totals": f"""WITH {MESSAGES}, ok AS (SELECT sender, book_id, unnest(range(first, last + 1)) AS chapter FROM msgs WHERE seq % 7 > 0)
SELECT (SELECT count(*) FROM msgs WHERE seq % 7 > 0) AS refs, (SELECT count(*) FROM ok) AS chapters_attempted, (SELECT count(*) FROM msgs WHERE seq % 7 = 0) AS skipped,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM ok)) AS chapters_new,
       (SELECT count(*) FROM msgs m WHERE EXISTS (SELECT 1 FROM msgs p WHERE p.seq % 3 = 0 AND p.sender = m.sender AND p."timestamp" = m."timestamp")) AS resumed""",
    "last_read_asof": f"WITH {MESSAGES}, {PROGRESS} SELECT sender, date_read, book_id, chapter FROM (SELECT *, row_number() OVER (PARTITION BY sender ORDER BY date_read DESC, book_id DESC, chapter DESC) AS rn FROM progress WHERE date_read <= DATE '2024-01-20') WHERE rn = 1",
    "plan_expand": f"WITH {MESSAGES}, {PLAN} SELECT date, day, CAST(book_id AS INTEGER) AS book_id, book_name, CAST(chapter AS INTEGER) AS chapter, seq FROM chap",
    "plan_emoji": f"WITH {MESSAGES}, {PLAN} SELECT date, CASE WHEN i % 3 = 0 THEN chr(128214) ELSE chr(128165) END AS emoji FROM pl",
    "plan_days": f"WITH {MESSAGES}, {PLAN} SELECT count(DISTINCT day) AS total_days FROM pl",
    "header_format": f"WITH {MESSAGES}, {PLAN} SELECT date, {HEADER} AS header FROM chap GROUP BY date",
    "compliance_member": f"SELECT * FROM ({ALL}) WHERE sender = 'user_3' AND date = DATE '{SUMMARY_DAY}' UNION ALL "
    f"SELECT 'user_3', DATE '{SUMMARY_DAY}', count(*), 0, string_agg(book_name || ' ' || chapter, ', ' ORDER BY row_no, seq), 0.0, false FROM (WITH {MESSAGES}, {PLAN} SELECT * FROM chap WHERE date = DATE '{SUMMARY_DAY}') "
    f"WHERE NOT EXISTS (SELECT 1 FROM ({ALL}) WHERE sender = 'user_3' AND date = DATE '{SUMMARY_DAY}')",
    "compliance_all": ALL,
    "daily_summary": f"""WITH {MESSAGES}, {PLAN}, {READS}, day AS (SELECT DATE '{SUMMARY_DAY}' AS d),
lastr AS (SELECT sender, left(book_name, 3) || ' ' || chapter AS pos FROM (SELECT *, row_number() OVER (PARTITION BY sender ORDER BY date_read DESC, book_id DESC, chapter DESC) AS rn FROM pr, day WHERE date_read <= d) WHERE rn = 1),
st AS (SELECT w.sender, bool_and(pr.sender IS NOT NULL) AS done FROM who w JOIN day ON true JOIN chap c ON c.date = d
  LEFT JOIN pr ON pr.sender = w.sender AND pr.date_read = d AND pr.book_name = c.book_name AND pr.chapter = c.chapter GROUP BY w.sender),
numbered AS (SELECT row_number() OVER (ORDER BY sender) AS n, sender, done, pos FROM st LEFT JOIN lastr USING (sender))
SELECT 0 AS line_no, {HEADER} AS line FROM chap, day WHERE date = d
UNION ALL SELECT CAST(n AS INTEGER), n || '. ' || sender || ' ' || CASE WHEN done THEN (SELECT CASE WHEN i % 3 = 0 THEN chr(128214) ELSE chr(128165) END FROM pl, day WHERE date = d) ELSE coalesce(pos, '') END FROM numbered""",
    "explode_refs": f"WITH {MESSAGES} SELECT seq, 0 AS ord, {SPELT} AS book_start, first AS start_chapter, CASE WHEN last > first THEN last END AS end_chapter FROM msgs",
}
