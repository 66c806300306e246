"""Message activity, sampling, tagging and evaluation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import analytics, crf, evaluate, sampling, tagging
from ..functions.text import ordered_distinct
from .domain import MESSAGES, messages, table

REPORT = "event_type <> 'click'"


def said(s, d):
    """Conversations' texts: length, lines."""
    c = table(s, d, "conversations")
    return c.select("conv_id", "turn", "role", F.length("text").alias("chars"), F.size(F.split("text", "\n")).alias("lines"))


def tagged(s, d):
    """Ten messages a sentence, gold tags by their parts (B- on names, I- on numbers), predicted tags with planned mistakes."""
    m = messages(s, d).select((F.col("seq") / 5).cast("long").alias("sent"), "seq", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k"), "first")
    place = F.col("seq") * 3 + F.col("k")
    gold = F.when(F.col("k") == 0, "B-BIBLE_REF").when(F.col("k") == 1, "I-BIBLE_REF").otherwise("O")
    pred = F.when(place % 13 == 0, "O").when((F.col("k") == 2) & (place % 17 == 0), "B-BIBLE_REF").when((F.col("k") == 1) & (place % 19 == 0), "B-BIBLE_REF").otherwise(gold)
    token = F.when(F.col("k") == 0, F.lit("kej")).when(F.col("k") == 1, F.col("first").cast("string")).otherwise("done")
    rows = F.array_sort(F.collect_list(F.struct(place.alias("p"), token.alias("token"), gold.alias("gold"), pred.alias("pred"))))
    return m.groupBy("sent").agg(rows.alias("r")).select("sent", F.col("r.token").alias("tokens"), F.col("r.gold").alias("gold"), F.col("r.pred").alias("pred"), (F.col("sent") % 3).alias("pattern"))


TAGGED = f"""WITH {MESSAGES},
tk AS (SELECT CAST(floor(seq / 5) AS BIGINT) AS sent, seq * 3 + k AS p, k, seq, first,
  CASE k WHEN 0 THEN 'B-BIBLE_REF' WHEN 1 THEN 'I-BIBLE_REF' ELSE 'O' END AS gold FROM msgs, range(3) t(k)),
tg AS (SELECT *, CASE WHEN p % 13 = 0 THEN 'O' WHEN k = 2 AND p % 17 = 0 THEN 'B-BIBLE_REF' WHEN k = 1 AND p % 19 = 0 THEN 'B-BIBLE_REF' ELSE gold END AS pred,
  CASE k WHEN 0 THEN 'kej' WHEN 1 THEN CAST(first AS VARCHAR) ELSE 'done' END AS token, row_number() OVER (PARTITION BY sent ORDER BY p) - 1 AS pos FROM tk),
isl AS (SELECT *, pred LIKE 'B-%' OR (pred LIKE 'I-%' AND coalesce(lag(pred) OVER (PARTITION BY sent ORDER BY p), 'O') = 'O') AS opens FROM tg),
num AS (SELECT *, count(*) FILTER (opens) OVER (PARTITION BY sent ORDER BY p) AS island FROM isl),
sp AS (SELECT sent, CAST(min(pos) AS INTEGER) AS first, CAST(max(pos) AS INTEGER) AS last, string_agg(token, ' ' ORDER BY p) AS text FROM num WHERE pred <> 'O' GROUP BY sent, island)"""


def judged(s, d):
    """Gold and predicted structures a message: wrong chapters on each ninth, none on each tenth."""
    n = F.col("seq")
    one = lambda ch: F.struct(F.col("alias").alias("book_start"), ch.alias("start_chapter"), F.lit(None).cast("string").alias("book_end"), F.col("last").alias("end_chapter"))
    pred = F.when(n % 10 == 0, F.array().cast("array<struct<book_start:string,start_chapter:int,book_end:string,end_chapter:int>>")).when(n % 9 == 0, F.array(one(F.col("first") + 1))).when(n % 7 == 0, F.array(one(F.col("first")), one(F.col("first")))).otherwise(F.array(one(F.col("first"))))
    return messages(s, d).select("seq", F.array(one(F.col("first"))).alias("gold"), pred.alias("pred"))


JUDGED = f"""WITH {MESSAGES}, j AS (SELECT seq, CASE WHEN seq % 10 = 0 OR seq % 9 = 0 THEN 0 ELSE 1 END AS tp,
  CASE WHEN seq % 10 = 0 THEN 0 WHEN seq % 9 = 0 THEN 1 WHEN seq % 7 = 0 THEN 1 ELSE 0 END AS fp, CASE WHEN seq % 10 = 0 OR seq % 9 = 0 THEN 1 ELSE 0 END AS fn FROM msgs)"""
PRF = "tp, fp, fn, tp / (tp + fp) AS \"precision\", tp / (tp + fn) AS recall, 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)) AS f1"
SUMS = "SELECT CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn FROM"


def spanned(s, d):
    """Gold span [0, 10); predicted spans shifted by seq mod 10."""
    n = (F.col("seq") % 10).cast("int")
    span = lambda a: F.array(F.struct(a.alias("start"), (a + 10).alias("end"), F.lit("BIBLE_REF").alias("label")))
    return messages(s, d).select("seq", span(F.lit(0)).alias("gold"), span(n).alias("pred"))


def rows_of(s, d, side):
    return judged(s, d).select("seq", F.posexplode(side).alias("pos", "r")).select("seq", "pos", "r.*")


def pools(s, d):
    return messages(s, d).select("seq", F.concat(F.lit("p"), F.floor(F.sqrt(F.col("book_id").cast("double")))).alias("pattern"))


def tiers(s, d):
    p = pools(s, d)
    sizes = {r["pattern"]: r["n"] for r in p.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()}  # at most nine pools
    return sampling.tier_sample(p, "pattern", "seq", sampling.tier_schedule(sizes, [(100, 100), (150, 50), (200, 50)]))


def crf_tags(s, d):
    """Tags of every sentence by a model learnt from their gold tags."""
    sentences = tagged(s, d).select("sent", "tokens", "gold")
    return crf.tag(sentences, crf.fit(sentences, steps=60)).select("sent", F.array_join("pred", " ").alias("tags"))


def summary(s, d):
    one = lambda ok: F.struct(ok.alias("is_valid"))
    n = F.col("seq")
    refs = F.when(n % 6 == 0, F.array().cast("array<struct<is_valid:boolean>>")).otherwise(F.array(one(n % 5 > 0)))
    return analytics.extraction_summary(messages(s, d).select(refs.alias("refs")), "refs")


QUERIES = {
    "value_counts": lambda s, d: analytics.value_counts(table(s, d, "events"), "event_type"),
    "messages_per_day": lambda s, d: analytics.per_day(messages(s, d)),
    "messages_per_hour": lambda s, d: analytics.per_hour(messages(s, d)),
    "daily_describe": lambda s, d: analytics.describe(analytics.per_day(messages(s, d)), "n"),
    "rolling7": lambda s, d: analytics.rolling_mean(analytics.per_day(messages(s, d))),
    "length_stats": lambda s, d: analytics.describe(said(s, d), "chars", "role"),
    "line_stats": lambda s, d: analytics.describe(said(s, d), "lines", "role"),
    "length_histogram": lambda s, d: analytics.log_histogram(said(s, d), "chars", 1.0, 5000.0),
    "short_messages": lambda s, d: said(s, d).where("chars <= 200").groupBy("role").agg(F.count("*").alias("n")),
    "top_members": lambda s, d: analytics.top_members(messages(s, d)),
    "member_consistency": lambda s, d: analytics.consistency(messages(s, d).where(REPORT), 20),
    "monthly_volume": lambda s, d: analytics.monthly_volume(messages(s, d), F.expr(REPORT)),
    "dow_rate": lambda s, d: analytics.weekday_rates(messages(s, d), F.expr(REPORT)).select("weekday", "n", "reports", "rate"),
    "monthly_unique": lambda s, d: analytics.monthly_members(messages(s, d)),
    "weekday_hour_pivot": lambda s, d: analytics.weekday_by_hour(messages(s, d)),
    "pattern_source_pivot": lambda s, d: analytics.by_source(table(s, d, "documents"), "source", "lang", ["en", "de", "fr", "es"]),
    "extraction_summary": summary,
    "date_window": lambda s, d: analytics.between(messages(s, d).select("seq", "timestamp", "sender"), "2024-01-08", "2024-01-14").select("seq", "sender", "row_id"),
    "union_sources": lambda s, d: analytics.union_sources({"chat": messages(s, d).select("seq", "message"), "talk": table(s, d, "conversations").select(F.col("conv_id").alias("seq"), F.col("text").alias("message"))}).groupBy("source").agg(F.count("*").alias("n"), F.sum("seq").alias("seqs")),
    "table_counts": lambda s, d: analytics.table_counts({t: table(s, d, t) for t in ("events", "conversations", "documents")}),
    "stratified_split": lambda s, d: sampling.stratified_split(pools(s, d), "pattern", "seq"),
    "tier_sample": tiers,
    "bio_spans": lambda s, d: tagged(s, d).select("sent", F.explode(tagging.bio_spans(F.col("tokens"), F.col("pred"))).alias("x")).select("sent", "x.*"),
    "token_confusion": lambda s, d: tagging.token_confusion(tagged(s, d), "gold", "pred", "pattern"),
    "token_features": lambda s, d: tagging.token_features(tagged(s, d), "sent").select("sent", "pos", "token", F.col("prev.lower").alias("prev"), F.col("next.is_digit").alias("next_digit"), F.col("shape.suffix2").alias("suffix2"), "bos", "eos"),
    "conll_pattern": lambda s, d: tagged(s, d).select("sent", tagging.pattern_of_tags(F.array_join("tokens", " "), F.col("tokens"), F.col("pred")).alias("pattern")),
    "seqeval_f1": lambda s, d: evaluate.scores(evaluate.match_counts(tagged(s, d).select("sent", tagging.char_spans(F.col("tokens"), F.col("gold")).alias("g"), tagging.char_spans(F.col("tokens"), F.col("pred")).alias("p")), "p", "g", evaluate.span_key, "sent")),
    "seqeval_by_pattern": lambda s, d: evaluate.scores(evaluate.match_counts(tagged(s, d).select("sent", "pattern", tagging.char_spans(F.col("tokens"), F.col("gold")).alias("g"), tagging.char_spans(F.col("tokens"), F.col("pred")).alias("p")), "p", "g", evaluate.span_key, "pattern", "sent"), "pattern"),
    "tag_structures": lambda s, d: tagged(s, d).select("sent", F.posexplode(tagging.structures(F.col("tokens"), F.col("pred"))).alias("pos", "r")).select("sent", "pos", "r.book_start", "r.start_chapter"),
    "crf_tags": crf_tags,
    "roles_in_order": lambda s, d: table(s, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("r")).select("conv_id", F.array_join(ordered_distinct(F.col("r.role")), " > ").alias("roles")),
    "table_checks": lambda s, d: analytics.table_checks(messages(s, d).select("sender").distinct(), messages(s, d), messages(s, d).where("last > first"), table(s, d, "conversations").where("turn < 0")),
    "prf_exact": lambda s, d: evaluate.scores(evaluate.match_counts(judged(s, d), "pred", "gold", evaluate.structure_key, "seq")),
    "prf_partial": lambda s, d: evaluate.scores(evaluate.partial_counts(spanned(s, d), "pred", "gold", "seq")),
    "prf_sets": lambda s, d: evaluate.scores(evaluate.set_counts(rows_of(s, d, "pred").drop("pos"), rows_of(s, d, "gold").drop("pos"))),
    "error_listing": lambda s, d: evaluate.errors(rows_of(s, d, "pred").drop("pos"), rows_of(s, d, "gold").drop("pos"), "seq").groupBy("kind").agg(F.count("*").alias("n")),
    "norm_ablation": lambda s, d: evaluate.accuracy_by_position(rows_of(s, d, "pred"), rows_of(s, d, "gold"), "seq"),
    "bootstrap_ci": lambda s, d: evaluate.bootstrap(evaluate.match_counts(judged(s, d), "pred", "gold", evaluate.structure_key, "seq"), "seq"),
}

QUANT = ", ".join(f"quantile_cont(x, {q}) AS {n}" for q, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")))
STATS = f"count(x) AS count, avg(x) AS mean, stddev_samp(x) AS std, min(x) AS min, {QUANT}, max(x) AS max"
PER_DAY = "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1"
HOURS = ", ".join(f"count(*) FILTER (hour(ts) = {h}) AS h{h}" for h in range(24))
WEEK = "(VALUES ('Monday'), ('Tuesday'), ('Wednesday'), ('Thursday'), ('Friday'), ('Saturday'), ('Sunday')) w(weekday)"
SQL = {
    "value_counts": "SELECT event_type AS value, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM events GROUP BY 1",
    "messages_per_day": PER_DAY,
    "messages_per_hour": "SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n FROM events GROUP BY 1",
    "daily_describe": f"SELECT {STATS} FROM (SELECT n AS x FROM ({PER_DAY}))",
    "rolling7": f"SELECT day, n, CASE WHEN count(n) OVER w = 7 THEN avg(n) OVER w END AS rolling FROM ({PER_DAY}) WINDOW w AS (ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)",
    "length_stats": f"SELECT role, {STATS} FROM (SELECT role, CAST(length(text) AS INTEGER) AS x FROM conversations) GROUP BY role",
    "line_stats": f"SELECT role, {STATS} FROM (SELECT role, CAST(len(string_split(text, chr(10))) AS INTEGER) AS x FROM conversations) GROUP BY role",
    "length_histogram": "SELECT CAST(CASE WHEN x < 0 THEN 0 WHEN x >= ln(5000.0::DOUBLE) THEN 51 ELSE floor(x / ln(5000.0::DOUBLE) * 50) + 1 END AS BIGINT) AS bin, count(*) AS n FROM (SELECT ln(length(text)::DOUBLE) AS x FROM conversations WHERE length(text) > 0) GROUP BY 1",
    "short_messages": "SELECT role, count(*) AS n FROM conversations WHERE length(text) <= 200 GROUP BY role",
    "top_members": "SELECT 'user_' || user_id AS sender, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, sender LIMIT 20",
    "member_consistency": f"SELECT 'user_' || user_id AS sender, count(*) AS reports, count(DISTINCT CAST(ts AS DATE)) AS active_days FROM events WHERE {REPORT} GROUP BY 1 HAVING count(*) >= 20",
    "monthly_volume": f"SELECT CAST(date_trunc('month', ts) AS DATE) AS month, count(*) AS n, count(*) FILTER ({REPORT}) AS reports FROM events GROUP BY 1",
    "dow_rate": f"SELECT weekday, n, reports, coalesce(reports / n, 0) AS rate FROM {WEEK} LEFT JOIN (SELECT dayname(ts) AS weekday, count(*) AS n, count(*) FILTER ({REPORT}) AS reports FROM events GROUP BY 1) USING (weekday)",
    "monthly_unique": "SELECT CAST(date_trunc('month', ts) AS DATE) AS month, count(DISTINCT user_id) AS members FROM events GROUP BY 1",
    "weekday_hour_pivot": f"SELECT weekday, {HOURS} FROM {WEEK} LEFT JOIN events ON dayname(ts) = weekday GROUP BY weekday",
    "pattern_source_pivot": "SELECT source, " + ", ".join(f"count(*) FILTER (lang = '{x}') AS {x}" for x in ("en", "de", "fr", "es")) + " FROM documents GROUP BY source",
    "extraction_summary": """SELECT total, with_refs, zero_refs, any_invalid, round(100.0 * with_refs / total, 1) AS with_refs_pct, round(100.0 * zero_refs / total, 1) AS zero_refs_pct, round(100.0 * any_invalid / total, 1) AS any_invalid_pct
FROM (SELECT count(*) AS total, count(*) FILTER (event_id % 6 > 0) AS with_refs, count(*) FILTER (event_id % 6 = 0) AS zero_refs, count(*) FILTER (event_id % 6 > 0 AND event_id % 5 = 0) AS any_invalid FROM events)""",
    "date_window": "SELECT event_id AS seq, 'user_' || user_id AS sender, CAST(row_number() OVER (ORDER BY ts, event_id) - 1 AS INTEGER) AS row_id FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'",
    "union_sources": "SELECT 'chat' AS source, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS seqs FROM events UNION ALL SELECT 'talk', count(*), CAST(sum(conv_id) AS BIGINT) FROM conversations",
    "table_counts": "SELECT 'events' AS source, count(*) AS n FROM events UNION ALL SELECT 'conversations', count(*) FROM conversations UNION ALL SELECT 'documents', count(*) FROM documents",
    "bio_spans": f"{TAGGED} SELECT * FROM sp",
    "token_confusion": f"""{TAGGED} SELECT sent % 3 AS pattern, count(*) AS total, count(*) FILTER (gold = pred) AS correct, round(avg(CAST(gold = pred AS INTEGER)), 4) AS accuracy, count(*) FILTER (gold = 'O' AND pred <> 'O') AS false_pos,
 count(*) FILTER (gold <> 'O' AND pred = 'O') AS false_neg, count(*) FILTER (gold <> 'O' AND pred <> 'O' AND gold <> pred) AS wrong_tag FROM tg GROUP BY 1""",
    "token_features": f"{TAGGED} SELECT sent, CAST(pos AS INTEGER) AS pos, token, lag(token) OVER w AS prev, regexp_matches(lead(token) OVER w, '^\\d+$') AS next_digit, right(token, 2) AS suffix2, lag(token) OVER w IS NULL AS bos, lead(token) OVER w IS NULL AS eos FROM tg WINDOW w AS (PARTITION BY sent ORDER BY p)",
    "conll_pattern": f"{TAGGED}, c AS (SELECT sent, count(*) AS n, any_value(text) AS text FROM sp GROUP BY sent) SELECT DISTINCT tg.sent, CASE WHEN n IS NULL THEN 'none' WHEN n >= 2 THEN 'multi' WHEN regexp_matches(text, '\\d') THEN 'single_chapter' ELSE 'book_only' END AS pattern FROM tg LEFT JOIN c USING (sent)",
    "prf_exact": f"{JUDGED} SELECT {PRF} FROM ({SUMS} j)",
    "prf_partial": f"WITH j AS (SELECT CASE WHEN event_id % 10 <= 5 THEN 1 ELSE 0 END AS tp FROM events) SELECT {PRF} FROM ({SUMS} (SELECT tp, 1 - tp AS fp, 1 - tp AS fn FROM j))",
    "prf_sets": f"WITH j AS (SELECT CASE WHEN event_id % 10 = 0 OR event_id % 9 = 0 THEN 0 ELSE 1 END AS tp, CASE WHEN event_id % 10 > 0 AND event_id % 9 = 0 THEN 1 ELSE 0 END AS fp FROM events) SELECT {PRF} FROM ({SUMS} (SELECT tp, fp, 1 - tp AS fn FROM j))",
    "error_listing": f"{JUDGED} SELECT * FROM (SELECT 'FP' AS kind, CAST(sum(fp) AS BIGINT) AS n FROM j UNION ALL SELECT 'FN', CAST(sum(fn) AS BIGINT) FROM j)",
    "norm_ablation": """SELECT count(*) + count(*) FILTER (twice) AS total, count(*) FILTER (seq % 10 > 0 AND seq % 9 > 0) AS correct, count(*) FILTER (seq % 10 = 0) AS skipped,
 round(count(*) FILTER (seq % 10 > 0 AND seq % 9 > 0) / (count(*) + count(*) FILTER (twice)), 4) AS accuracy,
 round(avg(CAST(seq % 10 > 0 AS INTEGER)), 4) AS book_start_accuracy, round(avg(CAST(seq % 10 > 0 AND seq % 9 > 0 AS INTEGER)), 4) AS start_chapter_accuracy, round(avg(CAST(seq % 10 > 0 AS INTEGER)), 4) AS book_end_accuracy,
 round(avg(CAST(seq % 10 > 0 AS INTEGER)), 4) AS end_chapter_accuracy FROM (SELECT event_id AS seq, event_id % 10 > 0 AND event_id % 9 > 0 AND event_id % 7 = 0 AS twice FROM events)""",
    "stratified_split": f"""WITH {MESSAGES},
p AS (SELECT seq, 'p' || CAST(floor(sqrt(book_id)) AS INTEGER) AS pattern FROM msgs),
r AS (SELECT *, (row_number() OVER (PARTITION BY pattern ORDER BY md5('42/' || seq), seq) - 1) / count(*) OVER (PARTITION BY pattern) AS place FROM p)
SELECT seq, pattern, CASE WHEN place < 0.8 - 1e-12 THEN 'train' WHEN place < 0.9 - 1e-12 THEN 'val' ELSE 'test' END AS split FROM r""",
    "seqeval_by_pattern": f"""{TAGGED},
gisl AS (SELECT *, count(*) FILTER (gold LIKE 'B-%') OVER (PARTITION BY sent ORDER BY p) AS gi FROM tg),
gs AS (SELECT sent, CAST(min(pos) AS INTEGER) AS first, CAST(max(pos) AS INTEGER) AS last FROM gisl WHERE gold <> 'O' GROUP BY sent, gi),
n AS (SELECT pattern, (SELECT count(*) FROM sp JOIN gs USING (sent, first, last) WHERE sent % 3 = pattern) AS tp, (SELECT count(*) FROM sp WHERE sent % 3 = pattern) AS p,
  (SELECT count(*) FROM gs WHERE sent % 3 = pattern) AS g FROM (SELECT DISTINCT sent % 3 AS pattern FROM tg))
SELECT pattern, {PRF} FROM (SELECT pattern, tp, p - tp AS fp, g - tp AS fn FROM n)""",
    "tier_sample": f"""WITH {MESSAGES},
p AS (SELECT seq, 'p' || CAST(floor(sqrt(book_id)) AS INTEGER) AS pattern FROM msgs),
r AS (SELECT *, row_number() OVER (PARTITION BY pattern ORDER BY md5('42/' || seq), seq) AS place FROM p),
k AS (SELECT pattern, row_number() OVER (ORDER BY pattern) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT pattern FROM p)),
q AS (SELECT pattern, 100 // n + CAST(i < 100 % n AS INTEGER) AS a, 50 // n + CAST(i < 50 % n AS INTEGER) AS b FROM k)
SELECT seq, pattern, CAST(CASE WHEN place <= a THEN 1 WHEN place <= a + b THEN 2 WHEN place <= a + 2 * b THEN 3 END AS INTEGER) AS tier FROM r JOIN q USING (pattern)""",
    "tag_structures": f"""{TAGGED},
w AS (SELECT sent, first, string_split(text, ' ') AS t FROM sp),
b AS (SELECT *, CASE WHEN NOT regexp_matches(t[1], '^[0-9]+$') THEN t[1] END AS book, CASE WHEN regexp_matches(t[len(t)], '^[0-9]+$') THEN CAST(t[len(t)] AS INTEGER) END AS chapter FROM w),
c AS (SELECT *, last_value(book IGNORE NULLS) OVER (PARTITION BY sent ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS near FROM b),
e AS (SELECT *, near IS NOT NULL AS reads, bool_or(near IS NOT NULL) OVER (PARTITION BY sent) AS any_book FROM c)
SELECT sent, CAST(row_number() OVER (PARTITION BY sent ORDER BY first) - 1 AS INTEGER) AS pos, CASE WHEN any_book THEN near ELSE t[1] END AS book_start, CASE WHEN any_book THEN chapter END AS start_chapter
FROM e WHERE reads OR NOT any_book""",
    "crf_tags": f"{TAGGED} SELECT sent, string_agg(gold, ' ' ORDER BY p) AS tags FROM tg GROUP BY sent",
    "roles_in_order": "SELECT conv_id, string_agg(role, ' > ' ORDER BY first) AS roles FROM (SELECT conv_id, role, min(turn) AS first FROM conversations GROUP BY ALL) GROUP BY conv_id",
    "table_checks": "SELECT * FROM (VALUES ('members are there', true), ('messages are there', true), ('refs are there', true), ('progress are there', false), ('progress covers refs', false)) t(\"check\", ok)",
    "seqeval_f1": f"""{TAGGED},
gisl AS (SELECT *, count(*) FILTER (gold LIKE 'B-%') OVER (PARTITION BY sent ORDER BY p) AS gi FROM tg),
gs AS (SELECT sent, CAST(min(pos) AS INTEGER) AS first, CAST(max(pos) AS INTEGER) AS last FROM gisl WHERE gold <> 'O' GROUP BY sent, gi),
n AS (SELECT (SELECT count(*) FROM sp JOIN gs USING (sent, first, last)) AS tp, (SELECT count(*) FROM sp) AS p, (SELECT count(*) FROM gs) AS g)
SELECT {PRF} FROM (SELECT tp, p - tp AS fp, g - tp AS fn FROM n)""",
}
