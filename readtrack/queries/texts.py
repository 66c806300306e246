"""Text cleaning, chat parsing, rules and grammar."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import patterns, text
from ..operators import grammar, sampling, spans
from ..sources import chat
from .domain import MESSAGES, SPELT, messages, table


def docs(spark, sf_dir, fn):
    return table(spark, sf_dir, "documents").select("doc_id", fn(F.col("text")).alias("text"))


def dirty(x):
    """Adds what the cleaners remove."""
    return F.concat(F.lit("‎ \t﻿"), F.replace(x, F.lit(" the "), F.lit(" ​the  ")), F.lit("\n \r"))


DIRTY = "chr(8206) || ' ' || chr(9) || chr(65279) || replace(text, ' the ', ' ' || chr(8203) || 'the' || chr(160) || ' ') || chr(10) || ' ' || chr(13)"
NO_INVISIBLE = f"regexp_replace({DIRTY}, '[\\x00-\\x08\\x0B-\\x1F\\x7F-\\x9F\\xAD]|[\\x{{200B}}-\\x{{200F}}\\x{{202A}}-\\x{{202E}}\\x{{2060}}-\\x{{2064}}\\x{{FEFF}}]', '', 'g')"


def squeeze(x: str) -> str:
    one = f"regexp_replace({x}, '[\\t\\x0B\\f\\r \\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+', ' ', 'g')"
    return f"trim(regexp_replace({one}, '(?m)^ | $', '', 'g'), chr(10))"


def chat_android(spark, sf_dir):
    """Conversations as Android exports of one chat a conversation, read back."""
    c = table(spark, sf_dir, "conversations").where("role <> 'system'")
    line = F.concat(F.lit("3/1/24, 9:0"), F.col("turn") % 10, F.lit(" - "), "role", F.lit(": "), F.regexp_replace(text.clean_text(F.col("text")), r"\n\n+", "\n"))
    files = c.groupBy(F.col("conv_id").cast("string").alias("file")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text", line.alias("l")))), lambda x: x["l"]), "\n").alias("content"))
    return chat.parse_chats(files).select("file", "msg_seq", "timestamp", "sender", "message")


def chat_whole(spark, sf_dir):
    """All turns as one Android export a conversation, lines of the system without a sender among them."""
    c = table(spark, sf_dir, "conversations")
    said = F.regexp_replace(text.clean_text(F.col("text")), r"\n\n+", "\n")
    told = F.when(F.col("role") == "system", F.translate(F.concat(F.lit("Grup "), said), ":", "")).otherwise(F.concat("role", F.lit(": "), said))
    line = F.concat(F.lit("3/1/24, 9:0"), F.col("turn") % 10, F.lit(" - "), told)
    files = c.groupBy(F.col("conv_id").cast("string").alias("file")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text", line.alias("l")))), lambda x: x["l"]), "\n").alias("content"))
    return chat.parse_chats(files).select("file", "msg_seq", "timestamp", "sender", "message")


def chat_ios(spark, sf_dir):
    m = messages(spark, sf_dir)
    line = F.concat(F.lit("["), F.date_format("timestamp", "d/M/yy H.mm.ss"), F.lit("] ~"), "sender", F.lit(": "), "message")
    files = m.groupBy((F.col("seq") % 40).cast("string").alias("file")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", line.alias("l")))), lambda x: x["l"]), "\n").alias("content"))
    return chat.parse_chats(files)


def matches(spark, sf_dir):
    return messages(spark, sf_dir).select("seq", "message", spans.found(F.col("message")).alias("m"))


BEFORE, AFTER = ("sudah baca ", "", "pagi, ", "ini lho: "), (" amin", "\nselesai semua", "", " ya kak")


def in_text(spark, sf_dir):
    """References with words around them."""
    of = lambda words, k: F.element_at(F.array(*[F.lit(w) for w in words]), (F.floor(F.col("seq") / k) % 4 + 1).cast("int"))
    m = messages(spark, sf_dir).select("seq", F.concat(of(BEFORE, 1), "message", of(AFTER, 4)).alias("said"))
    return m.select("seq", F.explode(spans.as_spans(spans.found(F.col("said")))).alias("x")).select("seq", "x.start", "x.end", "x.text")


def answers(spark, sf_dir):
    """What is read of a language model's answers: whole, with words around, without chapters, broken off, without a list, of two references, empty."""
    m = messages(spark, sf_dir)
    one = lambda book, ch: F.concat(F.lit('{"book_start": "'), book, F.lit('"'), F.concat(F.lit(', "start_chapter": '), ch) if ch is not None else F.lit(""), F.lit("}"))
    whole = one(F.col("alias"), F.col("first"))
    said = F.when(F.col("seq") % 7 == 0, F.concat(F.lit("["), whole, F.lit("]")))
    for k, x in enumerate(
        [
            F.concat(F.lit("Sure:\n["), whole, F.lit("]\nDone.")), F.concat(F.lit("["), one(F.col("alias"), None), F.lit("]")), F.concat(F.lit("["), F.left(whole, F.lit(15)), F.lit("]")),
            whole, F.concat(F.lit("["), whole, F.lit(", "), one(F.lit("why"), F.lit(1)), F.lit("]")), F.lit("[]"),
        ], 1,
    ):
        said = F.when(F.col("seq") % 7 == k, x).otherwise(said)
    return m.select("seq", F.posexplode(grammar.llm_refs(said)).alias("pos", "r")).select("seq", "pos", "r.book_start", "r.start_chapter", "r.end_chapter")


SPANS = f"WITH {MESSAGES}"
RULED = "CASE WHEN regexp_matches(alias, '[0-9 -]') THEN NULL ELSE message END"

QUERIES = {
    "clean_text": lambda s, d: docs(s, d, lambda x: text.clean_text(dirty(x))),
    "normalize_whitespace": lambda s, d: docs(s, d, lambda x: text.normalize_whitespace(dirty(x))),
    "markdown_isolate": lambda s, d: docs(s, d, lambda x: text.isolate_markdown(F.concat(F.lit("_*"), x, F.lit("_")))),
    "preprocess_text": lambda s, d: docs(s, d, lambda x: text.preprocess(F.concat(F.lit("\U0001f44d"), x, F.lit("  \n✨")))),
    "text_key": lambda s, d: docs(s, d, text.text_key),
    "platform_detect": lambda s, d: table(s, d, "conversations").select("conv_id", "turn", chat.platform(F.when(F.col("turn") % 2 == 0, F.concat(F.lit("  ["), F.col("text"))).otherwise(F.col("text"))).alias("platform")),
    "timestamp_coerce": lambda s, d: table(s, d, "events").select("event_id", chat.parse_timestamps(F.when(F.col("event_id") % 2 == 0, "iOS").otherwise("Android"), F.date_format("ts", "d/M/yy"), F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "H.mm.ss")).when(F.col("event_id") % 3 == 0, F.lit("99:99")).otherwise(F.date_format("ts", "H:mm"))).alias("at")),
    "chat_parse_android": chat_android,
    "chat_parse_whole": chat_whole,
    "chat_parse_ios": chat_ios,
    "spans_in_text": in_text,
    "llm_answers": answers,
    "rule_spans": lambda s, d: matches(s, d).select("seq", F.explode(spans.as_spans(F.col("m"))).alias("x")).select("seq", "x.start", "x.end", "x.text"),
    "rule_structures": lambda s, d: matches(s, d).select("seq", F.explode(spans.as_structures(F.col("m"))).alias("x")).select("seq", "x.*"),
    "annotate_counts": lambda s, d: spans.label(spans.annotate(messages(s, d).select("seq", "message"))).groupBy("category").agg(F.count("*").alias("n"), F.sum("bible_ref_count").alias("refs")),
    "pattern_classify": lambda s, d: matches(s, d).select("seq", patterns.pattern_of(F.col("message"), F.transform("m", lambda x: x["text"])).alias("pattern")),
    "tokenize": lambda s, d: messages(s, d).select("seq", F.posexplode(grammar.tokens(F.col("message"))).alias("pos", "t")).select("seq", "pos", "t.kind", "t.value"),
    "parse_refs": lambda s, d: messages(s, d).select("seq", F.explode(grammar.parse_refs(F.array("message"))).alias("r")).select("seq", "r.*"),
    "label_studio_json": lambda s, d: sampling.annotation_tasks(matches(s, d).withColumn("s", spans.as_spans(F.col("m"))), "message", "s", "seq"),
    "llm_output_parse": lambda s, d: messages(s, d).select("seq", F.explode(grammar.llm_refs(F.concat(F.lit("Answer: "), F.to_json(F.array(F.struct(F.col("alias").alias("book_start"), F.col("first").alias("start_chapter"))))))).alias("r")).select("seq", "r.book_start", "r.start_chapter"),
}

# Every message is one reference, "alias first[-last]"; a book's alias may end before the number in other ways, but never overlaps it.
SQL = {
    "clean_text": f"SELECT doc_id, {squeeze(NO_INVISIBLE)} AS text FROM documents",
    "normalize_whitespace": f"SELECT doc_id, {squeeze(DIRTY)} AS text FROM documents",
    "markdown_isolate": "SELECT doc_id, trim(regexp_replace(regexp_replace('_*' || text || '_', '([_*])', ' \\1 ', 'g'), '[\\s\\x0B\\x{A0}\\x{85}\\x{2028}\\x{2029}]+', ' ', 'g')) AS text FROM documents",
    "preprocess_text": "SELECT doc_id, regexp_replace(regexp_replace(replace(' ' || chr(128077) || ' ' || text || '   ' || chr(10) || ' ' || chr(10024) || ' ', chr(10), ' '), ' {2,}', ' ', 'g'), '^\\s+|\\s+$', '', 'g') AS text FROM documents",
    "text_key": "SELECT doc_id, trim(regexp_replace(lower(text), '[\\s\\x0B\\x{A0}\\x{85}\\x{2028}\\x{2029}]+', ' ', 'g')) AS text FROM documents",
    "platform_detect": "SELECT conv_id, turn, CASE WHEN turn % 2 = 0 OR starts_with(ltrim(left(text, 100)), '[') THEN 'iOS' ELSE 'Android' END AS platform FROM conversations",
    "timestamp_coerce": "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN date_trunc('second', ts) WHEN event_id % 3 = 0 THEN NULL ELSE date_trunc('minute', ts) END AS at FROM events",
    "chat_parse_android": f"""
SELECT CAST(conv_id AS VARCHAR) AS file, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS msg_seq,
       TIMESTAMP '2024-01-03 09:00:00' + to_minutes(CAST(turn % 10 AS BIGINT)) AS "timestamp", role AS sender, regexp_replace({squeeze("text")}, '\\n\\n+', chr(10), 'g') AS message
FROM conversations WHERE role <> 'system'""",
    "chat_parse_whole": f"""SELECT CAST(conv_id AS VARCHAR) AS file, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS msg_seq,
       TIMESTAMP '2024-01-03 09:00:00' + to_minutes(CAST(turn % 10 AS BIGINT)) AS "timestamp", CASE WHEN role <> 'system' THEN role END AS sender,
       CASE WHEN role = 'system' THEN replace('Grup ' || regexp_replace({squeeze("text")}, '\\n\\n+', chr(10), 'g'), ':', '') ELSE regexp_replace({squeeze("text")}, '\\n\\n+', chr(10), 'g') END AS message
FROM conversations""",
    "spans_in_text": f"""WITH {MESSAGES}, p AS (SELECT seq, message, ['sudah baca ', '', 'pagi, ', 'ini lho: '][CAST(seq % 4 + 1 AS INTEGER)] AS b FROM msgs)
SELECT seq, CAST(length(b) AS INTEGER) AS start, CAST(length(b) + length(message) AS INTEGER) AS "end", message AS text FROM p""",
    "llm_answers": f"""WITH {MESSAGES} SELECT seq, 0 AS pos, alias AS book_start, CASE WHEN seq % 7 <> 2 THEN first END AS start_chapter, CAST(NULL AS INTEGER) AS end_chapter FROM msgs WHERE seq % 7 IN (0, 1, 2, 5)
UNION ALL SELECT seq, 1, 'why', 1, NULL FROM msgs WHERE seq % 7 = 5""",
    "chat_parse_ios": f"""WITH {MESSAGES}
SELECT CAST(seq % 40 AS VARCHAR) AS file, row_number() OVER (PARTITION BY seq % 40 ORDER BY seq) AS msg_seq, date_trunc('second', "timestamp") AS "timestamp", sender, message FROM msgs""",
    "rule_spans": f"WITH {MESSAGES} SELECT seq, 0 AS start, CAST(length(message) AS INTEGER) AS \"end\", message AS text FROM msgs",
    "rule_structures": f"WITH {MESSAGES} SELECT seq, alias AS book_start, first AS start_chapter, CAST(NULL AS VARCHAR) AS book_end, CASE WHEN last > first THEN last END AS end_chapter FROM msgs",
    "annotate_counts": f"WITH {MESSAGES} SELECT 'report' AS category, count(*) AS n, count(*) AS refs FROM msgs",
    "pattern_classify": f"WITH {MESSAGES} SELECT seq, CASE WHEN last > first OR regexp_matches(message, '\\d+ ?- ?\\d') THEN 'chapter_range' ELSE 'single_chapter' END AS pattern FROM msgs",
    "parse_refs": f"WITH {MESSAGES} SELECT seq, {SPELT} AS book_start, first AS start_chapter, CAST(NULL AS VARCHAR) AS book_end, CASE WHEN last > first THEN last END AS end_chapter FROM msgs",
    "tokenize": f"""WITH {MESSAGES},
t AS (SELECT seq, regexp_extract_all(message, '-|sd|hingga|[a-z]+2\\b|\\d+|[a-z]+(?:-[a-z]+)*') AS xs FROM msgs),
u AS (SELECT seq, unnest(xs) AS x, generate_subscripts(xs, 1) - 1 AS pos FROM t)
SELECT seq, CAST(pos AS INTEGER) AS pos, CASE WHEN x = '-' OR x = 'sd' THEN 'RANGE' WHEN regexp_matches(x, '^\\d+$') THEN 'NUM' ELSE 'WORD' END AS kind,
       CASE WHEN regexp_matches(x, '^[a-z]+2$') THEN replace(x, '2', '') || '-' || replace(x, '2', '') ELSE x END AS value FROM u""",
    "label_studio_json": f"""WITH {MESSAGES}
SELECT seq, '{{"data":{{"text":"' || message || '"}},"predictions":[{{"result":[{{"from_name":"label","to_name":"text","type":"labels","value":{{"start":0,"end":' || length(message)
  || ',"text":"' || message || '","labels":["BIBLE_REF"]}}}}]}}]}}' AS json FROM msgs""",
    "llm_output_parse": f"WITH {MESSAGES} SELECT seq, alias AS book_start, first AS start_chapter FROM msgs",
}
