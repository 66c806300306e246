"""From chat exports to the day's report: parse, clean, find references, normalise, persist, compare with the plan.

Every step is the library's own operator; this module only puts them in order. Messages without a sender or a time
are rejected. A member's messages count in the order of their times, across files; of messages with the same sender
and time the first counts. Messages named in `processed` (sender, timestamp) were read before and are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .functions.text import preprocess
from .operators import compliance, grammar, progress, resolve, spans
from .plans import reading_plan
from .sources.chat import parse_chats
from .sources.shared import kept

KEYS = ["sender", "timestamp", "seq", "ord"]


def ordered(messages: DataFrame) -> DataFrame:
    """(file, msg_seq, timestamp, sender, message) -> the first message of each sender and time, seq numbering each sender's."""
    one = progress.new_messages(messages.withColumn("seq", F.struct("file", "msg_seq")).select("seq", "sender", "timestamp", "message"))
    by_time = Window.partitionBy("sender").orderBy("timestamp")
    return one.withColumn("seq", F.row_number().over(by_time).cast("long"))


def raw_references(said: DataFrame, rules: list[tuple] | None = None) -> DataFrame:
    """said, ord and the references as written, of each text (said) that has any."""
    found = said.select("said", F.transform(spans.found(F.col("said"), rules), lambda m: m["text"]).alias("texts"))
    return found.select("said", F.posexplode(grammar.parse_refs(F.col("texts"))).alias("ord", "r")).select("said", "ord", "r.*")


def references(messages: DataFrame, fuzzy: bool = True, rules: list[tuple] | None = None) -> DataFrame:
    """Ordered messages -> their normalised references. Each text is read once, whoever says it and however often."""
    said = kept(messages.select("sender", "timestamp", "seq", preprocess(F.col("message")).alias("said")), "said")
    raw = kept(raw_references(said.select("said").distinct(), rules), "raw")
    normal = resolve.normalize(raw, fuzzy).select("said", "ord", "start_id", "start_chapter", "end_id", "end_chapter", "is_valid")
    return said.join(normal, "said").select(*KEYS, "start_id", "start_chapter", "end_id", "end_chapter", "is_valid")


def read_messages(messages: DataFrame, processed: DataFrame | None = None, fuzzy: bool = True, rules: list[tuple] | None = None) -> DataFrame:
    """(file, msg_seq, timestamp, sender, message) -> persisted references, gaps filled, invalid ones marked."""
    if processed is not None:
        messages = progress.pending(messages, processed)
    return progress.persist(references(ordered(messages), fuzzy, rules))


def read(chats: DataFrame, processed: DataFrame | None = None, fuzzy: bool = True, rules: list[tuple] | None = None) -> DataFrame:
    """(file, content) -> what `read_messages` gives."""
    return read_messages(parse_chats(chats), processed, fuzzy, rules)


def members(messages: DataFrame) -> DataFrame:
    return progress.new_members(messages.where("timestamp is not null"))


def report_messages(messages: DataFrame, plan: DataFrame, date, fuzzy: bool = True) -> DataFrame:
    """line_no, line: the report of a day. Messages are parsed once, and progress is worked out once."""
    messages = kept(messages, "messages")
    done = kept(progress.progress_of(read_messages(messages, fuzzy=fuzzy)), "progress")
    who = kept(members(messages), "members")
    return compliance.summarize(who, reading_plan.expand_plan(plan), reading_plan.plan_emoji(plan), done, date)


def report(chats: DataFrame, plan: DataFrame, date, fuzzy: bool = True) -> DataFrame:
    """What `report_messages` gives of (file, content)."""
    return report_messages(parse_chats(chats), plan, date, fuzzy)
