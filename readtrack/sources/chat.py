"""Chat exports: whole files to message rows.

A header line starts a message, and lines without a header continue it. Everything is native: a running count of headers
numbers the messages, and lines are joined again. Contents that are in a table are rows (`parse_chats`); files of any size are
read in byte ranges (`parse_files`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import clean_text

#: The header lines of both exports (fields date, time, sender and text; date, time and rest) and their times.
IOS = r"(?U)^\[(\d{1,2}/\d{1,2}/\d{2})\s+(\d{1,2}\.\d{2}\.\d{2})\]\s*~?\s*([^:]+):\s*(.+)$"
ANDROID = r"(?U)^(\d{1,2}/\d{1,2}/\d{2,4}),\s+(\d{1,2}:\d{2})\s+-\s+(.+)$"
IOS_TIME, ANDROID_TIME = "d/M/yy H.mm.ss", "d/M/yy H:mm"
MESSAGE = "file string, msg_seq long, timestamp timestamp_ntz, sender string, message string"


#: One well-formed UTF-8 character, its bytes as characters.
CHARACTER = (
    r"(?s)([\x00-\x7F]|[\xC2-\xDF][\x80-\xBF]|\xE0[\xA0-\xBF][\x80-\xBF]|[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}|\xED[\x80-\x9F][\x80-\xBF]"
    r"|\xF0[\x90-\xBF][\x80-\xBF]{2}|[\xF1-\xF3][\x80-\xBF]{3}|\xF4[\x80-\x8F][\x80-\xBF]{2})|."
)


def decoded(content: Column) -> Column:
    """Bytes as text; bytes that are not UTF-8 are dropped, and nothing else is (a replacement character in the text stays)."""
    whole = F.regexp_replace(F.decode(content, "ISO-8859-1"), CHARACTER, "$1")
    return F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(F.encode(whole, "ISO-8859-1").cast("string"))


def read_chats(spark: SparkSession, path: str) -> DataFrame:
    """(file, content): each file whole."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), decoded(F.col("content")).alias("content"))


def platform(content: Column) -> Column:
    """iOS where the first hundred characters, stripped, start with a bracket; Android otherwise."""
    return F.when(F.regexp_replace(F.left(F.coalesce(content, F.lit("")), F.lit(100)), r"(?U)^\s+", "").startswith("["), "iOS").otherwise("Android")


def _lines(chats: DataFrame) -> DataFrame:
    c = chats.select("file", clean_text(F.col("content")).alias("content"))
    return c.select("file", platform(F.col("content")).alias("platform"), F.posexplode(F.split("content", "\n")).alias("pos", "line"))


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def _messages(lines: DataFrame, *keys: str) -> DataFrame:
    """Numbered lines (keys, platform, msg_seq, pos: their order, head, line) -> a row for each message."""
    ios, head, line = F.col("platform") == "iOS", F.col("head"), F.col("line")
    part = lambda i, a: F.when(head & ios, F.regexp_extract(line, IOS, i)).when(head, F.regexp_extract(line, ANDROID, a))
    fields = [part(1, 1).alias("date"), part(2, 2).alias("time"), F.when(head & ios, F.regexp_extract(line, IOS, 3)).alias("who"), part(4, 3).alias("rest")]
    lines = lines.where("msg_seq > 0").select(*keys, "platform", "msg_seq", "pos", "head", "line", *fields)
    rest, cut = F.col("rest"), F.instr("rest", ":")
    sender = F.when(ios, F.col("who")).when(cut > 0, F.left(rest, cut - 1))
    said = F.when(ios, rest).when(cut > 0, F.substr(rest, cut + 1)).otherwise(rest)
    told = F.array_sort(F.collect_list(F.struct("pos", F.when(head, _strip(said)).otherwise(line).alias("x"))))
    return lines.groupBy(*keys, "platform", "msg_seq").agg(
        F.max("date").alias("date"), F.max("time").alias("time"), F.max(_strip(sender)).alias("sender"), F.array_join(F.transform(told, lambda s: s["x"]), "\n").alias("message")
    )


def parse_fields(chats: DataFrame) -> DataFrame:
    """(file, msg_seq, platform, date, time, sender, message), all strings but the number."""
    lines = _lines(chats).withColumn("head", F.when(F.col("platform") == "iOS", F.col("line").rlike(IOS)).otherwise(F.col("line").rlike(ANDROID)))
    order = Window.partitionBy("file").orderBy("pos")
    return _messages(lines.withColumn("msg_seq", F.sum(F.col("head").cast("long")).over(order)), "file")


def file_fields(spark: SparkSession, path: str) -> DataFrame:
    """What `parse_fields` gives, from files of any size: each byte range of a file is a task of its own.

    Ranges are cut at line ends, and every 65,536 lines. A range counts its headers; the headers of the ranges before it number its messages, and lines ahead of
    its first header continue the last message before, in whichever range that began. What is known of a range is one row.
    """
    raw = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"),
        clean_text(decoded(F.col("value").cast("binary"))).alias("line"),
    )
    raw = raw.withColumn("block", F.struct("block", F.shiftright("row", 16).alias("part")))
    lines = raw.withColumns({"ios": F.col("line").rlike(IOS), "android": F.col("line").rlike(ANDROID)})
    ranges = lines.groupBy("file", "block").agg(
        F.count_if("ios").alias("n_ios"), F.count_if("android").alias("n_android"), F.min_by(F.when(F.col("line") != "", F.left("line", F.lit(1))), F.when(F.col("line") != "", F.col("row"))).alias("begin")
    )
    whole = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("platform", F.when(F.first("begin", ignorenulls=True).over(whole) == "[", "iOS").otherwise("Android"))
    heads = F.when(F.col("platform") == "iOS", F.col("n_ios")).otherwise(F.col("n_android"))
    ranges = ranges.select("file", "block", "platform", F.coalesce(F.sum(heads).over(before), F.lit(0)).alias("before"), F.sum(heads).over(whole).alias("all"))
    met = lines.join(ranges, ["file", "block"]).withColumn("head", F.when(F.col("platform") == "iOS", F.col("ios")).otherwise(F.col("android")))
    seen = F.sum(F.col("head").cast("long")).over(Window.partitionBy("file", "block").orderBy("row"))
    out = _messages(met.select("file", "platform", (F.col("before") + seen).alias("msg_seq"), F.struct("block", "row").alias("pos"), "head", "line", "all"), "file", "all")
    ended = F.when(F.col("msg_seq") == F.col("all"), F.regexp_replace("message", r"\n+\z", "")).otherwise(F.col("message"))  # a file's last lines, if empty, are none
    return out.withColumn("message", ended).drop("all")


def parse_timestamps(platform_: Column, date: Column, time: Column) -> Column:
    """Null where date and time don't fit the platform's format (four-digit years among them)."""
    at = F.concat_ws(" ", date, time)
    ntz = lambda f: F.expr("timestamp_ntz(null)") if f is None else F.try_to_timestamp(at, F.lit(f)).cast("timestamp_ntz")
    return F.when(platform_ == "iOS", ntz(IOS_TIME)).otherwise(ntz(ANDROID_TIME))


def _rows(f: DataFrame) -> DataFrame:
    return f.select("file", "msg_seq", parse_timestamps(F.col("platform"), F.col("date"), F.col("time")).alias("timestamp"), "sender", "message")


def parse_chats(chats: DataFrame) -> DataFrame:
    """(file, content) -> file, msg_seq, timestamp, sender (null for system messages), message."""
    return _rows(parse_fields(chats))


def parse_files(spark: SparkSession, path: str) -> DataFrame:
    """What `parse_chats` gives of the files at a path, each read by as many tasks as its size needs. An empty file has no message."""
    return _rows(file_fields(spark, path))
