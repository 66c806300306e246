"""Perspective rotation of multi-party chats, in DataFrame functions alone.

For every participant of a conversation (a distinct role other than `system`), the dialogue is
rendered with that speaker as the assistant, everyone else as a named user, and system turns as they
are. The assistant's contents, closing mark included, are what a loss would count: their spans come as
`mask`, pairs of character offsets within the row's text, end excluded. Marks of turns inside contents and names are broken
by a space, and line ends in names become spaces, so that no one writes a turn of another's.

A rendering comes in parts of `TURNS` distinct turns, counted in their order, so that no conversation, however long and
whatever its turns' numbers, is held in one task: turns are numbered by a sort in ranges. `char_start` is the part's offset in the whole rendering, and the parts of (conv_id,
speaker), in order, are that rendering. Offsets are sums of lengths by part and role; the texts are not in any window and
are rendered once. Repeated rows of one turn are folded with their count before
anything is collected and rendered as often as they occur. Turns order by number, role and text, null
first. A null role is the participant "unknown", a null text is empty, a null turn comes first, a null
conv_id is a conversation of its own. A conversation of system turns alone has no row, nor has an empty table. Very long
texts are turns like others; further columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, numbered, table

TURNS = 64
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
MARK, NAMED = r"<\|(im_start|im_end)\|>", "user name="


def plain(x: Column) -> Column:
    """A text in which no mark of a turn is left."""
    return F.regexp_replace(x, MARK, "< |$1|>")


def title(role: Column) -> Column:
    """What stands after the opening mark of a turn that isn't the speaker's."""
    return F.when(role == "system", F.lit("system")).otherwise(F.concat(F.lit(NAMED), plain(F.translate(role, "\r\n", "  "))))


def rotate(turns: DataFrame, per_part: int = TURNS) -> DataFrame:
    """conv_id, speaker, part, n_turns, n_spoken, text, mask, char_start."""
    conv = F.col("conv_id").cast("long")
    key = ["conv", "none", "bin"]  # a conversation without an id keeps its own key, so that keys are equal as they are
    t = turns.select(
        F.coalesce(conv, F.lit(0)).alias("conv"),
        conv.isNull().alias("none"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-(2**63))).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        plain(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("content"),
    )
    scratch = Scratch(turns.sparkSession)
    folded = t.groupBy("conv", "none", "turn", "role", "content").agg(F.count("*").cast("int").alias("times"))
    order = ["none", "conv", "turn", "role"]
    folded = numbered(folded, "rank", [*order, "content"], scratch, [*order, F.left("content", F.lit(64))])
    first = folded.groupBy("conv", "none").agg(F.min("rank").alias("first"))
    folded = folded.join(first, ["conv", "none"]).withColumn("bin", F.floor((F.col("rank") - F.col("first")) / per_part)).drop("rank", "first")
    parts = folded.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "content", "times"))).alias("said"))

    # Lengths of the parts as every speaker's rendering has them.
    fixed = len(OPEN) + len(CLOSE) + 2
    times = F.col("times").cast("long")
    by_role = folded.groupBy(*key, "role").agg(F.sum(times).alias("n"), F.sum(times * F.length("content")).alias("chars"))
    other = F.length(title(F.col("role"))).cast("long")
    by_part = by_role.groupBy(*key).agg(F.sum(F.col("n") * (other + fixed) + F.col("chars")).alias("size"))
    speakers = by_role.where("role <> 'system'").select("conv", "none", F.col("role").alias("speaker")).distinct()
    gain = by_role.where("role <> 'system'").select(*key, F.col("role").alias("speaker"), (F.col("n") * (len("assistant") - other)).alias("gain"))
    sizes = by_part.join(speakers, ["conv", "none"]).join(gain, [*key, "speaker"], "left")
    order = Window.partitionBy("conv", "none", "speaker").orderBy("bin")
    before = F.coalesce(F.sum(F.col("size") + F.coalesce("gain", F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = sizes.select(*key, "speaker", F.row_number().over(order).cast("int").alias("part"), before.cast("long").alias("char_start"))
    shown = parts.join(placed, key)

    def head(x: Column) -> Column:
        return F.concat(F.lit(OPEN), F.when(x["role"] == F.col("speaker"), F.lit("assistant")).otherwise(title(x["role"])), F.lit("\n"))

    each = F.flatten(F.transform("said", lambda x: F.array_repeat(F.struct(head(x).alias("head"), F.concat(x["content"], F.lit(CLOSE)).alias("body"), (x["role"] == F.col("speaker")).alias("own")), x["times"])))
    shown = shown.select("conv", "none", "speaker", "part", "char_start", each.alias("each"))
    size = lambda x: F.length(x["head"]) + F.length(x["body"]) + 1
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<begin:long,end:long>>").alias("mask"))
    masked = F.aggregate(
        "each",
        start,
        lambda a, x: F.struct(
            (a["at"] + size(x)).alias("at"),
            F.when(
                x["own"],
                F.concat(a["mask"], F.array(F.struct((a["at"] + F.length(x["head"])).alias("begin"), (a["at"] + F.length(x["head"]) + F.length(x["body"])).alias("end")))),
            )
            .otherwise(a["mask"])
            .alias("mask"),
        ),
    )
    return shown.select(
        F.when(~F.col("none"), F.col("conv")).alias("conv_id"),
        "speaker",
        "part",
        F.size("each").alias("n_turns"),
        F.size(F.filter("each", lambda x: x["own"])).alias("n_spoken"),
        F.array_join(F.transform("each", lambda x: F.concat(x["head"], x["body"], F.lit("\n"))), "").alias("text"),
        masked["mask"].alias("mask"),
        "char_start",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.array_join(F.transform("mask", lambda x: F.concat(x["begin"].cast("string"), F.lit("-"), x["end"].cast("string"))), ",")
    return rotate(table(spark, sf_dir, "conversations")).withColumn("mask", spans)


def broken(x: str) -> str:
    return f"regexp_replace({x}, '{MARK}', '< |\\1|>', 'g')"


ORACLE = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, {broken("coalesce(text, '')")} || '{CLOSE}' AS body,
         (dense_rank() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), {broken("coalesce(text, '')")}) - 1) // {TURNS} AS bin
  FROM conversations
), s AS (
  SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'
), x AS (
  SELECT t.conv_id, speaker, bin, turn, role, body, role = speaker AS own,
         '{OPEN}' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN 'system' ELSE '{NAMED}' || {broken("translate(role, chr(13) || chr(10), '  ')")} END || chr(10) AS head
  FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
), y AS (
  SELECT *, length(head) + length(body) + 1 AS size,
         coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, speaker, bin
           ORDER BY turn NULLS FIRST, role, body ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM x
), z AS (
  SELECT conv_id, speaker, bin, count(*) AS n_turns, count(*) FILTER (own) AS n_spoken,
         string_agg(head || body || chr(10), '' ORDER BY turn NULLS FIRST, role, body) AS text,
         coalesce(string_agg(CAST(CAST(pos AS BIGINT) + length(head) AS VARCHAR) || '-' || CAST(CAST(pos AS BIGINT) + length(head) + length(body) AS VARCHAR), ','
           ORDER BY pos) FILTER (own), '') AS mask, sum(size) AS size
  FROM y GROUP BY conv_id, speaker, bin
)
SELECT conv_id, speaker, CAST(row_number() OVER w AS INTEGER) AS part, CAST(n_turns AS INTEGER) AS n_turns,
       CAST(n_spoken AS INTEGER) AS n_spoken, text, mask,
       CAST(coalesce(sum(size) OVER (PARTITION BY conv_id, speaker ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS char_start
FROM z WINDOW w AS (PARTITION BY conv_id, speaker ORDER BY bin)
"""
