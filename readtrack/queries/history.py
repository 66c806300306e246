"""Tables as they were at a time, chats as files, and names that are like one another."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import aliases
from ..operators import progress, similar
from ..operators.asof import asof_join
from ..sources import chat
from ..sources.shared import new_folder
from .domain import MESSAGES, PLAN, PROGRESS, messages, plan, refs, table


def last_read_by_day(s, d):
    """Each member's last chapter at every date of the plan."""
    days = sorted(r["date"] for r in plan(s, d).select("date").collect())  # one a day
    who = table(s, d, "events").select(F.concat(F.lit("user_"), F.col("user_id")).alias("sender")).distinct()
    probes = who.select("sender", F.explode(F.array(*[F.lit(x) for x in days])).alias("date"))
    return progress.last_read_at(progress.progress_of(refs(s, d)), probes)


def sale_segments(s, d):
    """Each sale with what was last known of its client when it was sold."""
    changes = table(s, d, "client_changes").select("client_id", "valid_at", "seq", "change_id", "segment")
    sales = table(s, d, "sales").select("sale_id", "client_id", "sold_at")
    return asof_join(sales, changes, ["client_id"], "sold_at", "valid_at", ["change_id", "segment"], ["seq"])


def exported(s, d):
    """timestamp, sender, message of all events; every third message has a second line."""
    m = messages(s, d)
    return m.select("seq", F.date_trunc("SECOND", "timestamp").cast("timestamp_ntz").alias("timestamp"), "sender", F.when(F.col("seq") % 3 == 0, F.concat("message", F.lit("\namin "), "seq")).otherwise(F.col("message")).alias("message"))


def chat_files(s, d):
    """All events written as chat exports and read back in byte ranges."""
    folder = new_folder(s, "chats")
    line = F.concat(F.lit("["), F.date_format("timestamp", "d/M/yy H.mm.ss"), F.lit("] "), "sender", F.lit(": "), "message")
    exported(s, d).repartitionByRange("seq").sortWithinPartitions("seq").select(line.alias("value")).write.text(folder)
    return chat.parse_files(s, folder).select("timestamp", "sender", "message")


def bent(s, d):
    """The messages' books with a letter dropped, two swapped, or one changed."""
    m = messages(s, d)
    p = F.floor(F.col("seq") / 3) % F.length("alias")
    at = lambda i, n=1: F.substr("alias", (p + i).cast("int"), F.lit(n))
    rest = lambda i: F.substr("alias", (p + i).cast("int"))
    head = F.left("alias", p.cast("int"))
    key = F.when(F.col("seq") % 3 == 0, F.concat(head, rest(2))).when(F.col("seq") % 3 == 1, F.concat(head, at(2), at(1), rest(3))).otherwise(F.concat(head, F.lit("x"), rest(2)))
    return m.select("seq", key.alias("key"))


def similar_names(s, d):
    """Each bent name with all aliases that are like it."""
    names = s.createDataFrame([(a,) for a, _, _ in aliases()], "name string")
    return similar.similar(bent(s, d), names).select("key", "name", F.round("score", 6).alias("score"))


QUERIES = {"similar_names": similar_names, "last_read_by_day": last_read_by_day, "sale_segments": sale_segments, "chat_files": chat_files}

#: The length of the longest common subsequence of two texts, by rows of bits.
LCS = """length({a}) - bit_count(list_reduce(
  list_transform(range(1, length({b}) + 1), lambda i: CAST(list_sum(list_transform(range(length({a})), lambda j: CASE WHEN substr({a}, j + 1, 1) = substr({b}, i, 1) THEN 1::BIGINT << j ELSE 0 END)) AS BIGINT)),
  lambda r, m: ((r + (r & m)) | (r - (r & m))) & ((1::BIGINT << length({a})) - 1), (1::BIGINT << length({a})) - 1))"""
SQL = {
    "similar_names": f"""WITH {MESSAGES}, pt AS (SELECT seq, alias, CAST(seq // 3 % length(alias) AS INTEGER) AS p FROM msgs),
keys AS (SELECT DISTINCT CASE seq % 3 WHEN 0 THEN left(alias, p) || substr(alias, p + 2) WHEN 1 THEN left(alias, p) || substr(alias, p + 2, 1) || substr(alias, p + 1, 1) || substr(alias, p + 3)
  ELSE left(alias, p) || 'x' || substr(alias, p + 2) END AS key FROM pt),
names AS (SELECT unnest(aliases) AS name FROM cat),
pairs AS (SELECT key, name, CASE WHEN length(key) <= length(name) THEN key ELSE name END AS a, CASE WHEN length(key) <= length(name) THEN name ELSE key END AS b FROM keys, names WHERE key <> ''),
near AS (SELECT * FROM pairs WHERE 3 * ({LCS.format(a="a", b="b")}) >= 2 * length(a)),
ways AS (SELECT key, name, a, b FROM near UNION ALL SELECT key, name, b, a FROM near WHERE length(a) = length(b)),
parts AS (SELECT key, name, a, substr(b, greatest(i, 0) + 1, i + length(a) - greatest(i, 0)) AS w FROM (SELECT *, unnest(range(1 - length(a), length(b))) AS i FROM ways)),
rated AS (SELECT key, name, max(200.0 * ({LCS.format(a="a", b="w")}) / (length(a) + length(w))) AS score FROM parts WHERE w <> '' GROUP BY key, name)
SELECT key, name, round(CAST(score AS DOUBLE), 6) AS score FROM rated WHERE score >= 80""",
    "last_read_by_day": f"""WITH {MESSAGES}, {PLAN}, {PROGRESS},
best AS (SELECT sender, date_read, book_id, chapter FROM (SELECT *, row_number() OVER (PARTITION BY sender, date_read ORDER BY book_id DESC, chapter DESC) AS rn FROM progress) WHERE rn = 1),
who AS (SELECT DISTINCT sender, date FROM msgs, pl)
SELECT w.sender, w.date, b.date_read, b.book_id, b.chapter FROM who w ASOF LEFT JOIN best b ON w.sender = b.sender AND w.date >= b.date_read""",
    "sale_segments": """WITH best AS (SELECT client_id, valid_at, change_id, segment FROM (
  SELECT *, row_number() OVER (PARTITION BY client_id, valid_at ORDER BY seq DESC NULLS LAST, change_id DESC NULLS LAST, segment DESC NULLS LAST) AS rn FROM client_changes
  WHERE client_id IS NOT NULL AND valid_at IS NOT NULL) WHERE rn = 1)
SELECT s.sale_id, s.client_id, s.sold_at, b.change_id, b.segment FROM sales s ASOF LEFT JOIN best b ON s.client_id = b.client_id AND s.sold_at >= b.valid_at""",
}
