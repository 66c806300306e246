"""Tagging of ambiguous words, pieces of words, and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import books
from ..operators import alignment, analytics, crf
from .activity import said
from .domain import MESSAGES, messages

B, I, O = "B-BIBLE_REF", "I-BIBLE_REF", "O"  # noqa: E741
#: What a message is made of by its number mod 6: w is the book's alias without marks, n and m chapters. Books and numbers have tags by what stands beside them.
SHAPES = [
    ([None, "w", "n"], ["baca"], [O, B, I]),
    (["w", None, None, "n"], ["datang", "jam"], [O, O, O, O]),
    ([None, "w", "n", None, "m"], ["sudah", "-"], [O, B, I, I, I]),
    ([None, "w", None, None], ["halo", "sudah", "baca"], [O, O, O, O]),
    (["w", "n"], [], [B, I]),
    ([None, "n", "w", "m"], ["jam"], [O, O, B, I]),
]


def shape_tokens(parts, words):
    rest = iter(words)
    return [p if p else next(rest) for p in parts], {i for i, p in enumerate(parts) if p}


def ambiguous(s, d):
    """seq, tokens, gold of every message."""
    m = messages(s, d).select("seq", F.regexp_replace("alias", "[^a-z0-9]", "").alias("w"), F.col("first").cast("string").alias("n"), F.col("last").cast("string").alias("m"))
    tokens, gold = F.lit(None), F.lit(None)
    for k, (parts, words, tags) in enumerate(SHAPES):
        names, open_ = shape_tokens(parts, words)
        hit = F.col("seq") % len(SHAPES) == k
        tokens = F.when(hit, F.array(*[F.col(x) if i in open_ else F.lit(x) for i, x in enumerate(names)])).otherwise(tokens)
        gold = F.when(hit, F.array(*[F.lit(t) for t in tags])).otherwise(gold)
    return m.select("seq", tokens.alias("tokens"), gold.alias("gold"))


def crf_ambiguous(s, d):
    """Every message's tags; the model learns from the messages whose hash isn't in the last fifth."""
    sentences = ambiguous(s, d)
    model = crf.fit(sentences.where(F.crc32(F.col("seq").cast("string").cast("binary")) % 5 != 4), steps=40, tolerance=1e-4)
    return crf.tag(sentences.select("seq", "tokens"), model).select("seq", F.array_join("tokens", " ").alias("said"), F.array_join("pred", " ").alias("tags"))


def vocabulary() -> list[str]:
    """Single letters but x, digits, a hyphen, and of each alias its first three letters, the two after, and its last three."""
    single = [*"abcdefghijklmnopqrstuvwyz0123456789-"]
    out = {*single, *(f"##{c}" for c in single)}
    for b in books():
        for a in b[3]:
            out |= {a[:3], f"##{a[3:5]}", f"##{a[-3:]}"}
    return sorted(x for x in out if x not in ("", "##"))


def subwords(s, d):
    """Each piece of every message's words, with its label."""
    m = messages(s, d).select("seq", F.split("message", " ").alias("tokens"))
    tags = F.transform("tokens", lambda t, i: F.when(i == F.size("tokens") - 1, "I").when(i == 0, "B").otherwise("O"))
    a = alignment.align(m.withColumn("tags", tags), "tokens", "tags", vocabulary(), ["O", "B", "I"])
    return a.select("seq", F.posexplode(F.arrays_zip("pieces", "words", "labels")).alias("pos", "x")).select("seq", "pos", F.col("x.pieces").alias("piece"), F.col("x.words").alias("word"), F.col("x.labels").alias("label"))


def rounded(df, **to):
    return df.select(*[F.round(c, to[c]).alias(c) if c in to else F.col(c) for c in df.columns])


def sizes(s, d):
    """Messages with their length and some more, so that a month's sizes spread."""
    return messages(s, d).withColumn("chars", F.length("message") + F.col("seq") % 97)


def estimates(s, d):
    """Months from daily sketches, beside exact numbers: members within 3 % of them, and a median whose rank is within 1 % of the middle."""
    m = sizes(s, d)
    got = analytics.monthly_estimates(analytics.daily_sketches(m)).withColumnRenamed("members", "about")
    exact = m.groupBy(F.trunc("timestamp", "month").alias("month")).agg(F.count_distinct("sender").alias("members"), F.count("*").alias("n"))
    ranks = m.join(got.select("month", "median"), F.trunc("timestamp", "month") == F.col("month")).groupBy("month").agg(F.count_if(F.expr("chars < median")).alias("below"), F.count_if(F.expr("chars <= median")).alias("upto"))
    met = got.join(exact, "month").join(ranks, "month")
    near = (F.col("below") <= 0.51 * F.col("n") + 1) & (F.col("upto") >= 0.49 * F.col("n") - 1)
    return met.select("month", "days", "members", (F.abs(F.col("about") - F.col("members")) <= 0.03 * F.col("members") + 1).alias("members_near"), near.alias("median_near"))


QUERIES = {
    "crf_ambiguous": crf_ambiguous,
    "subword_alignment": subwords,
    "length_density": lambda s, d: rounded(analytics.density(said(s, d), "role", "chars"), place=6, density=8),
    "length_box": lambda s, d: rounded(analytics.box(said(s, d), "role", "chars"), q1=6, median=6, q3=6),
    "activity_cube": lambda s, d: analytics.activity_cube(messages(s, d)),
    "activity_rollup": lambda s, d: analytics.activity_rollup(messages(s, d)),
    "monthly_estimates": estimates,
}


def _case(of) -> str:
    return "CASE seq % 6 " + " ".join(f"WHEN {k} THEN {of(*shape)}" for k, shape in enumerate(SHAPES)) + " END"


def _said(parts, words, _):
    names, open_ = shape_tokens(parts, words)
    return " || ' ' || ".join(x if i in open_ else f"'{x}'" for i, x in enumerate(names))


SAID = "SELECT role, length(text) AS v FROM conversations WHERE text IS NOT NULL"
SQL = {
    "crf_ambiguous": f"""WITH {MESSAGES}, p AS (SELECT seq, regexp_replace(alias, '[^a-z0-9]', '', 'g') AS w, CAST(first AS VARCHAR) AS n, CAST(last AS VARCHAR) AS m FROM msgs)
SELECT seq, {_case(_said)} AS said, {_case(lambda p, w, tags: "'" + " ".join(tags) + "'")} AS tags FROM p""",
    "subword_alignment": f"""WITH RECURSIVE {MESSAGES},
single AS (SELECT unnest(string_split('abcdefghijklmnopqrstuvwyz0123456789-', '')) AS c),
part AS (SELECT unnest(aliases) AS a FROM cat),
voc AS (SELECT DISTINCT * FROM (
  SELECT c AS piece, false AS inner_ FROM single UNION ALL SELECT c, true FROM single UNION ALL SELECT left(a, 3), false FROM part
  UNION ALL SELECT substr(a, 4, 2), true FROM part UNION ALL SELECT right(a, 3), true FROM part) WHERE piece <> ''),
tok AS (SELECT seq, i - 1 AS word, ws[i] AS t, CASE WHEN i = len(ws) THEN 2 WHEN i = 1 THEN 1 ELSE 0 END AS label FROM (SELECT seq, string_split(message, ' ') AS ws FROM msgs), range(1, 9) r(i) WHERE i <= len(ws)),
cut AS (
  SELECT DISTINCT t, 0 AS done, CAST([] AS VARCHAR[]) AS pieces FROM tok
  UNION ALL
  SELECT t, done + length(piece), list_append(pieces, CASE WHEN done > 0 THEN '##' ELSE '' END || piece) FROM (
    SELECT c.*, v.piece, row_number() OVER (PARTITION BY c.t, c.done ORDER BY length(v.piece) DESC) AS rn FROM cut c JOIN voc v ON starts_with(substr(c.t, c.done + 1), v.piece) AND v.inner_ = (c.done > 0)
    WHERE c.done < length(c.t)) WHERE rn = 1
),
whole AS (SELECT t, coalesce(any_value(pieces) FILTER (done = length(t)), ['[UNK]']) AS pieces FROM cut GROUP BY t),
each AS (SELECT seq, word, unnest(pieces) AS piece, unnest(range(len(pieces))) AS nth, label FROM tok JOIN whole USING (t) WHERE t <> ''),
placed AS (SELECT seq, CAST(row_number() OVER (PARTITION BY seq ORDER BY word, nth) AS INTEGER) AS pos, piece, CAST(word AS INTEGER) AS word, CASE WHEN nth = 0 THEN label ELSE -100 END AS label FROM each)
SELECT seq, pos, piece, word, CAST(label AS INTEGER) AS label FROM placed
UNION ALL SELECT seq, 0, '[CLS]', NULL, -100 FROM msgs
UNION ALL SELECT m.seq, CAST(coalesce(n, 0) + 1 AS INTEGER), '[SEP]', NULL, -100 FROM msgs m LEFT JOIN (SELECT seq, max(pos) AS n FROM placed GROUP BY seq) USING (seq)""",
    "length_density": f"""WITH v AS ({SAID}), o AS (SELECT role, min(v) AS lo, max(v) AS hi, count(*) AS n, stddev_samp(v) AS sd FROM v GROUP BY role HAVING max(v) > min(v)),
b AS (SELECT role, least(floor((v - lo) / (hi - lo) * 128), 127) AS bin, count(*) AS c FROM v JOIN o USING (role) GROUP BY 1, 2),
g AS (SELECT role, lo, hi, n, sd * pow(n, -0.2) AS h, CAST(i AS INTEGER) AS point, lo + i * (hi - lo) / 31 AS place FROM o, range(32) r(i))
SELECT role, point, round(place, 6) AS place, round(sum(c * exp(-0.5 * pow((place - (lo + (bin + 0.5) * (hi - lo) / 128)) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 8) AS density
FROM g JOIN b USING (role) GROUP BY role, point, place""",
    "length_box": f"""WITH v AS ({SAID}), q AS (SELECT role, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM v GROUP BY role),
m AS (SELECT *, v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1) AS inside FROM v JOIN q USING (role))
SELECT role, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, count(*) AS n, CAST(min(v) FILTER (inside) AS DOUBLE) AS low, CAST(max(v) FILTER (inside) AS DOUBLE) AS high, count(*) FILTER (NOT inside) AS outliers
FROM m GROUP BY role, q1, median, q3""",
    "activity_cube": f"""WITH {MESSAGES}, m AS (SELECT CAST(date_trunc('month', "timestamp") AS DATE) AS month, CAST(isodow("timestamp") AS INTEGER) AS weekday, sender FROM msgs)
SELECT month, weekday, CAST(grouping(month, weekday) AS INTEGER) AS level, count(*) AS n, count(DISTINCT sender) AS members FROM m GROUP BY CUBE (month, weekday)""",
    "activity_rollup": f"""WITH {MESSAGES}, m AS (SELECT CAST(date_trunc('month', "timestamp") AS DATE) AS month, CAST("timestamp" AS DATE) AS day FROM msgs)
SELECT month, day, CAST(grouping(month, day) AS INTEGER) AS level, count(*) AS n FROM m GROUP BY ROLLUP (month, day)""",
    "monthly_estimates": f"""WITH {MESSAGES}
SELECT CAST(date_trunc('month', "timestamp") AS DATE) AS month, count(DISTINCT CAST("timestamp" AS DATE)) AS days, count(DISTINCT sender) AS members, true AS members_near, true AS median_near FROM msgs GROUP BY 1""",
}
