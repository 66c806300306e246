"""Raw references to books: exact aliases, then the nearest alias, then defaults and validity."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import alias_table, aliases, chapters_of, name_of
from ..functions.text import text_key

THRESHOLD = 80.0


def _indel(a: str, b: str) -> float:
    """200 * longest common subsequence / summed lengths, by bit rows."""
    if not a or not b:
        return 0.0
    place: dict[str, int] = {}
    for i, c in enumerate(a):
        place[c] = place.get(c, 0) | 1 << i
    row = every = (1 << len(a)) - 1
    for c in b:
        hit = row & place.get(c, 0)
        row = ((row + hit) | (row - hit)) & every
    return 200.0 * (len(a) - row.bit_count()) / (len(a) + len(b))


def partial_ratio(a: str, b: str, cutoff: float = 0.0) -> float:
    """The best similarity of the shorter text with any stretch of the longer, cut ends among them; 0 where letters in common can't reach the cutoff."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long else 0.0
    n = len(short)
    common = sum((Counter(short) & Counter(long)).values())
    if 200.0 * common / (n + common) < cutoff:
        return 0.0
    if short in long:
        return 100.0
    best = max(_indel(short, long[max(0, i) : i + n]) for i in range(1 - n, len(long)))
    if len(a) == len(b):
        best = max(best, max(_indel(long, short[max(0, i) : i + n]) for i in range(1 - n, n)))
    return best


def nearest_alias(keys: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(key) -> key, book_id, score of the first best alias at or above the threshold. The alias list is the bounded side; no join."""
    known = aliases()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for key in frame["key"]:
                score, _, book = max(((partial_ratio(key, a, threshold), -o, b) for a, o, b in known), key=lambda x: x[:2])
                if score >= threshold:
                    rows.append((key, book, score))
            yield pd.DataFrame(rows, columns=["key", "book_id", "score"])

    return keys.select("key").mapInPandas(run, "key string, book_id int, score double")


def resolve(df: DataFrame, column: str, out: str, fuzzy: bool = True, threshold: float = THRESHOLD) -> DataFrame:
    """Adds <out>_id, <out>_method (exact, fuzzy, failed; null where the text is) and <out>_score."""
    return resolve_all(df, {column: out}, fuzzy, threshold)


def resolve_all(df: DataFrame, columns: dict[str, str], fuzzy: bool = True, threshold: float = THRESHOLD) -> DataFrame:
    """`resolve` for several columns {column: out}. Fuzzy matching sees each unresolved text once, whichever column it comes from."""
    exact = F.broadcast(alias_table(df.sparkSession).select(F.col("alias").alias("r_alias"), F.col("book_id").alias("r_book")))
    met = df
    for c, out in columns.items():
        met = met.withColumn(f"r_key_{out}", text_key(F.col(c)))
        met = met.join(exact, F.col(f"r_key_{out}") == F.col("r_alias"), "left").withColumnRenamed("r_book", f"r_exact_{out}").drop("r_alias")
    near = None
    if fuzzy:
        open_ = F.array_compact(F.array(*[F.when(F.col(f"r_exact_{out}").isNull() & (F.col(f"r_key_{out}") != ""), F.col(f"r_key_{out}")) for out in columns.values()]))
        near = nearest_alias(met.select(F.explode(open_).alias("key")).distinct(), threshold)
    for c, out in columns.items():
        key, known = F.col(f"r_key_{out}"), F.col(f"r_exact_{out}")
        if fuzzy:
            f = near.select(F.col("key").alias("f_key"), F.col("book_id").alias("r_fuzzy"), F.col("score").alias("r_score"))
            met = met.join(f, (key == F.col("f_key")) & known.isNull(), "left").drop("f_key")
        else:
            met = met.withColumns({"r_fuzzy": F.lit(None).cast("int"), "r_score": F.lit(None).cast("double")})
        method = F.when(known.isNotNull(), "exact").when(F.col("r_fuzzy").isNotNull(), "fuzzy").when(F.col(c).isNotNull() & (key != ""), "failed")
        score = F.when(known.isNotNull(), 100.0).otherwise(F.col("r_score"))
        met = met.withColumns({f"{out}_id": F.coalesce(known, F.col("r_fuzzy")), f"{out}_method": method, f"{out}_score": score}).drop("r_fuzzy", "r_score")
    return met.drop(*[f"r_{x}_{out}" for out in columns.values() for x in ("key", "exact")])


def valid(start_id: Column, start: Column, end_id: Column, end: Column) -> Column:
    """Chapters lie within their books and don't run backwards within one; books in either order pass."""
    ok = (start >= 1) & (end >= 1) & (start <= chapters_of(start_id)) & (end <= chapters_of(end_id)) & ((start_id != end_id) | (start <= end))
    return F.coalesce(ok, F.lit(False))


def normalize(refs: DataFrame, fuzzy: bool = True) -> DataFrame:
    """Raw references (book_start, start_chapter, book_end, end_chapter and any keys) -> canonical names, ids, chapters filled in, is_valid.

    References with a book that can't be resolved are dropped.
    """
    r = resolve_all(refs, {"book_start": "s", "book_end": "e"}, fuzzy)
    given = F.col("book_end").isNotNull() & (F.trim("book_end") != "")
    r = r.where(F.col("s_id").isNotNull() & (F.col("e_id").isNotNull() | ~given))
    s, e, sid = F.col("start_chapter"), F.col("end_chapter"), F.col("s_id")
    eid = F.coalesce("e_id", "s_id")
    fill = e.isNull()
    start = F.when(fill & s.isNull(), 1).otherwise(s)
    end = F.when(fill & s.isNotNull() & ~given, s).when(fill, chapters_of(F.when(given, F.col("e_id")).otherwise(sid))).otherwise(e)
    keys = [c for c in refs.columns if c not in ("book_start", "start_chapter", "book_end", "end_chapter")]
    out = r.select(*keys, sid.alias("start_id"), start.cast("int").alias("start_chapter"), eid.alias("end_id"), end.cast("int").alias("end_chapter"), "s_method", "e_method")
    return out.select(
        *keys, name_of(F.col("start_id")).alias("book_start"), "start_chapter", name_of(F.col("end_id")).alias("book_end"), "end_chapter", "start_id", "end_id",
        valid(F.col("start_id"), F.col("start_chapter"), F.col("end_id"), F.col("end_chapter")).alias("is_valid"), "s_method", "e_method",
    )


def statistics(resolved: DataFrame, *methods: str) -> DataFrame:
    """method, n: each book resolved counts by itself."""
    each = F.explode(F.array_compact(F.array(*[F.col(m) for m in methods])))
    return resolved.select(each.alias("method")).groupBy("method").agg(F.count("*").alias("n"))
