"""References in free text by rules: native regular expressions, the most specific first.

Each shape of a reference is a row of parts; its expression is put together from them. Each finds its matches in the whole
text; a match that overlaps one kept earlier is dropped. A match's place is the summed length of the pieces and
matches before it. Book names are one prefix tree, so a place where none starts fails at its first letter, and a shape whose
marks (digit, colon, dash, word) aren't in the text isn't tried.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import aliases
from ..functions.patterns import DASH, WORD

SPAN = "array<struct<start:int,end:int,label:string,text:string>>"
FOUND = "array<struct<prio:int,start:int,end:int,text:string>>"
#: The shapes of a reference, in the order in which they are tried. book, chapter, until and other are
#: fields; `sole` is a book that nothing of a word or number follows; verse and number say nothing about chapters.
SHAPES = """
book chapter verse dash until verse
book chapter verse word until verse
book chapter verse dash number
book chapter dash until verse
book chapter verse
book chapter dash other until
book chapter word other until
book chapter dash until
book chapter word until
book chapter
sole
"""
FIELD = {"book": "book_start", "sole": "book_start", "chapter": "start_chapter", "other": "book_end", "until": "end_chapter"}
#: What the text must hold for a part to match.
NEEDS = {"chapter": r"(?U)\d", "verse": ":", "dash": r"[-\x{2013}\x{2014}]", "word": f"(?iU){WORD}"}
FLAGS, MARKS = "(?iU)", "\ue000\ue001"


def any_of(names: list[str]) -> str:
    """One expression for all names, case apart, that prefers the longest: a tree of their letters."""
    tree: dict = {}
    for name in names:
        node = tree
        for c in name.lower():
            node = node.setdefault(c, {})
        node[""] = {}

    def spelt(node: dict) -> str:
        ways = [(c if c.isalnum() else f"\\{c}") + spelt(node[c]) for c in sorted(x for x in node if x)]
        if not ways:
            return ""
        many = len(ways) > 1 or "" in node
        return (f"(?:{'|'.join(ways)})" if many else ways[0]) + ("?" if "" in node else "")

    return spelt(tree)


def patterns(names: list[str] | None = None) -> list[tuple[str, dict[str, int], list[str]]]:
    """(pattern, groups by field, needs) by priority. names: what books are called, the catalogue's aliases by default."""
    named = rf"(?<![A-Za-z])({any_of(names or [a for a, _, _ in aliases()])}\.?)"
    part = {"book": named, "other": named, "sole": rf"{named}(?![A-Za-z\d])", "chapter": r"\s*(\d+)", "until": r"(\d+)", "verse": r":\d+", "number": r"\d+", "dash": DASH, "word": WORD}
    out = []
    for shape in SHAPES.split("\n")[1:-1]:
        parts = shape.split()
        fields = [FIELD[x] for x in parts if x in FIELD]
        spelt = "".join(r"\s*" + part[x] if x == "until" and parts[i - 1] == "other" else part[x] for i, x in enumerate(parts))
        out.append((FLAGS + spelt, {f: i for i, f in enumerate(fields, 1)}, sorted({NEEDS[x] for x in parts if x in NEEDS})))
    return out


@lru_cache(1)
def digits() -> tuple[str, str]:
    """All decimal digits, and their values."""
    every = [c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
    return "".join(every), "".join(str(unicodedata.digit(c)) for c in every)


def _matches(text: Column, prio: int, pattern: str, needs: list[str]) -> Column:
    start = F.struct(F.lit(0).alias("at"), F.array().cast(FOUND).alias("out"))
    # Splitting by a pattern would compile it for each row; matches become one mark, and one like it in the text another of its kind.
    gaps = F.split(F.regexp_replace(F.translate(text, MARKS[0], MARKS[1]), pattern, MARKS[0]), MARKS[0], -1)
    pairs = F.arrays_zip(gaps.alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["hit"]), F.lit(0))
        one = F.struct(F.lit(prio).alias("prio"), begin.alias("start"), end.alias("end"), x["hit"].alias("text"))
        return F.struct(end.alias("at"), F.when(x["hit"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(one))).alias("out"))

    has = F.lit(True)
    for need in needs:
        has = has & (text.contains(need) if re.fullmatch(":", need) else text.rlike(need))
    return F.when(has, F.aggregate(pairs, start, step)["out"]).otherwise(F.array().cast(FOUND))


def found(text: Column, rules: list[tuple] | None = None) -> Column:
    """Matches kept (prio, start, end, text), by start; offsets count code points, ends are excluded."""
    rules = rules or patterns()
    every = F.flatten(F.array(*[_matches(text, i, p, needs) for i, (p, _, needs) in enumerate(rules)]))
    free = lambda kept, c: ~F.exists(kept, lambda k: (c["start"] < k["end"]) & (k["start"] < c["end"]))
    kept = F.aggregate(every, F.array().cast(FOUND), lambda acc, c: F.when(free(acc, c), F.concat(acc, F.array(c))).otherwise(acc))
    by_start = F.array_sort(F.transform(kept, lambda k: F.struct(k["start"].alias("start"), k["end"].alias("end"), k["prio"].alias("prio"), k["text"].alias("text"))))
    return F.coalesce(by_start, F.array().cast("array<struct<start:int,end:int,prio:int,text:string>>"))


def as_spans(matches: Column) -> Column:
    return F.transform(matches, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lit("BIBLE_REF").alias("label"), m["text"].alias("text")))


def as_structures(matches: Column, rules: list[tuple] | None = None) -> Column:
    """book_start, start_chapter, book_end, end_chapter of each match, from its own pattern's groups."""
    rules = rules or patterns()

    def field(m, name: str, kind: str):
        out = F.lit(None).cast("string")
        for i, (pattern, groups, _) in reversed(list(enumerate(rules))):
            if name in groups:
                out = F.when(m["prio"] == i, F.nullif(F.regexp_extract(m["text"], pattern, groups[name]), F.lit(""))).otherwise(out)
        return (F.regexp_replace(out, r"\.$", "") if kind == "string" else F.translate(out, *digits()).try_cast(kind)).alias(name)

    return F.transform(matches, lambda m: F.struct(field(m, "book_start", "string"), field(m, "start_chapter", "int"), field(m, "book_end", "string"), field(m, "end_chapter", "int")))


def annotate(df: DataFrame, text: str = "message", mask: Column | None = None, rules: list[tuple] | None = None) -> DataFrame:
    """Adds ner_spans and bible_ref_count; rows outside the mask get none."""
    spans = as_spans(found(F.col(text), rules))
    if mask is not None:
        spans = F.when(mask, spans).otherwise(F.array().cast(SPAN))
    return df.withColumn("ner_spans", spans).withColumn("bible_ref_count", F.size("ner_spans"))


def label(df: DataFrame) -> DataFrame:
    """category: report where there is a reference."""
    return df.withColumn("category", F.when(F.col("bible_ref_count") >= 1, "report").otherwise("not report"))
