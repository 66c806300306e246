"""Span texts to raw references: tokens, then a small grammar over the tokens' kinds.

Kinds are spelt one letter a token (R range, : ; , marks, D a number 1 to 3, N another number, W word),
so that each shape of a reference is a regular expression over that spelling. A book read earlier in the
message serves for chapters without one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The fields of a reference, the tokens of a span, the words of a range and the books named by a doubled word.
REF = "book_start string, start_chapter int, book_end string, end_chapter int"
TOKEN = r"[\x{2014}\x{2013}-]|sampai|sampe|smpe|hingga|s\s*/\s*d|s\.d\.|sd|:|;|,|[a-z]+2\b|\d+|[a-z]+(?:-[a-z]+)*"
RANGE = r"^(?:[\x{2014}\x{2013}-]|sampai|sampe|smpe|hingga|s\s*/\s*d|s\.d\.|sd)$"
ROOTS = {"raja", "hakim"}


def tokens(text: Column) -> Column:
    """array<struct<kind,value>>; doubled words ("raja2") are spelt out."""
    double = r"^([a-z]+)2$"
    return F.transform(
        F.regexp_extract_all(F.lower(text), F.lit(f"({TOKEN})"), F.lit(1)),
        lambda x: F.struct(
            F.when(x.rlike(RANGE), "RANGE").when(x == ":", "COLON").when(x == ";", "SEMI").when(x == ",", "COMMA").when(x.rlike(r"^\d+$"), "NUM").otherwise("WORD").alias("kind"),
            F.when(x.rlike(double), F.concat_ws("-", F.regexp_extract(x, double, 1), F.regexp_extract(x, double, 1))).otherwise(x).alias("value"),
        ),
    )


_BOOK = re.compile(r"D?W{1,3}")
_TWO_NUMBERS = re.compile(r"[DN]R[DN]")
_CHAPTER = re.compile(r"([DN])(?::[DN]?(?:R([DN]):[DN]?|R[DN])?)?")
_END = re.compile(r"([DN])(?::[DN]?)?")
_LIST = re.compile(r"(?:,[DN]?)+")
_LETTER = {"RANGE": "R", "COLON": ":", "SEMI": ";", "COMMA": ",", "WORD": "W"}


class Reader:
    """Reads one span's tokens from left to right."""

    def __init__(self, kinds: list[str], values: list[str], book: str | None):
        self.values, self.book, self.at = values, book, 0
        self.spelt = "".join(_LETTER.get(k) or ("D" if v in ("1", "2", "3") else "N") for k, v in zip(kinds, values, strict=True))

    def number(self, at: int) -> int:
        return int(self.values[at])

    def take_book(self, at: int) -> tuple[str, int] | None:
        hit = _BOOK.match(self.spelt, at)
        if not hit:
            return None
        words, at = self.values[at : hit.end()], hit.end()
        if self.spelt.startswith("RW", at):
            a, b = words[-1], self.values[at + 1]
            if a == b or {a, b} & ROOTS:
                words, at = [*words[:-1], f"{a}-{b}"], at + 2
        return " ".join(words), at

    def refs(self) -> Iterator[tuple]:
        while self.at < len(self.values):
            before = self.at
            if self.spelt[self.at] in ":;,":
                self.at += 1
            else:
                yield from self.segment()
            assert self.at > before

    def segment(self) -> Iterator[tuple]:
        if _TWO_NUMBERS.match(self.spelt, self.at) and (book := self.take_book(self.at + 3)) and not book[0][0].isdigit():
            first, last = (f"{self.values[self.at + i]} {book[0]}" for i in (0, 2))
            self.at, self.book = book[1], last
            yield first, None, last, None
            return
        start, at = self.take_book(self.at) or (self.book, self.at)
        if start is None:
            self.at += 1
            return
        chapter = until = other = None
        if hit := _CHAPTER.match(self.spelt, at):
            chapter, at = self.number(hit.start(1)), hit.end()
            until = self.number(hit.start(2)) if hit[2] else None
            if self.spelt.startswith("R", at):
                at += 1
                if book := self.take_book(at):
                    other, at = book
                if end := _END.match(self.spelt, at):
                    until, at = self.number(end.start(1)), (end.end())
                other = None if other == start else other
            elif more := _LIST.match(self.spelt, at):
                self.at, self.book = more.end(), start
                yield start, chapter, None, None
                for i in range(more.start(), more.end()):
                    if self.spelt[i] != ",":
                        yield start, self.number(i), None, None
                return
        elif self.spelt.startswith("R", at):
            other, at = self.take_book(at + 1) or (None, at + 1)
        self.at, self.book = at, other or start
        yield start, chapter, other, until


def parse(spans: list[tuple[list[str], list[str]]], book: str | None = None) -> list[tuple]:
    """References of a message's spans (kinds, values), the book carried from span to span."""
    out = []
    for kinds, values in spans:
        reader = Reader(kinds, values, book)
        out += reader.refs()
        book = reader.book
    return out


def parse_refs(spans: Column) -> Column:
    """array<string> of span texts -> array of raw references; chapters too large for an int are null."""

    @F.pandas_udf(f"array<struct<{REF.replace(' ', ':').replace(',:', ',')}>>")
    def run(col: pd.Series) -> pd.Series:
        out = []
        for message in col:
            spelt = [[t.split(" ", 1) for t in s.split("\n") if t] for s in (message if message is not None else []) if s is not None]
            found = parse([([k for k, _ in s], [v for _, v in s]) for s in spelt])
            fit = [(a, b if b is None or b < 2**31 else None, c, d if d is None or d < 2**31 else None) for a, b, c, d in found]
            out.append([dict(zip(("book_start", "start_chapter", "book_end", "end_chapter"), r, strict=True)) for r in fit])
        return pd.Series(out)

    given = F.coalesce(spans, F.array().cast("array<string>"))
    return run(F.transform(given, lambda s: F.array_join(F.transform(tokens(s), lambda t: F.concat(t["kind"], F.lit(" "), F.regexp_replace(t["value"], r"\s", ""))), "\n")))


def spans_of_hits(hits: Column) -> Column:
    """Texts of a tagger's hits (entity_group, word, ...) that are references."""
    return F.transform(F.filter(hits, lambda h: h["entity_group"] == "BIBLE_REF"), lambda h: h["word"])


def llm_refs(answer: Column) -> Column:
    """References in a language model's JSON answer; what can't be read is none."""
    body = F.regexp_extract(answer, r"(?s)(\[.*\])", 1)
    return F.coalesce(F.from_json(body, f"array<struct<{REF.replace(' ', ':').replace(',:', ',')}>>"), F.array().cast(f"array<struct<{REF.replace(' ', ':').replace(',:', ',')}>>"))
