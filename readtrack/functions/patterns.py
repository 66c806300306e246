"""Classes of messages by the shape of their references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import EMOJI_ONE

#: What joins the ends of a range, and the classes of messages.
DASH, WORD = r"\s*[-\x{2013}\x{2014}]{1,2}\s*", r"\s+(?:sampai|sampe|hingga|to)\s+"
POOLS = ["cross_chapter_verse", "verse_range", "single_verse", "cross_book", "chapter_range", "single_chapter", "book_only", "multi", "none", "noisy"]
_TO, _VERSE = f"(?:{DASH}|{WORD})", r"\d+:\d+"
#: Shapes from the most telling to the least; what has none is book_only.
SHAPES = [
    ("cross_chapter_verse", f"(?i){_VERSE}{_TO}{_VERSE}"),
    ("verse_range", rf"(?i){_VERSE}{_TO}\d+(?!\s*:)|\d+{DASH}{_VERSE}"),
    ("single_verse", _VERSE),
    ("cross_book", rf"(?i)\d+{_TO}[A-Za-z]"),
    ("chapter_range", rf"(?i)\d+{_TO}\d+"),
    ("single_chapter", r"\d"),
]


def shape_of(ref: Column) -> Column:
    out = F.lit("book_only")
    for name, pattern in reversed(SHAPES):
        out = F.when(ref.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def is_noisy(message: Column) -> Column:
    """Emoji, symbols (So, Sm) or markdown marks."""
    return F.coalesce(message.rlike(rf"[_*\p{{So}}\p{{Sm}}]|{EMOJI_ONE}"), F.lit(False))


def pattern_of(message: Column, refs: Column) -> Column:
    """The class of a message with the texts of its references (an array; null like empty)."""
    n = F.coalesce(F.size(refs), F.lit(0))
    return F.when(is_noisy(message), "noisy").when(n <= 0, "none").when(n >= 2, "multi").otherwise(shape_of(F.get(refs, F.lit(0))))
