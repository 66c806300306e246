"""Text cleaning and scalar string functions, all native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Emoji by code-point ranges (an approximation of the Unicode emoji list), with their joiners and modifiers.
EMOJI_ONE = r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}\x{1F1E6}-\x{1F1FF}\x{231A}\x{231B}\x{23E9}-\x{23FA}\x{2934}\x{2935}\x{3030}\x{303D}\x{3297}\x{3299}]"
EMOJI = rf"(?:[0-9#*]\x{{FE0F}}?\x{{20E3}}|[\x{{1F1E6}}-\x{{1F1FF}}]{{2}}|{EMOJI_ONE}\x{{FE0F}}?[\x{{1F3FB}}-\x{{1F3FF}}]?(?:\x{{200D}}{EMOJI_ONE}\x{{FE0F}}?[\x{{1F3FB}}-\x{{1F3FF}}]?)*)"


def remove_invisible(x: Column) -> Column:
    """Control, format and other C* characters go; line feeds and tabs stay; null is ''."""
    return F.regexp_replace(F.coalesce(x, F.lit("")), r"[^\P{C}\n\t]", "")


def normalize_whitespace(x: Column) -> Column:
    """Runs of white space other than line feeds become one space; lines are stripped, and outer line feeds go."""
    one = F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)[^\S\n]+", " ")
    lines = F.regexp_replace(one, r"(?md)^ | $", "")
    return F.regexp_replace(lines, r"^\n+|\n+\z", "")


def clean_text(x: Column) -> Column:
    return normalize_whitespace(remove_invisible(x))


def preprocess(x: Column) -> Column:
    """Emoji between spaces, line feeds as spaces, runs of spaces as one, stripped. Arrays are joined by spaces first."""
    spaced = F.regexp_replace(x.cast("string"), f"({EMOJI})", " $1 ")
    flat = F.regexp_replace(F.replace(spaced, F.lit("\n"), F.lit(" ")), " {2,}", " ")
    return F.regexp_replace(flat, r"(?U)^\s+|\s+\z", "")


def preprocess_list(x: Column) -> Column:
    return preprocess(F.array_join(F.transform(x, lambda v: v.cast("string")), " "))


def isolate_markdown(x: Column) -> Column:
    """Underscores and asterisks stand alone; white space collapses."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"([_*])", " $1 "), r"(?U)\s+", " "), r"^ | \z", "")


def text_key(x: Column) -> Column:
    """The form in which book names are compared."""
    return F.regexp_replace(F.regexp_replace(F.lower(x), r"(?U)\s+", " "), r"^ | \z", "")


def ordered_distinct(x: Column) -> Column:
    """An array's values, each once, in the order of their first places."""
    return F.array_distinct(x)


def line_count(x: Column) -> Column:
    return F.size(F.split(x, "\n"))


def shape(x: Column) -> Column:
    """What a tagger sees of a token."""
    return F.struct(
        F.lower(x).alias("lower"),
        x.rlike(r"^\p{Lu}[\p{Ll}]*$").alias("is_title"),
        (x.rlike(r"\p{Lu}") & ~x.rlike(r"\p{Ll}")).alias("is_upper"),
        x.rlike(r"^\d+$").alias("is_digit"),
        x.rlike(r"\d").alias("has_digit"),
        x.rlike("-").alias("has_hyphen"),
        F.left(x, F.lit(2)).alias("prefix2"),
        F.left(x, F.lit(3)).alias("prefix3"),
        F.right(x, F.lit(2)).alias("suffix2"),
        F.right(x, F.lit(3)).alias("suffix3"),
        F.length(x).alias("length"),
    )
