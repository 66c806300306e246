"""The library's functions by name, for queries written in SQL alone.

Scalar ones are SQL functions: Catalyst puts their bodies in place, so they cost what the expressions cost. Table functions read
references and fill gaps:

    SELECT m.seq, r.* FROM (SELECT seq, span_tokens(message) AS spelt FROM messages) m, LATERAL read_refs(m.spelt) r
    SELECT * FROM fill_gaps(TABLE(refs) PARTITION BY sender ORDER BY (seq, ord))
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf

from ..catalog import books
from ..operators.grammar import RANGE, REF, TOKEN, parse
from ..operators.progress import PERSISTED, Reader

#: name -> (arguments, result, body). A raw literal holds each pattern as it is.
SCALAR = {
    "remove_invisible": ("x STRING", "STRING", r"regexp_replace(coalesce(x, ''), R'[^\P{C}\n\t]', '')"),
    "normalize_whitespace": ("x STRING", "STRING", r"regexp_replace(regexp_replace(regexp_replace(coalesce(x, ''), R'(?U)[^\S\n]+', ' '), R'(?md)^ | $', ''), R'^\n+|\n+\z', '')"),
    "clean_text": ("x STRING", "STRING", "normalize_whitespace(remove_invisible(x))"),
    "text_key": ("x STRING", "STRING", r"regexp_replace(regexp_replace(lower(x), R'(?U)\s+', ' '), R'^ | \z', '')"),
    "line_count": ("x STRING", "INT", r"size(split(x, R'\n'))"),
    "span_tokens": (
        "x STRING", "ARRAY<STRING>",
        rf"""transform(regexp_extract_all(lower(x), R'({TOKEN})', 1), t -> concat(
  CASE WHEN rlike(t, R'{RANGE}') THEN 'RANGE' WHEN t = ':' THEN 'COLON' WHEN t = ';' THEN 'SEMI' WHEN t = ',' THEN 'COMMA' WHEN rlike(t, R'^\d+$') THEN 'NUM' ELSE 'WORD' END, ' ',
  regexp_replace(regexp_replace(t, R'^([a-z]+)2$', '$1-$1'), R'\s', '')))""",
    ),
}


class ReadRefs:
    """The references of a span, from its tokens; chapters too large for an int are null. A null span has none."""

    def eval(self, spelt: list[str]) -> Iterator[tuple]:
        pairs = [t.split(" ", 1) for t in spelt or []]
        fit = lambda n: n if n is None or n < 2**31 else None
        for i, (a, b, c, d) in enumerate(parse([([k for k, _ in pairs], [v for _, v in pairs])])):
            yield i, a, fit(b), c, fit(d)


class FillGaps:
    """Normalised references of one member in their order, with their gaps filled (see `persist`); rows without a time, a book or a chapter give none."""

    def __init__(self) -> None:
        self.reader, self.chapters = Reader(), {b[0]: b[2] for b in books()}

    def eval(self, row: Row) -> Iterator[tuple]:
        if all(row[c] is not None for c in ("sender", "timestamp", "start_id", "start_chapter", "end_id", "end_chapter")):
            yield self.reader.take(row, self.chapters)


def register(spark: SparkSession) -> None:
    """Makes the functions known to the session."""
    for name, (given, result, body) in SCALAR.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({given}) RETURNS {result} RETURN {body}")
    spark.udtf.register("read_refs", udtf(ReadRefs, returnType=f"ord int, {REF}"))
    spark.udtf.register("fill_gaps", udtf(FillGaps, returnType=PERSISTED))
