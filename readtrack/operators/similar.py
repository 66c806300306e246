"""Similarity joins of short names by an index of their letter pairs.

The similarity is `partial_ratio`: of the shorter name (n letters) with the stretch of the longer that is most like it. For a score of 80 and
more a stretch of m letters, 2n/3 at least, and the name have at least L = 0.4 (n + m) letters in common, in order; n + m - 2 L edits break one pair of
neighbours each, so L - 1 - (n + m - 2 L) pairs of neighbours stay in both. Pairs of names that share as many are candidates, found by an
equi-join on postings, and only these are compared. Where the bound is nothing, postings of their own take its place: a name of one letter is asked for
by that letter, and one of three letters, of which two lie at the cut end of the other, by any two of its letters in order at either end.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .resolve import partial_ratio

LEAST = 80.0


def shared_pairs(n: int) -> int:
    """How many neighbouring letters a name of n letters shares with every name that is like it: the least over all stretches."""
    return min(3 * -(-2 * (n + m) // 5) - 1 - (n + m) for m in range(-(-2 * n // 3), n + 1))


def pairs_of(name: Column) -> Column:
    """Each two neighbouring letters with the number of times they occurred before, so that repeated ones count."""
    n = F.length(name)
    two = F.when(n >= 2, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(name, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
    return F.transform(two, lambda x, i: F.concat(x, F.size(F.filter(F.slice(two, 1, i), lambda y: y == x)).cast("string")))


def special(name: Column, short: str, long: str) -> Column:
    """Postings for names of one and of three letters, asking (by the mark `short`) and asked for (`long`)."""
    n, at = F.length(name), lambda i: F.substring(name, F.lit(i), F.lit(1))
    two = [F.concat(at(1), at(2)), F.concat(at(2), at(3)), F.concat(at(1), at(3))]
    ask = F.when(n == 1, F.array(F.concat(F.lit(f"{short}1"), name))).when(n == 3, F.array(*[F.concat(F.lit(f"{short}{end}"), x) for end in "^$" for x in two])).otherwise(F.array().cast("array<string>"))
    letters = F.transform(F.filter(F.array_distinct(F.split(name, "")), lambda c: c != ""), lambda c: F.concat(F.lit(f"{long}1"), c))
    ends = F.when(n >= 2, F.array(F.concat(F.lit(f"{long}^"), F.left(name, F.lit(2))), F.concat(F.lit(f"{long}$"), F.right(name, F.lit(2))))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(ask, letters, ends))


def candidates(keys: DataFrame, names: DataFrame) -> DataFrame:
    """(key, name): all pairs with a score of 80 and more, and some others. keys (key), names (name), each name once."""

    def postings(df: DataFrame, column: str, marks: tuple[str, str]) -> DataFrame:
        each = F.concat(F.transform(pairs_of(F.col(column)), lambda x: F.struct(x.alias("gram"), F.lit(False).alias("sure"))), F.transform(special(F.col(column), *marks), lambda x: F.struct(x.alias("gram"), F.lit(True).alias("sure"))))
        return df.where(F.length(column) > 0).select(column, F.explode(each).alias("p")).select(column, "p.gram", "p.sure")

    # A key's mark for asking is a name's mark for being asked, and the other way round.
    met = postings(keys, "key", ("\x01", "\x02")).join(postings(names, "name", ("\x02", "\x01")), ["gram", "sure"])
    found = met.groupBy("key", "name").agg(F.max("sure").alias("sure"), F.count_if(~F.col("sure")).alias("n"))
    n = F.least(F.length("key"), F.length("name"))
    bounds = [shared_pairs(i) for i in range(1, 60)] + [min(shared_pairs(i) for i in range(60, 65))]  # five letters more never lower the bound
    need = F.get(F.array(*[F.lit(x) for x in bounds]), F.least(n, F.lit(len(bounds))) - 1)
    return found.where(F.col("sure") | (F.col("n") >= F.greatest(need, F.lit(1)))).select("key", "name")


def similar(keys: DataFrame, names: DataFrame, threshold: float = LEAST) -> DataFrame:
    """key, name, score of all pairs at or above the threshold, which is 80 at least. Empty and null ones are like nothing."""
    if threshold < LEAST:
        raise ValueError(f"the index holds for scores of {LEAST:g} and more")

    def run(frames):
        for frame in frames:
            score = [partial_ratio(a, b, threshold) for a, b in zip(frame["key"], frame["name"], strict=True)]
            yield frame.assign(score=pd.Series(score, index=frame.index, dtype=float)).query("score >= @threshold")

    return candidates(keys.select("key").distinct(), names.select("name").distinct()).mapInPandas(run, "key string, name string, score double")


def nearest(keys: DataFrame, names: DataFrame, threshold: float = LEAST) -> DataFrame:
    """key, name, id, score: each key's best name; of equal scores that with the least `ord`. names: name, id, ord."""
    best = F.max(F.struct("score", (-F.col("ord")).alias("o"), "id", "name")).alias("b")
    return similar(keys, names, threshold).join(names, "name").groupBy("key").agg(best).select("key", "b.name", "b.id", "b.score")
