"""Precision, recall and F1 of spans, structures and normalised references."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .resolve import THRESHOLD, normalize, resolve

STRUCTURE = ("book_start", "start_chapter", "book_end", "end_chapter")


def scores(counts: DataFrame, *by: str) -> DataFrame:
    """(tp, fp, fn) -> precision, recall, f1 over all rows of a group; 0 where undefined."""
    g = counts.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")])
    p = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    r = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    g = g.withColumns({"precision": p, "recall": r})
    return g.withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))


def structure_key(s: Column) -> Column:
    """Books compare without case, null like empty; chapters as they are."""
    book = lambda c: F.lower(F.coalesce(c, F.lit("")))
    return F.struct(book(s["book_start"]).alias("a"), s["start_chapter"].alias("b"), book(s["book_end"]).alias("c"), s["end_chapter"].alias("d"))


def span_key(s: Column) -> Column:
    return F.struct(s["start"].alias("a"), s["end"].alias("b"), s["label"].alias("c"))


def match_counts(items: DataFrame, pred: str, gold: str, key, *keys: str) -> DataFrame:
    """tp, fp, fn of each row: pred and gold as multisets of equal keys."""
    side = lambda c, w: items.select(*keys, F.explode(F.transform(c, key)).alias("k")).groupBy(*keys, "k").agg(F.count("*").alias(w))
    both = side(pred, "p").join(side(gold, "g"), [*keys, "k"], "full")
    n = both.groupBy(*keys).agg(*[F.sum(F.coalesce(x, F.lit(0))).alias(a) for x, a in (("p", "p"), ("g", "g"))], F.sum(F.least(F.coalesce("p", F.lit(0)), F.coalesce("g", F.lit(0)))).alias("tp"))
    return n.select(*keys, "tp", (F.col("p") - F.col("tp")).alias("fp"), (F.col("g") - F.col("tp")).alias("fn"))


def overlap_ratio(a: Column, b: Column) -> Column:
    """The common stretch over the shorter span."""
    common = F.least(a["end"], b["end"]) - F.greatest(a["start"], b["start"])
    short = F.least(a["end"] - a["start"], b["end"] - b["start"])
    return F.when((common > 0) & (short > 0), common / short).otherwise(0.0)


def partial_counts(items: DataFrame, pred: str, gold: str, *keys: str, threshold: float = 0.5) -> DataFrame:
    """tp, fp, fn with each gold span taken once, by the first predicted span that overlaps it enough."""
    free = F.sequence(F.lit(0), F.size(gold) - 1)
    start = F.struct(F.lit(0).alias("tp"), F.when(F.size(gold) > 0, free).otherwise(F.array().cast("array<int>")).alias("free"))

    def step(acc, p):
        fit = F.filter(acc["free"], lambda i: overlap_ratio(p, F.get(F.col(gold), i)) >= threshold)
        hit = F.get(fit, F.lit(0))
        return F.struct((acc["tp"] + hit.isNotNull().cast("int")).alias("tp"), F.when(hit.isNull(), acc["free"]).otherwise(F.array_remove(acc["free"], hit)).alias("free"))

    tp = F.aggregate(F.col(pred), start, step)["tp"]
    return items.select(*keys, tp.alias("tp"), (F.size(pred) - tp).alias("fp"), (F.size(gold) - tp).alias("fn"))


def set_counts(pred: DataFrame, gold: DataFrame) -> DataFrame:
    """One row of tp, fp, fn of distinct rows (message_id and the four fields)."""
    side = lambda df, n: df.distinct().withColumn(n, F.lit(1))
    p, g = side(pred, "p"), side(gold, "g").withColumnsRenamed({c: f"g_{c}" for c in gold.columns})
    on = [p[c].eqNullSafe(g[f"g_{c}"]) for c in gold.columns]
    both = p.join(g, on, "full")
    return both.agg(F.count_if(F.col("p").isNotNull() & F.col("g").isNotNull()).alias("tp"), F.count_if(F.col("g").isNull()).alias("fp"), F.count_if(F.col("p").isNull()).alias("fn"))


def errors(pred: DataFrame, gold: DataFrame, *keys: str) -> DataFrame:
    """Rows of one side alone, with kind FP or FN."""
    return pred.exceptAll(gold).withColumn("kind", F.lit("FP")).unionByName(gold.exceptAll(pred).withColumn("kind", F.lit("FN"))).select("kind", *keys)


def accuracy_by_position(pred: DataFrame, gold: DataFrame, key: str) -> DataFrame:
    """References beside gold ones of the same place in their message: total (places of either), correct, skipped, accuracy, and each field's
    among gold ones."""
    place = Window.partitionBy(key).orderBy("pos")
    side = lambda df, x: df.withColumn("pos", F.row_number().over(place)).select(key, "pos", *[F.col(c).alias(f"{x}_{c}") for c in STRUCTURE], F.lit(1).alias(x))
    both = side(pred, "p").join(side(gold, "g"), [key, "pos"], "full")
    same = [F.col(f"p_{c}").eqNullSafe(F.col(f"g_{c}")) & F.col("p").isNotNull() for c in STRUCTURE]
    every = same[0] & same[1] & same[2] & same[3]
    there = F.col("g").isNotNull()
    return both.agg(
        F.count("*").alias("total"), F.count_if(every).alias("correct"), F.count_if(there & F.col("p").isNull()).alias("skipped"), F.round(F.avg(every.cast("int")), 4).alias("accuracy"),
        *[F.round(F.avg(F.when(there, x.cast("int"))), 4).alias(f"{c}_accuracy") for x, c in zip(same, STRUCTURE, strict=True)],
    )


def bootstrap(counts: DataFrame, key: str, rounds: int = 1000, seed: int = 42, share: float = 0.95) -> DataFrame:
    """low, mean, high of F1 over rounds that each draw as many messages as there are, with replacement.

    Messages of equal (tp, fp, fn) can't be told apart by F1, so a round draws how often each such kind comes (a multinomial draw, the same
    as drawing messages); nothing is matched or exploded again. `key` names the message.
    """
    kinds = sorted(tuple(r) for r in counts.groupBy(key, "tp", "fp", "fn").count().groupBy("tp", "fp", "fn").agg(F.sum("count")).collect())
    spark = counts.sparkSession

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.array(kinds, np.float64).reshape(-1, 4)
        total = int(table[:, 3].sum())
        for frame in frames:
            f1 = []
            for i in frame["id"].tolist():
                n = np.random.default_rng([seed, i]).multinomial(total, table[:, 3] / total) if total else np.zeros(0)
                tp, fp, fn = (float(n @ table[:, k]) for k in range(3))
                f1.append(2 * tp / (2 * tp + fp + fn) if tp else 0.0)
            yield pd.DataFrame({"f1": f1})

    f1 = spark.range(rounds).mapInPandas(draw, "f1 double")
    edge = (1 - share) / 2
    return f1.agg(F.percentile("f1", F.lit(edge)).alias("low"), F.avg("f1").alias("mean"), F.percentile("f1", F.lit(1 - edge)).alias("high"))


def ablation(raw: DataFrame, gold: DataFrame, key: str) -> DataFrame:
    """strategy (exact, fuzzy) and accuracy_by_position of each: raw references (key, pos, the four fields) normalised without and with fuzzy names."""
    out = []
    for name, fuzzy in (("exact", False), ("fuzzy", True)):
        # What can't be resolved is dropped, so what follows moves up.
        kept = normalize(raw, fuzzy).select(key, "pos", *STRUCTURE)
        out.append(accuracy_by_position(kept, gold, key).withColumn("strategy", F.lit(name)))
    return out[0].unionByName(out[1])


def stress(cases: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(query, expected book_id or null) -> with the book found (null if none), how, and whether that is right."""
    found = resolve(cases, "query", "found", threshold=threshold)
    return found.select("query", "expected", F.col("found_id").alias("found"), F.col("found_method").alias("method"), F.col("found_id").eqNullSafe(F.col("expected")).alias("ok"))
