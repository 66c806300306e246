"""Splits, tiers and exports for annotation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


BUCKET_DIGITS = 3


def drawn(df: DataFrame, stratum: str, key: str, seed: int) -> DataFrame:
    """Adds place (from 1, in each stratum, in the order of a seeded hash of the key) and total (rows of the stratum).

    A stratum may hold most rows, so it is ranked in buckets of the hash: the counts of buckets before, and a place within the bucket.
    """
    order = F.md5(F.concat(F.lit(f"{seed}/"), F.col(key).cast("string")).cast("binary"))
    cut = df.withColumns({"d_hash": order, "d_bucket": F.left(order, F.lit(BUCKET_DIGITS))})
    sizes = cut.groupBy(F.col(stratum).alias("d_stratum"), F.col("d_bucket").alias("d_b")).agg(F.count("*").alias("d_n"))
    every = Window.partitionBy("d_stratum")
    sizes = sizes.withColumns({"d_before": F.sum("d_n").over(every.orderBy("d_b")) - F.col("d_n"), "total": F.sum("d_n").over(every)})
    met = cut.join(sizes, F.col(stratum).eqNullSafe(F.col("d_stratum")) & (F.col("d_bucket") == F.col("d_b")))
    within = F.row_number().over(Window.partitionBy(stratum, "d_bucket").orderBy("d_hash", key))
    return met.withColumn("place", F.col("d_before") + within).drop("d_hash", "d_bucket", "d_stratum", "d_b", "d_n", "d_before")


def stratified_split(df: DataFrame, stratum: str, key: str, shares: tuple = (0.8, 0.1, 0.1), names: tuple = ("train", "val", "test"), seed: int = 42) -> DataFrame:
    """Adds split: in each stratum, shares of the rows in the order of a seeded hash."""
    place = (F.col("place") - 1) / F.col("total")
    out, up = F.lit(names[-1]), sum(shares[:-1])
    for share, name in reversed(list(zip(shares[:-1], names[:-1], strict=True))):
        out = F.when(place < up - 1e-12, F.lit(name)).otherwise(out)
        up -= share
    return drawn(df, stratum, key, seed).withColumn("split", out).drop("place", "total")


def tier_schedule(sizes: dict[str, int], budgets: list[tuple[int, int]], drain: int = 35) -> list[tuple[int, dict[str, int]]]:
    """What each tier draws from each pool: pools of up to `drain` rows all go to the first tier; the rest of a
    tier's budget is shared equally, round after round, the first pools taking what doesn't divide."""
    left = dict(sizes)
    tiny = [p for p, n in sizes.items() if n <= drain]
    tiers = []
    for i, (total, budget) in enumerate(budgets):
        draw = dict.fromkeys(sizes, 0)

        def take(pool, n, draw=draw):
            n = min(n, left[pool])
            draw[pool] += n
            left[pool] -= n
            return n

        if i == 0:
            budget -= sum(take(p, left[p]) for p in tiny)
        open_ = [p for p in sizes if p not in tiny and left[p]]
        while budget > 0 and open_:
            each, over = divmod(budget, len(open_))
            budget -= sum(take(p, each + (k < over)) for k, p in enumerate(open_))
            open_ = [p for p in open_ if left[p]] if each else []
        tiers.append((total, draw))
    return tiers


def tier_sample(df: DataFrame, stratum: str, key: str, tiers: list[tuple[int, dict[str, int]]], seed: int = 42) -> DataFrame:
    """Rows with the tier that draws them (from 1); the others are left over (null). No row is drawn twice."""
    tier, up = F.lit(None).cast("int"), {}
    bounds = []
    for i, (_, draw) in enumerate(tiers, 1):
        for pool, n in draw.items():
            bounds.append((pool, up.get(pool, 0), up.get(pool, 0) + n, i))
            up[pool] = up.get(pool, 0) + n
    for pool, low, high, i in bounds:
        if high > low:
            tier = F.when((F.col(stratum) == pool) & (F.col("place") > low) & (F.col("place") <= high), F.lit(i)).otherwise(tier)
    return drawn(df, stratum, key, seed).withColumn("tier", tier).drop("place", "total")


def annotation_tasks(df: DataFrame, text: str, spans: str, *keys: str) -> DataFrame:
    """json: a labelling task a row, the spans as predictions."""
    one = lambda s: F.struct(
        F.lit("label").alias("from_name"), F.lit("text").alias("to_name"), F.lit("labels").alias("type"),
        F.struct(s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text"), F.array(s["label"]).alias("labels")).alias("value"),
    )
    task = F.struct(F.struct(F.col(text).alias("text")).alias("data"), F.array(F.struct(F.transform(spans, one).alias("result"))).alias("predictions"))
    return df.select(*keys, F.to_json(task).alias("json"))
