"""Message activity: counts, rates and distributions by time and member."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import numbered

DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """value, n, share: most frequent first."""
    g = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy())).orderBy(F.desc("n"), "value")


def per_day(messages: DataFrame) -> DataFrame:
    return messages.groupBy(F.to_date("timestamp").alias("day")).agg(F.count("*").alias("n"))


def per_hour(messages: DataFrame) -> DataFrame:
    return messages.groupBy(F.hour("timestamp").alias("hour")).agg(F.count("*").alias("n"))


def rolling_mean(days: DataFrame, width: int = 7) -> DataFrame:
    """Adds rolling: the mean of `width` existing rows around each day, null until all are there."""
    half = width // 2
    w = Window.orderBy("day").rowsBetween(-half, width - 1 - half)
    return days.withColumn("rolling", F.when(F.count("n").over(w) == width, F.avg("n").over(w)))


def describe(df: DataFrame, column: str, *by: str) -> DataFrame:
    """count, mean, std, min, quartiles, max; quantiles exact and interpolated."""
    x = F.col(column)
    q = lambda p: F.percentile(x, F.lit(p))
    return df.groupBy(*by).agg(
        F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
        q(0.25).alias("q25"), q(0.5).alias("q50"), q(0.75).alias("q75"), F.max(x).alias("max"),
    )


def top_members(messages: DataFrame, n: int = 20) -> DataFrame:
    return messages.groupBy("sender").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "sender").limit(n)


def consistency(messages: DataFrame, least: int = 5) -> DataFrame:
    """sender, reports, active_days of members with at least `least` reports."""
    g = messages.groupBy("sender").agg(F.count("*").alias("reports"), F.countDistinct(F.to_date("timestamp")).alias("active_days"))
    return g.where(F.col("reports") >= least)


def monthly_volume(messages: DataFrame, is_report: Column) -> DataFrame:
    return messages.groupBy(F.date_trunc("MONTH", "timestamp").cast("date").alias("month")).agg(F.count("*").alias("n"), F.count_if(is_report).alias("reports"))


def weekday_rates(messages: DataFrame, is_report: Column) -> DataFrame:
    """weekday, n, reports, rate from Monday to Sunday; days without messages have null counts and rate 0."""
    spine = messages.sparkSession.createDataFrame(list(enumerate(DAYS)), "ord int, weekday string")
    g = messages.groupBy(F.date_format("timestamp", "EEEE").alias("weekday")).agg(F.count("*").alias("n"), F.count_if(is_report).alias("reports"))
    return spine.join(g, "weekday", "left").withColumn("rate", F.coalesce(F.col("reports") / F.col("n"), F.lit(0.0)))


def monthly_members(messages: DataFrame) -> DataFrame:
    return messages.groupBy(F.date_trunc("MONTH", "timestamp").cast("date").alias("month")).agg(F.countDistinct("sender").alias("members"))


def weekday_by_hour(messages: DataFrame) -> DataFrame:
    """A row a weekday, a column an hour (h0 to h23); missing is 0."""
    spine = messages.sparkSession.createDataFrame([(d,) for d in DAYS], "weekday string")
    at = messages.select(F.date_format("timestamp", "EEEE").alias("weekday"), F.hour("timestamp").alias("hour"))
    g = at.groupBy("weekday").pivot("hour", list(range(24))).count()
    return spine.join(g, "weekday", "left").fillna(0).select("weekday", *[F.col(str(h)).alias(f"h{h}") for h in range(24)])


def by_source(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    return df.groupBy(row).pivot(column, values).count().fillna(0)


def log_histogram(df: DataFrame, column: str, low: float, high: float, bins: int = 50) -> DataFrame:
    """bin, n over equal steps of the logarithm."""
    import math

    x = F.width_bucket(F.ln(column), F.lit(math.log(low)), F.lit(math.log(high)), F.lit(bins))
    return df.where(F.col(column) > 0).groupBy(x.alias("bin")).agg(F.count("*").alias("n"))


def extraction_summary(messages: DataFrame, refs: str) -> DataFrame:
    """total, with_refs, zero_refs, any_invalid and their shares; refs holds structs with is_valid."""
    n = F.size(refs)
    bad = F.exists(refs, lambda r: ~r["is_valid"])
    g = messages.agg(F.count("*").alias("total"), F.count_if(n > 0).alias("with_refs"), F.count_if(n <= 0).alias("zero_refs"), F.count_if(bad).alias("any_invalid"))
    share = lambda c: F.round(100 * F.col(c) / F.col("total"), 1).alias(f"{c}_pct")
    return g.select("*", share("with_refs"), share("zero_refs"), share("any_invalid"))


def explode_refs(messages: DataFrame, refs: str, *keys: str) -> DataFrame:
    return messages.select(*keys, F.explode(refs).alias("r")).select(*keys, "r.*")


def between(messages: DataFrame, first, last) -> DataFrame:
    """The window's messages with row_id, from 0 in time order."""
    start, end = F.lit(first).cast("date").cast("timestamp_ntz"), F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz")
    kept = messages.where((F.col("timestamp") >= start) & (F.col("timestamp") < end))
    return numbered(kept, "row_id", "timestamp", "seq").withColumn("row_id", F.col("row_id") - 1)


def union_sources(frames: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in frames.items():
        tagged = df.withColumn("source", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_sources({k: v.agg(F.count("*").alias("n")) for k, v in tables.items()})


def table_checks(members: DataFrame, messages: DataFrame, refs: DataFrame, progress: DataFrame) -> DataFrame:
    """check, ok: no table is empty, and each valid reference gave a chapter at least."""
    n = {r["source"]: F.lit(r["n"]) for r in table_counts({"members": members, "messages": messages, "refs": refs, "progress": progress}).collect()}
    rows = [(f"{name} are there", n[name] > 0) for name in ("members", "messages", "refs", "progress")] + [("progress covers refs", n["progress"] >= n["refs"])]
    one = members.sparkSession.range(1)
    return one.select(F.explode(F.array(*[F.struct(F.lit(a).alias("check"), b.alias("ok")) for a, b in rows])).alias("r")).select("r.*")


def density(df: DataFrame, group: str, value: str, bins: int = 128, points: int = 32) -> DataFrame:
    """Gaussian kernel density of each group: `points` places from its least to its largest value, the bandwidth by Scott's rule (deviation * n ** -0.2).

    Values are counted in `bins` of equal width first, and the counts are convolved with the kernel: the work after counting doesn't grow with the rows.
    Groups of one value only have no density. Null values don't count.
    """
    v = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).where("v is not null")
    of = v.groupBy("g").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n"), F.stddev_samp("v").alias("sd")).where("hi > lo").withColumnRenamed("g", "k")
    bin_ = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    met = v.join(of, F.col("g").eqNullSafe(F.col("k"))).drop("k")
    counts = met.groupBy("g", "lo", "hi", "n", "sd", bin_.alias("bin")).agg(F.count("*").alias("c"))
    held = counts.groupBy("g", "lo", "hi", "n", "sd").agg(F.array_sort(F.collect_list(F.struct("bin", "c"))).alias("counts"))
    width, h = (F.col("hi") - F.col("lo")) / bins, F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    at = F.col("lo") + F.col("point") * (F.col("hi") - F.col("lo")) / (points - 1)
    near = lambda c: c["c"] * F.exp(-0.5 * F.pow((at - (F.col("lo") + (c["bin"] + 0.5) * width)) / h, F.lit(2.0)))
    sum_ = F.aggregate("counts", F.lit(0.0), lambda a, c: a + near(c))
    out = held.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    return out.select(F.col("g").alias(group), "point", at.alias("place"), (sum_ / (F.col("n") * h * math.sqrt(2 * math.pi))).alias("density"))


def box(df: DataFrame, group: str, value: str, reach: float = 1.5) -> DataFrame:
    """Quartiles of each group, the last values within `reach` interquartile ranges of them, and how many lie beyond. Null values don't count."""
    v = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).where("v is not null")
    q = v.groupBy("g").agg(F.percentile("v", [0.25, 0.5, 0.75]).alias("q")).select(F.col("g").alias("h"), *[F.col("q")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))])
    met = v.join(q, F.col("g").eqNullSafe(F.col("h")))
    far = (F.col("q3") - F.col("q1")) * reach
    inside = (F.col("v") >= F.col("q1") - far) & (F.col("v") <= F.col("q3") + far)
    whiskers = [F.min(F.when(inside, F.col("v"))).alias("low"), F.max(F.when(inside, F.col("v"))).alias("high"), F.count_if(~inside).alias("outliers")]
    return met.groupBy(F.col("g").alias(group), "q1", "median", "q3").agg(F.count("*").alias("n"), *whiskers)


def activity_cube(messages: DataFrame) -> DataFrame:
    """Messages and members by month and weekday (1: Monday), by each of them, and in all; `level` tells which are summed up (1 weekday, 2 month, 3 both)."""
    m = messages.select(F.trunc("timestamp", "month").alias("month"), (F.weekday("timestamp") + 1).alias("weekday"), "sender")
    return m.cube("month", "weekday").agg(F.grouping_id().cast("int").alias("level"), F.count("*").alias("n"), F.count_distinct("sender").alias("members"))


def activity_rollup(messages: DataFrame) -> DataFrame:
    """Messages by month, by day within it, and in all."""
    m = messages.select(F.trunc("timestamp", "month").alias("month"), F.to_date("timestamp").alias("day"))
    return m.rollup("month", "day").agg(F.grouping_id().cast("int").alias("level"), F.count("*").alias("n"))


def daily_sketches(messages: DataFrame, value: str = "chars") -> DataFrame:
    """day, who (a sketch of the day's distinct members), size (a sketch of a whole number's quantiles): small, and to be merged over any days."""
    return messages.groupBy(F.to_date("timestamp").alias("day")).agg(F.hll_sketch_agg("sender", F.lit(14)).alias("who"), F.kll_sketch_agg_bigint(F.col(value).cast("long"), F.lit(400)).alias("size"))


def monthly_estimates(sketches: DataFrame) -> DataFrame:
    """month, days, members (about 1 % off), median: from the days' sketches alone."""
    return sketches.groupBy(F.trunc("day", "month").alias("month")).agg(
        F.count("*").alias("days"), F.hll_sketch_estimate(F.hll_union_agg("who")).alias("members"), F.kll_sketch_get_quantile_bigint(F.kll_merge_agg_bigint("size"), F.lit(0.5)).alias("median")
    )
