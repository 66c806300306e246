"""Numbers in an order over all rows, without sorting them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE, BUCKETS = 1024, 32


def edges(df: DataFrame, by: str, buckets: int = BUCKETS) -> list:
    """Values of a column that part its rows into about equal buckets: from the SAMPLE distinct ones of the least hash, which is all that the driver gets."""
    drawn = df.select(F.col(by).alias("v")).where("v is not null").distinct().orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()
    found = sorted(r["v"] for r in drawn)
    return sorted({found[i * len(found) // buckets] for i in range(1, buckets)}) if found else []


def numbered(df: DataFrame, name: str, by: str, *order: Column | str) -> DataFrame:
    """Adds the rows' numbers from 1 in the order of (by, *order), nulls first: the counts of buckets before, and a place within the bucket.

    Buckets are ranges of `by` that a sample of its values parts; the numbers don't depend on it. Rows with one value of `by` are in one bucket.
    """
    kind = df.schema[by].dataType.simpleString()
    cut = [F.lit(str(e)).cast(kind) for e in edges(df, by)]
    bucket = F.size(F.filter(F.array(*cut), lambda e: e <= F.col(by))) if cut else F.lit(0)
    cut = df.withColumn("n_bucket", bucket)
    sizes = cut.groupBy(F.col("n_bucket").alias("n_of")).agg(F.count("*").alias("n_rows"))
    sizes = sizes.withColumn("n_before", F.sum("n_rows").over(Window.orderBy("n_of")) - F.col("n_rows"))
    met = cut.join(F.broadcast(sizes), F.col("n_bucket") == F.col("n_of"))  # a row a bucket
    within = F.row_number().over(Window.partitionBy("n_bucket").orderBy(by, *order))
    return met.withColumn(name, (F.col("n_before") + within).cast("int")).drop("n_bucket", "n_of", "n_rows", "n_before")
