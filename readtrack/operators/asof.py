"""Backward as-of joins: each row of one table with the last row of another at or before its time.

Rows and probes are sorted together once, so no pair of them is ever made. A key's history is cut into slices of time
that hold about equally many rows, and each slice is a group of its own: a key with a third of all rows is
spread over all slices. What was last in earlier slices comes from one row a key and slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICES = 32


def edges_of(rows: DataFrame, at: str, slices: int) -> list[str]:
    """Times that part the rows into slices, as text; equal times stay together."""
    found = rows.agg(F.percentile_approx(at, [i / slices for i in range(1, slices)], 1000).cast("array<string>").alias("e")).first()["e"] if slices > 1 else None
    return list(dict.fromkeys(found or []))


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str, take: list[str], ties: list[str] | None = None, slices: int = SLICES) -> DataFrame:
    """The rows of `left` with columns `take` of the last row of `right` that has the same `by` and a time not after theirs.

    Of rows at the same time the greatest by `ties` (all of `take`, unless given) is the last. Every left row is there once; without a match, with a
    null key or a null time its new columns are null. Right rows with a null key or time match nothing. Repeated rows are
    rows of their own, and columns that both tables have don't meet: of the right one only `take` is read.
    """
    clash = {c.lower() for c in left.columns} & {c.lower() for c in take}
    if clash:
        raise ValueError(f"columns of both tables: {sorted(clash)}")
    quoted = lambda names: [F.col(f"`{c}`") for c in names]
    key = [f"k{i}" for i in range(len(by))]
    named = [c.alias(k) for c, k in zip(quoted(by), key, strict=True)]
    time = left.schema[left_on].dataType.simpleString()
    value, order = F.struct(*quoted(take)), F.struct(*quoted(ties or take))
    reads = right.select(*named, F.col(f"`{right_on}`").cast(time).alias("at"), F.lit(0).alias("probe"), order.alias("tie"), value.alias("value"))
    reads = reads.where(" and ".join(f"{c} is not null" for c in [*key, "at"]))
    shape = reads.schema
    probes = left.select(*named, F.col(f"`{left_on}`").alias("at"), F.lit(1).alias("probe"), F.lit(None).cast(shape["tie"].dataType).alias("tie"), F.lit(None).cast(shape["value"].dataType).alias("value"), F.struct(*quoted(left.columns)).alias("row"))
    edges = edges_of(reads.select("at"), "at", slices)
    number = F.size(F.filter(F.array(*[F.lit(e).cast(time) for e in edges]), lambda e: e <= F.col("at"))) if edges else F.lit(0)
    number = F.greatest(number, F.lit(0)).alias("slice")
    both = reads.withColumn("row", F.lit(None).cast(probes.schema["row"].dataType)).unionByName(probes).withColumn("slice", number)
    within = Window.partitionBy(*key, "slice").orderBy("at", "probe", "tie", "value").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("near", F.last("value", ignorenulls=True).over(within)).where("probe = 1")
    ends = reads.withColumn("slice", number).groupBy(*key, "slice").agg(F.max(F.struct("at", "tie", "value")).alias("end"))
    # A key's last row before each slice: as many rows as there are slices from its first on.
    later = ends.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("slice", F.col("end.value").alias("value")))).alias("ends"))
    later = later.select(*key, "ends", F.explode(F.sequence(F.col("ends")[0]["slice"] + 1, F.lit(max(len(edges) + 1, 1)))).alias("slice"))
    before = F.filter("ends", lambda e: e["slice"] < F.col("slice"))
    later = later.select(*key, "slice", F.element_at(before, -1)["value"].alias("far"))
    found = seen.join(later, [*key, "slice"], "left").select("row", F.coalesce("near", "far").alias("value"))
    return found.select("row.*", *[F.col("value").getField(c).alias(c) for c in take])
