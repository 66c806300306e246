"""Mixing sources to target weights by pivotal dependent rounding.

Sources by code point (null last) weigh `weights` in turn and share `budget` times all words; no
target exceeds `cap` times its source, and the excess is shared again by weight until none does. A
document's expected copies are its source's target over its source's words: a whole number of
copies and a fraction. Fractions are settled in pairs: a random choice moves words from one
document to the other, both expectations kept, until one fraction is 0 or 1; the sum of words never
changes. Leaves of a few thousand documents each leave one open fraction per source, and a tree
of merges leaves one per source in all. That document lends the leading part of its words that
closes the gap, so a source's words come within one word of its target per repeated row.

Null texts and texts without words have size 0: no word of theirs is taken, and they are copied as often as
their source's share rounds to. Rows with equal doc_id, source and size form one unit and take the same copies. A null
source is a source of its own, a null doc_id an ordinary value. A source without words has target 0.
An empty table gives an empty result. Reruns agree: all draws are seeded by leaf and source. Further columns,
whatever their names, stay with the rows of the mix. Words of very long texts are counted where they lie.
"""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, Scratch, fresh, numbered, parts, table, union_all

WEIGHTS, BUDGET, CAP = (5, 2, 1), 1.5, 2.0
LEAF_ROWS, FAN_IN, SEED = 4096, 16, 42
BROADCAST_SOURCES = 50_000
UNIT = "leaf long, source string, doc_id long, size long, n long, source_size long, target double, copies int, open double"


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): words of every text."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(SPACE)), F.lit(0)).cast("long").alias("size"),
    )


def source_targets(sizes: DataFrame, scratch: Scratch, weights: tuple = WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """(source, source_size, target): one row a source.

    The level (words a unit of weight) rises until no further source reaches its cap; each round is one sum over the sources.
    """
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    own = scratch.keep(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = scratch.keep(numbered(own, "rank", [F.col("source").asc_nulls_last()], scratch).withColumn("weight", weight), "ranked")
    most = F.col("source_size") * F.lit(float(cap))

    def totals(level: float) -> tuple:
        capped = most <= F.col("weight") * F.lit(level)
        row = ranked.agg(
            F.sum("source_size").alias("all"),
            F.coalesce(F.sum(F.when(capped, F.col("source_size"))), F.lit(0)).alias("capped"),  # whole numbers: the same sum in any order
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        return row["all"] or 0, row["capped"], row["open"]

    level, before = -1.0, None
    while True:
        every, capped, open_ = totals(level)
        if not open_ or (capped, open_) == before:
            break
        level, before = (budget * every - cap * capped) / open_, (capped, open_)
    target = most if not open_ else F.least(most, F.col("weight") * F.lit(level))
    return ranked.select("source", "source_size", target.alias("target"))


def settle(level: int, seed: int):
    """Pairs the units of each (leaf, source) in order; all but at most one come out decided."""
    names = [c.split()[0] for c in UNIT.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32()}
    schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in UNIT.split(", ")])

    def pair(a: list, b: list, rng: random.Random) -> None:
        """Words move from one open unit to the other until one is empty or full."""
        (x, p), (y, q) = ((u[3] * u[4], u[8]) for u in (a, b))
        gain, loss = min(x * (1 - p), y * q), min(x * p, y * (1 - q))
        if rng.random() * (gain + loss) < loss:  # to the first unit
            a[8] = 1.0 if x * (1 - p) <= y * q else p + gain / x
            b[8] = 0.0 if y * q <= x * (1 - p) else q - gain / y
        else:
            a[8] = 0.0 if x * p <= y * (1 - q) else p - loss / x
            b[8] = 1.0 if y * (1 - q) <= x * p else q + loss / y

    def run(batches):
        key, rng, held = None, None, None
        frame = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], names)
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                unit = list(row)
                if (unit[0], unit[1]) != key:
                    if held:
                        out.append(held)
                    key, held = (unit[0], unit[1]), None
                    rng = random.Random(f"{seed}/{level}/{unit[0]}/{unit[1]!r}")
                if unit[8] is None:
                    out.append(unit)
                elif held is None:
                    held = unit
                else:
                    pair(held, unit, rng)
                    still = []
                    for u in (held, unit):
                        if 0.0 < u[8] < 1.0:
                            still.append(u)
                        else:
                            u[7], u[8] = u[7] + round(u[8]), None
                            out.append(u)
                    held = still[0] if still else None
            if out:
                yield frame(out)
        if held:
            yield frame([held])

    return run


def mix(docs: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, cap: float = CAP, seed: int = SEED) -> DataFrame:
    """One row a unit: doc_id, source, size, n (rows), source_size, target, copies, extra (words of a leading part)."""
    scratch = Scratch(docs.sparkSession)
    sizes = scratch.keep(sized(docs), "sizes")
    rows = sizes.count()
    targets = scratch.keep(source_targets(sizes, scratch, weights, budget, cap), "targets")
    few = targets.count() <= BROADCAST_SOURCES
    units = sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n"))
    t = targets.withColumnRenamed("source", "t_source")
    units = units.join(F.broadcast(t) if few else t, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    leaves = parts(rows, LEAF_ROWS)
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    part = share - F.floor(share)
    opened = F.when((F.col("size") > 0) & (part > 1e-12) & (part < 1 - 1e-12), part)
    units = units.select(
        F.pmod(F.xxhash64(F.lit(seed), "doc_id", "source", "size"), F.lit(leaves)).alias("leaf"),
        "source", "doc_id", "size", "n", "source_size", "target",
        F.when(opened.isNull(), F.round(share)).otherwise(F.floor(share)).cast("int").alias("copies"),
        opened.alias("open"),
    )
    level, done = 0, []
    while True:
        ordered = units.repartition(leaves, "leaf", "source").sortWithinPartitions("leaf", "source", F.xxhash64(F.lit(seed), "doc_id", "size"), "doc_id", "size")
        met = scratch.keep(ordered.select(*[c.split()[0] for c in UNIT.split(", ")]).mapInArrow(settle(level, seed), UNIT), f"level-{level}")
        if leaves == 1:
            done.append(met)
            break
        done.append(met.where(F.col("open").isNull()))
        units = met.where(F.col("open").isNotNull()).withColumn("leaf", F.expr(f"leaf div {FAN_IN}"))
        leaves, level = parts(leaves, FAN_IN), level + 1
    extra = F.coalesce(F.floor(F.round(F.col("open") * F.col("size") * F.col("n")) / F.col("n")), F.lit(0)).cast("long")
    return union_all(done).select("doc_id", "source", "size", "n", "source_size", "target", "copies", extra.alias("extra"))


def mixed_rows(docs: DataFrame, units: DataFrame) -> DataFrame:
    """The mix itself: every copy as a row of the documents' columns; a leading part as a shorter text."""
    names = docs.columns
    doc, source, u_size, copies, extra, size, taken = (fresh(x, names) for x in ("u_doc", "u_source", "u_size", "u_copies", "u_extra", "own_size", "u_words"))
    u = units.where("copies > 0 or extra > 0").select(
        F.col("doc_id").alias(doc), F.col("source").alias(source), F.col("size").alias(u_size), F.col("copies").alias(copies), F.col("extra").alias(extra)
    ).hint("merge")  # units grow with the documents
    named = docs.withColumn(size, F.coalesce(F.regexp_count("text", F.lit(SPACE)), F.lit(0)).cast("long"))
    on = F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & F.col("source").cast("string").eqNullSafe(F.col(source)) & (F.col(size) == F.col(u_size))
    each = F.transform(F.sequence(F.lit(1), F.col(copies) + 1), lambda i: F.when(i <= F.col(copies), F.lit(-1).cast("long")).when(F.col(extra) > 0, F.col(extra)))
    out = named.join(u, on).withColumn(taken, F.explode(F.filter(each, lambda x: x.isNotNull())))
    lead = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(SPACE), F.lit(0)), F.lit(1), F.col(taken).cast("int")), " ")
    text = F.when(F.col(taken) < 0, F.col("text")).otherwise(lead)
    cols = []
    for c in names:
        if c == "text":
            cols.append(text.alias("text"))
        elif c == "n_chars":
            cols.append(F.when(F.col(taken) < 0, F.col("n_chars")).otherwise(F.length(lead)).cast(docs.schema["n_chars"].dataType).alias("n_chars"))
        else:
            cols.append(F.col(f"`{c}`"))
    return out.select(*cols)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = mix(table(spark, sf_dir, "documents"))
    return units.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size") + F.col("extra")).alias("taken"), "copies"
    )
