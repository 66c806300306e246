"""Language identification by string kernels.

The kernel of two texts is the number of n-grams of 1 to 3 symbols (lower-case letters, and one symbol for whatever stands between words) that both
have, over the root of the product of their own numbers: the blended-spectrum presence kernel. A few labelled texts are landmarks;
every text's kernel with them is counted once, by products of presence matrices, and stored. Nyström features of these rows train one ridge regression
for each language against the rest, on all rows that may be learnt from: tasks sum up the normal equations, the driver solves them (as many unknowns as
landmarks). Scores are products of the stored rows with the solution.

Only rows with an id, a text, a non-null lang and crc32(doc_id as text) mod 4 other than 2 are learnt from, each language with equal weight in all;
lang, source and doc_id are no inputs of a prediction. LANDMARKS texts (one for each language at least) are drawn by a hash, those of up to LANDMARK_CHARS
characters first. The space between words alone is no n-gram. The score is the winner's regression value, held between 0 and 1.

Defined results: null texts and texts without a letter are `und`, score 0, and so is every text where nothing can be learnt from. A
null id isn't held out and not learnt from. Repeated rows are rows of their own. A text that shares nothing with the landmarks
is given the most frequent language, score 0; ties go to the more frequent language, then the smaller name. Very long texts are read whole, in bounded parts. An empty
table gives an empty result; further columns, whatever their names, are not read.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, slices, table

LANDMARKS, LANDMARK_CHARS, RIDGE, SEED = 96, 8192, 1e-3, 42
UNKNOWN, GAP = "und", 1
PART, ROWS, FEATURES = 1 << 20, 64, 1 << 15
KERNEL = "doc_id long, lang string, own long, shared binary"


@cache
def letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: str) -> np.ndarray:
    """The distinct n-grams of a text as sorted numbers; none where it has no letter."""
    x = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    x = np.where(letters()[x], x, np.uint32(GAP))
    if not (x != GAP).any():
        return np.empty(0, np.uint64)
    x = np.concatenate([[GAP], x, [GAP]]).astype(np.uint32)
    x = x[np.append(True, (x[1:] != GAP) | (x[:-1] != GAP))]
    out = np.empty(0, np.uint64)
    for at in range(0, len(x), PART):
        one = x[at : at + PART + 2].astype(np.uint64)
        two = one[:-1] << np.uint64(21) | one[1:]
        three = one[:-2] << np.uint64(42) | two[1:]
        out = np.unique(np.concatenate([out, one[one != GAP], two, three]))
    return out


class Landmarks:
    """The landmarks' n-grams, and which landmark has which."""

    def __init__(self, texts: list[str]):
        own = [grams(t) for t in texts]
        self.size = np.array([len(g) for g in own], np.float64)
        self.known = np.unique(np.concatenate(own))
        self.has = np.zeros((len(self.known), len(own)), np.float32)
        for j, g in enumerate(own):
            self.has[np.searchsorted(self.known, g), j] = 1

    def shared(self, found: list[np.ndarray]) -> np.ndarray:
        """How many n-grams each of these texts shares with each landmark: products of presence matrices, FEATURES n-grams at a time."""
        row = np.repeat(np.arange(len(found)), [len(g) for g in found])
        codes = np.concatenate(found) if found else np.empty(0, np.uint64)
        at = np.minimum(np.searchsorted(self.known, codes), len(self.known) - 1)
        hit = self.known[at] == codes
        row, at = row[hit], at[hit]
        out = np.zeros((len(found), self.has.shape[1]), np.float32)
        for lo in range(0, len(self.known), FEATURES):
            there = self.has[lo : lo + FEATURES]
            near = (at >= lo) & (at < lo + FEATURES)
            x = np.zeros((len(found), len(there)), np.float32)
            x[row[near], at[near] - lo] = 1
            out += x @ there
        return out


def kernel(shared: np.ndarray, own: np.ndarray, size: np.ndarray) -> np.ndarray:
    return shared / np.sqrt(np.maximum(own, 1)[:, None] * size[None, :])


def solve(among: np.ndarray, normal: np.ndarray, toward: np.ndarray, ridge: float) -> np.ndarray:
    """Coefficients on the kernel's values: ridge regression in the Nyström features of the landmarks' own kernel `among`."""
    value, vector = np.linalg.eigh(among)
    good = value > 1e-8 * value.max()
    root = vector[:, good] / np.sqrt(value[good])
    inner = root.T @ normal @ root
    return root @ np.linalg.solve(inner + ridge * np.eye(len(inner)), root.T @ toward)


# -- Spark --------------------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def landmark_texts(known: DataFrame, counts: dict[str, int], landmarks: int, chars: int, seed: int) -> list[str]:
    """Texts of about equally many documents of each language. `known`: doc_id, text, lang."""
    want = max(1, landmarks // len(counts))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 40))
    share = F.element_at(F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, int(min(1.0, 4 * want / n) * (1 << 40)))]), F.col("lang"))
    drawn = known.select("doc_id", "lang", F.length("text").alias("n"), draw.alias("draw")).where(F.col("draw") < share).collect()
    picked = []
    for lang in counts:
        of = sorted((max(chars, r["n"]), r["draw"], r["doc_id"]) for r in drawn if r["lang"] == lang)
        picked += [i for _, _, i in of[:want]]
    if not picked:
        return []
    found = known.where(F.col("doc_id").isin(picked)).select("text").distinct().collect()
    return sorted(r["text"] for r in found)


def kernel_rows(shared):
    """(doc_id, lang, text) -> how many n-grams the text has, and shares with each landmark."""

    def run(batches):
        marks = shared.value
        for whole in batches:
            for part in slices(whole, 2):
                for at in range(0, part.num_rows, ROWS):
                    batch = part.slice(at, ROWS)
                    found = [grams(t.as_py() or "") for t in batch.column(2)]
                    counts = marks.shared(found).astype(np.uint32)
                    own = pa.array([len(g) for g in found], pa.int64())
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), own, pa.array([c.tobytes() for c in counts], pa.binary())], ["doc_id", "lang", "own", "shared"])

    return run


def read_rows(batch, size: np.ndarray) -> np.ndarray:
    """The kernel of a batch of stored rows (own, shared) with the landmarks."""
    counts = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(batch.num_rows, len(size))
    return kernel(counts, batch.column(0).to_numpy(), size)


def normal_rows(size: np.ndarray, langs: list[str], weight: np.ndarray):
    """(own, shared, lang) -> this task's sums, a row for each landmark: products with the others, then with each language."""

    def run(batches):
        from pyspark import TaskContext

        m, task = len(size), TaskContext.get().partitionId()
        total, place = np.zeros((m, m + len(langs))), {x: i for i, x in enumerate(langs)}
        for batch in batches:
            k = read_rows(batch, size)
            which = np.array([place[x] for x in batch.column(2).to_pylist()], np.int64)
            y = np.zeros((len(k), len(langs)))
            y[np.arange(len(k)), which] = 1
            total += (k * weight[which][:, None]).T @ np.concatenate([k, y], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(m)), pa.array(np.full(m, task)), pa.array([r.tobytes() for r in total], pa.binary())], ["landmark", "task", "sums"])

    return run


def summed(t: pa.Table) -> pa.Table:
    t = t.sort_by("task")
    total = sum(np.frombuffer(x, np.float64) for x in t.column("sums").to_pylist())
    return pa.table({"landmark": t.column("landmark").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})


def identify(docs: DataFrame, landmarks: int = LANDMARKS, chars: int = LANDMARK_CHARS, ridge: float = RIDGE, seed: int = SEED) -> DataFrame:
    """doc_id, lang_pred, score of every row of docs (doc_id, text, lang)."""
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    open_ = F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("lang").isNotNull()
    known = d.where(open_ & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").collect()}
    texts = landmark_texts(known, counts, landmarks, chars, seed) if counts else []
    if not texts:
        return d.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    scratch = Scratch(spark)
    marks = Landmarks(texts)
    shared = spark.sparkContext.broadcast(marks)
    placed = d.select("doc_id", F.when(open_, F.col("lang")).alias("lang"), "text")
    rows = scratch.keep(placed.mapInArrow(kernel_rows(shared), KERNEL), "kernel")
    size, langs = marks.size, list(counts)
    weight = np.array([1 / (len(langs) * counts[x]) for x in langs])
    learnt = rows.where("own > 0 and lang is not null").select("own", "shared", "lang").where(F.col("lang").isin(langs))
    sums = learnt.mapInArrow(normal_rows(size, langs, weight), "landmark long, task long, sums binary")
    sums = sums.groupBy("landmark").applyInArrow(summed, "landmark long, sums binary").collect()
    total = np.array([np.frombuffer(r["sums"]) for r in sorted(sums, key=lambda r: r["landmark"])])
    among = kernel(marks.has.T.astype(np.float64) @ marks.has, size, size)
    solution = solve(among, total[:, : len(size)], total[:, len(size) :], ridge)

    def run(batches):
        names = np.array(langs, object)
        for batch in batches:
            value = read_rows(batch, size) @ solution
            best = value.argmax(axis=1)
            empty = batch.column(0).to_numpy() == 0
            found = np.where(empty, 0.0, np.clip(value[np.arange(len(best)), best], 0.0, 1.0))
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(np.where(empty, UNKNOWN, names[best]), pa.string()), pa.array(found)], ["doc_id", "lang_pred", "score"])

    return rows.select("own", "shared", "doc_id").mapInArrow(run, "doc_id long, lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
