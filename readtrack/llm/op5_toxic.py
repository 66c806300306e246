"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents (P) and all documents that may be learnt from, without their labels (U), train a linear classifier. With the class prior p, the
risk is p * R_P(+) + max(0, R_U(-) - p * R_P(-)): the risk of calling U negative, less what the hidden positives add to it, never below zero
(the non-negative correction). Features are whether a text has a word (of three letters or more) or a beginning of a word (of 4 to 6 letters); those
far more frequent among toxic documents are kept. Documents become the sets of kept features that they have, equal sets are counted together in Spark, and
numpy sums the risk and its gradient over the counted sets task by task, for quasi-Newton steps on the driver, which sees one gradient at a time.

Scores are the sigmoid of the classifier's value, moved so that THRESHOLD is where FALSE_ALARMS of the labelled clean rows that may be learnt from lie
above; but never so far that a text without a feature would come above 1 - THRESHOLD. Only rows whose crc32(doc_id as text) mod 3 is not 1 are learnt from; labels, lang, source and doc_id are no inputs of a score.

Features are chosen on bounded samples of the rows in `labels`, by a hash of doc_id (`most_positive` toxic ones and `most_any` of any label, expected); the
risk, the counts and the threshold are of all rows. The prior is the labels' share of toxic ones, unless it is given. A text that occurs more than once counts once. A
document is positive where any of its labels is 1; rows repeated in labels count once. Null and empty texts have no feature
and get the score of the bias alone. A null doc_id is not held out (its remainder is unknown) and not learnt from. Without any confirmed positive
every score is 0. Very long texts are scored by their set of words; further columns, whatever their names, stay.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.optimize import minimise, summed
from .common import Scratch, slices, table

MOST_POSITIVE, MOST_ANY = 2500, 7500
LEAST_DOCS, LEAST_LIFT, LEAST_GAIN = 3, 3.0, 9.0
LETTERS, PREFIXES = 3, (4, 5, 6)
MARKS = ".,;:!?\"'()[]{}<>*_-\u2013\u2014\u2026\u00ab\u00bb\u00bf\u00a1\u201c\u201d\u2018\u2019"
THRESHOLD, FALSE_ALARMS, SURPLUS, SEED = 0.7, 0.01, 3, 42
BIN, FAR = 1 / 256, 64


def words(text: str | None) -> set[str]:
    """Distinct lower-case words of LETTERS characters and more: runs without white space, less the punctuation around them."""
    return {w for x in set(text.lower().split()) if len(w := x.strip(MARKS)) >= LETTERS} if text else set()


def features(word: str) -> list[str]:
    return [f"={word}", *(word[:n] for n in PREFIXES if len(word) >= n)]


def of_text(text: str | None) -> set[str]:
    return {f for w in words(text) for f in features(w)}


def within(sorted_: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of x are in a sorted array."""
    return sorted_[np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)] == x if len(sorted_) else np.zeros(len(x), bool)


def hashed(found: Iterable[str]) -> np.ndarray:
    return np.unique(np.fromiter((zlib.crc32(f.encode()) for f in found), np.uint32))


class Kept:
    """The features that are kept, by name."""

    def __init__(self, names: Iterable[str]):
        self.place = {f: i for i, f in enumerate(names)}
        self.starts = {f.lstrip("=")[:LETTERS] for f in self.place}

    def of(self, text: str | None) -> list[int]:
        """Which of them a text has, ascending."""
        if not text or not self.place:
            return []
        near = [x for x in set(text.lower().split()) if x[:LETTERS] in self.starts or x[0] in MARKS]
        found = {f for x in near if len(w := x.strip(MARKS)) >= LETTERS and w[:LETTERS] in self.starts for f in features(w)}
        return sorted(self.place[f] for f in found if f in self.place)


class Model:
    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.kept, self.values = Kept(weights), list(weights.values())

    def score(self, text: str | None) -> float:
        g = self.bias + sum(self.values[i] for i in self.kept.of(text))
        return float(1 / (1 + np.exp(-g))) if g > -700 else 0.0


# -- the risk -----------------------------------------------------------------------------------


def sums(theta: np.ndarray, rows: np.ndarray, cols: np.ndarray, p: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Of sets of features (set `rows` has feature `cols`) that p positives and u others have: the losses of P as positive, P as negative and U as negative, and their gradients."""
    g = np.bincount(rows, theta[cols], len(p)) + theta[-1]
    up = 1 / (1 + np.exp(-np.clip(g, -60, 60)))

    def push(each: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(cols, each[rows], len(theta) - 1), each.sum())

    above, below = np.logaddexp(0, g), np.logaddexp(0, -g)
    return np.concatenate([[p @ below, p @ above, u @ above], push(p * (up - 1)), push(p * up), push(u * up)])


def train(total, size: int, n_p: int, n_u: int, prior: float, decay: float = 1e-4, steps: int = 60) -> np.ndarray:
    """The weights of `size` features and the bias that make the non-negative risk least; `total(theta)` gives `sums` over all sets."""

    def value(theta: np.ndarray) -> tuple[float, np.ndarray]:
        t = total(theta)
        plus, minus, unlabelled = t[3:].reshape(3, -1)
        negative = t[2] / n_u - prior * t[1] / n_p
        risk = prior * t[0] / n_p + max(0.0, negative) + decay / 2 * (theta[:-1] ** 2).sum()
        slope = prior * plus / n_p + (unlabelled / n_u - prior * minus / n_p if negative > 0 else 0.0)
        slope[:-1] += decay * theta[:-1]
        return risk, slope

    start = np.zeros(size + 1)
    start[-1] = np.log(prior / (1 - prior))
    return minimise(value, start, steps=steps)[0]


# -- Spark -------------------------------------------------------------------------------------


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def digest(batches):
    """Texts -> a hash of all features of each together, and the features' hashes."""
    for batch in batches:
        every = [hashed(of_text(t.as_py())) for t in batch.column(0)]
        whole = np.array([xxhash.xxh64_intdigest(h.tobytes()) for h in every], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_pydict({"whole": pa.array(whole), "features": pa.array([h.tobytes() for h in every], pa.binary())})


def tally(batches):
    """Feature hashes of documents -> a row for each feature: in how many of the task's documents."""
    total: dict[int, int] = {}
    for batch in batches:
        ids, n = np.unique(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint32), return_counts=True)
        for i, k in zip(ids.tolist(), n.tolist(), strict=True):
            total[i] = total.get(i, 0) + k
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["feature", "n"])


def choose(pos: DataFrame, any_: DataFrame, n_pos: int, n_any: int) -> list[int]:
    """Feature hashes LEAST_LIFT times as frequent in the toxic sample as in the other, by the evidence for it; each has (feature, n)."""
    p, u = (F.col("a") + 0.1) / (n_pos + 0.2), (F.coalesce("b", F.lit(0)) + 0.1) / (n_any + 0.2)
    both = pos.where(F.col("n") >= LEAST_DOCS).withColumnRenamed("n", "a").join(any_.withColumnRenamed("n", "b"), "feature", "left")
    fit = both.where((p > LEAST_LIFT * u) & (F.col("a") * F.log(p / u) >= LEAST_GAIN))
    return sorted(r["feature"] for r in fit.select("feature").collect())


def texts_of(open_: DataFrame, rows: DataFrame, most: int, total: int, seed: int) -> DataFrame:
    """Texts of about `most` of the rows (l_doc), by a hash; the ids drawn are broadcast."""
    drawn = F.pmod(F.xxhash64("l_doc", F.lit(seed)), F.lit(1 << 30)) < int(min(1.0, most / max(1, total)) * (1 << 30))
    return open_.join(F.broadcast(rows.where(drawn).select(F.col("l_doc").alias("doc_id"))), "doc_id").select("text")


def named(kept: set[int]):
    """Texts -> the names of the features whose hashes are kept."""

    def run(batches):
        for batch in batches:
            names = {f for t in batch.column(0) for f in of_text(t.as_py()) if zlib.crc32(f.encode()) in kept}
            yield pa.RecordBatch.from_pydict({"name": pa.array(sorted(names), pa.string())})

    return run


def sets_of(shared):
    """(doc_id, text, same) -> doc_id, the set of kept features as bytes, same."""

    def run(batches):
        kept = Kept(shared.value)
        for whole in batches:
            for batch in slices(whole, 1):
                found = pa.array([np.array(kept.of(t.as_py()), np.int32).tobytes() for t in batch.column(1)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), found, batch.column(2)], ["doc_id", "kept", "same"])

    return run


def unpacked(batch) -> tuple[np.ndarray, np.ndarray]:
    found = batch.column(0).to_pylist()
    return np.repeat(np.arange(len(found)), [len(x) // 4 for x in found]), np.frombuffer(b"".join(found), np.int32)


def counted_sets(open_: DataFrame, known: DataFrame, names: list[str], scratch: Scratch) -> DataFrame:
    """kept, p, u, clean: how many confirmed toxic, all and labelled clean documents have just these kept features. Each distinct text counts once."""
    shared = open_.sparkSession.sparkContext.broadcast(names)
    found = open_.select("doc_id", "text", F.xxhash64("text").alias("same")).mapInArrow(sets_of(shared), "doc_id long, kept binary, same long")
    found = found.join(known.withColumnRenamed("l_doc", "doc_id"), "doc_id", "left").groupBy("kept", "same").agg(F.max("toxic").alias("toxic"))
    count = lambda v: F.count(F.when(F.col("toxic") == v, 1))
    return scratch.keep(found.groupBy("kept").agg(count(1).alias("p"), F.count("*").alias("u"), count(0).alias("clean")), "sets")


def moved(sets: DataFrame, theta: np.ndarray, prior: float, threshold: float, false_alarms: float) -> float:
    """What to add to all values so that at most `false_alarms` of the labelled clean documents reach the threshold.

    The labels may not tell of everything that U has: U's share above the threshold may exceed what P makes us expect by SURPLUS times `false_alarms` at most.
    """

    def run(batches):
        for batch in batches:
            rows, cols = unpacked(batch)
            g = np.clip(np.bincount(rows, theta[cols], batch.num_rows) + theta[-1], -FAR, FAR)
            yield pa.RecordBatch.from_arrays([pa.array(np.floor(g / BIN).astype(np.int64)), *batch.columns[1:]], ["bin", "clean", "p", "u"])

    bins = sets.select("kept", "clean", "p", "u").mapInArrow(run, "bin long, clean long, p long, u long").groupBy("bin")
    bins = sorted(bins.agg(*[F.sum(c).alias(c) for c in ("clean", "p", "u")]).collect(), key=lambda r: -r["bin"])
    n = np.array([[r["clean"], r["p"], r["u"]] for r in bins], float)
    if not n[:, 0].sum():
        return 0.0
    clean, p, u = (np.cumsum(n, axis=0) / n.sum(axis=0)).T
    good = (clean <= false_alarms) & (u - prior * p <= SURPLUS * false_alarms * (1 - prior))
    last = int(np.argmin(good)) if not good.all() else len(bins)
    at = bins[last - 1]["bin"] if last else bins[0]["bin"] + 1
    return float(np.log(threshold / (1 - threshold)) - at * BIN)


def fit(docs: DataFrame, labels: DataFrame, most_positive: int = MOST_POSITIVE, most_any: int = MOST_ANY, prior: float | None = None, seed: int = SEED) -> Model | None:
    """The model, from all rows that may be learnt from; None without a confirmed toxic one that has a feature."""
    scratch = Scratch(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    open_ = d.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = (
        labels.select(F.col("doc_id").cast("long").alias("l_doc"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("l_doc").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("l_doc")))
        .groupBy("l_doc")
        .agg(F.max("toxic").alias("toxic"))
    )
    count = known.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.when(F.col("toxic") == 1, 1)), F.lit(0)).alias("pos")).first()
    if not count["pos"]:
        return None
    prior = min(0.9, max(1e-4, count["pos"] / count["n"] if prior is None else prior))
    texts = texts_of(open_, known.where("toxic = 1"), most_positive, count["pos"], seed)
    samples = [scratch.keep(x.mapInArrow(digest, "whole long, features binary").dropDuplicates(["whole"]), f"sample-{i}") for i, x in enumerate((texts, texts_of(open_, known, most_any, count["n"], seed + 1)))]
    met = [s.select("features").mapInArrow(tally, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")) for s in samples]
    ids = choose(*met, *[s.count() for s in samples])
    if not ids:
        return None
    # The kept features' own names, from the same positives, and of the few that share a hash.
    names = sorted(r["name"] for r in texts.mapInArrow(named(set(ids)), "name string").distinct().collect())
    sets = counted_sets(open_, known, names, scratch)
    n_p, n_u = sets.agg(F.sum("p"), F.sum("u")).first()
    if not n_p:
        return None
    learnt = sets.select("kept", "p", "u")
    tasks = learnt.rdd.getNumPartitions()

    def total(theta: np.ndarray) -> np.ndarray:
        def part(batches):
            out = np.zeros(3 + 3 * len(theta))
            for batch in batches:
                out += sums(theta, *unpacked(batch), *(batch.column(i).to_numpy().astype(float) for i in (1, 2)))
            return out

        return summed(learnt, part, tasks)

    theta = train(total, len(names), n_p, n_u, prior)
    low = np.log((1 - THRESHOLD) / THRESHOLD)  # a text without any feature stays as far below as the threshold is above
    theta[-1] += min(moved(sets, theta, prior, THRESHOLD, FALSE_ALARMS), max(0.0, low - theta[-1]))
    scratch.end()
    return Model(dict(zip(names, theta.tolist(), strict=False)), float(theta[-1]))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) of each row: the texts don't come back from Python."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        return ids.select("doc_id", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches):
        own = Model(*shared.value)
        for batch in batches:
            found = [own.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    return ids.mapInArrow(run, "doc_id long, score double")


def without_toxic(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents' rows whose score stays below the threshold, all columns kept."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    at = docs.columns.index("text")

    def run(batches):
        own = Model(*shared.value)
        for batch in batches:
            yield batch.filter(pa.array([own.score(t.as_py()) < threshold for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id").cast("long")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
