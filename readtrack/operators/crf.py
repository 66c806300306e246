"""A linear-chain conditional random field over token features, trained on all sentences and applied to all in Arrow batches.

Features are a token's shape, its neighbours' words and kinds, whether it begins or ends its sentence, and, where given, its mean
similarity to seed words. Equal sentences are counted together. The likelihood and its gradient come from a forward and a backward pass over
blocks of sentences side by side, summed over all tasks; quasi-Newton steps with an L1 and an L2 penalty follow on the driver, which
holds the weights alone. Sentences without a token have no tags and teach nothing, nor do sentences with another number of tags; unknown features weigh nothing.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..sources.shared import new_folder
from .optimize import minimise, summed

L1, L2, STEPS, TOLERANCE, BLOCK = 0.1, 0.1, 100, 1e-5, 16384
BLOCKS = "lengths binary, times binary, gold binary, rows binary, cols binary"


def kind(token: str | None) -> list[str]:
    """What a neighbour shows of itself."""
    if token is None:
        return ["none"]
    return [f"lower={token.lower()}", *(["digit"] if token.isdigit() else []), *(["title"] if token.istitle() else [])]


def features(tokens: list[str], i: int, similar: dict[str, list[float]] | None = None) -> list[str]:
    t = tokens[i]
    out = ["bias", f"lower={t.lower()}", f"p2={t[:2]}", f"p3={t[:3]}", f"s2={t[-2:]}", f"s3={t[-3:]}"]
    out += [name for name, on in (("title", t.istitle()), ("upper", t.isupper()), ("digit", t.isdigit()), ("has_digit", any(map(str.isdigit, t))), ("hyphen", "-" in t)) if on]
    out += [f"seed{k}={s:.1f}" for k, s in enumerate((similar or {}).get(t.lower(), []))]
    out += [f"prev:{x}" for x in kind(tokens[i - 1] if i else None)]
    out += [f"next:{x}" for x in kind(tokens[i + 1] if i + 1 < len(tokens) else None)]
    return out


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Crf:
    def __init__(self, labels: list[str], known: dict[str, int], weights: np.ndarray, steps: np.ndarray, similar: dict[str, list[float]] | None = None):
        self.labels, self.known, self.weights, self.steps, self.similar = labels, known, weights, steps, similar

    def scores(self, tokens: list[str]) -> np.ndarray:
        out = np.zeros((len(tokens), len(self.labels)))
        for i in range(len(tokens)):
            at = [self.known[f] for f in features(tokens, i, self.similar) if f in self.known]
            out[i] = self.weights[at].sum(0)
        return out

    def tag(self, tokens: list[str]) -> list[str]:
        """The likeliest tags together."""
        if not tokens:
            return []
        score = self.scores(tokens)
        best, back = score[0], []
        for row in score[1:]:
            ways = best[:, None] + self.steps
            back.append(ways.argmax(0))
            best = ways.max(0) + row
        at = [int(best.argmax())]
        for b in reversed(back):
            at.append(int(b[at[-1]]))
        return [self.labels[k] for k in reversed(at)]

    def dump(self) -> str:
        return json.dumps({"labels": self.labels, "known": list(self.known), "weights": self.weights.tolist(), "steps": self.steps.tolist(), "similar": self.similar})

    @staticmethod
    def load(text: str) -> Crf:
        x = json.loads(text)
        return Crf(x["labels"], {f: i for i, f in enumerate(x["known"])}, np.array(x["weights"]).reshape(len(x["known"]), -1), np.array(x["steps"]), x["similar"])


class Block:
    """Sentences side by side: each token's place is its sentence's number times the width, plus its own."""

    def __init__(self, lengths: np.ndarray, times: np.ndarray, gold: np.ndarray, rows: np.ndarray, cols: np.ndarray):
        self.lengths, self.times, self.rows, self.cols = lengths, times, rows, cols
        self.there = np.arange(lengths.max(initial=1))[None, :] < lengths[:, None]
        self.gold = np.zeros(self.there.shape, np.int64)
        self.gold[self.there] = gold

    @staticmethod
    def of(data: list[tuple[list[str], list[str], int]], labels: dict[str, int], known: dict[str, int], similar: dict[str, list[float]] | None) -> list[np.ndarray]:
        """The arrays of a block, from (tokens, tags, times)."""
        width = max(len(t) for t, _, _ in data)
        rows, cols = [], []
        for s, (tokens, _, _) in enumerate(data):
            for i in range(len(tokens)):
                at = [known[f] for f in features(tokens, i, similar) if f in known]
                rows += [s * width + i] * len(at)
                cols += at
        return [np.array(x, np.int32) for x in ([len(t) for t, _, _ in data], [n for _, _, n in data], [labels[y] for _, g, _ in data for y in g], rows, cols)]

    def sums(self, w: np.ndarray, t: np.ndarray) -> np.ndarray:
        """The negative log-likelihood, then its gradient by w and t."""
        (n, width), k = self.there.shape, w.shape[1]
        rows, cols, there, one = self.rows, self.cols, self.there, np.eye(k)
        often = self.times[:, None, None] * there[:, :, None]

        def gathered(per_token: np.ndarray) -> np.ndarray:
            flat = per_token.reshape(n * width, k)
            return np.stack([np.bincount(cols, flat[rows, y], len(w)) for y in range(k)], 1)

        score = np.stack([np.bincount(rows, w[cols, y], n * width) for y in range(k)], 1).reshape(n, width, k)
        ahead, back = score.copy(), np.zeros((n, width, k))
        for i in range(1, width):
            ahead[:, i] += log_sum(ahead[:, i - 1, :, None] + t, 1)
        for i in range(width - 2, -1, -1):
            back[:, i] = np.where(there[:, i + 1, None], log_sum(t + (score[:, i + 1] + back[:, i + 1])[:, None, :], 2), 0)
        whole = log_sum(ahead[np.arange(n), self.lengths - 1], 1)
        share = np.exp(np.where(there[:, :, None], ahead + back - whole[:, None, None], -np.inf))
        own = np.take_along_axis(score, self.gold[:, :, None], 2)[:, :, 0] * there
        own[:, 1:] += t[self.gold[:, :-1], self.gold[:, 1:]] * there[:, 1:]
        steps = np.zeros((k, k))
        for i in range(1, width):
            on = there[:, i]
            both = ahead[on, i - 1, :, None] + t + (score[on, i] + back[on, i])[:, None, :] - whole[on, None, None]
            steps += (np.exp(both) * self.times[on, None, None]).sum(0)
            np.add.at(steps, (self.gold[on, i - 1], self.gold[on, i]), -self.times[on])
        return np.concatenate([[self.times @ (whole - own.sum(1))], gathered((share - one[self.gold]) * often).ravel(), steps.ravel()])


def trained(total, labels: list[str], names: list[str], similar, l1: float, l2: float, steps: int, tolerance: float) -> Crf:
    """The weights that make likelihood and penalties least; `total(w, t)` gives `Block.sums` over all sentences."""
    k, size = len(labels), len(names) * len(labels)

    def value(theta: np.ndarray) -> tuple[float, np.ndarray]:
        found = total(theta[:size].reshape(-1, k), theta[size:].reshape(k, k))
        return found[0] + l2 * (theta**2).sum(), found[1:] + 2 * l2 * theta

    theta, _ = minimise(value, np.zeros(size + k * k), np.append(np.full(size, l1), np.zeros(k * k)), steps, tolerance=tolerance)
    w = theta[:size].reshape(-1, k)
    used = np.flatnonzero(np.abs(w).sum(1) > 0)
    return Crf(labels, {names[j]: i for i, j in enumerate(used.tolist())}, w[used], theta[size:].reshape(k, k), similar)


def learn(sentences: Iterable[tuple[list[str], list[str]]], similar: dict[str, list[float]] | None = None, l1: float = L1, l2: float = L2, steps: int = STEPS, tolerance: float = TOLERANCE) -> Crf:
    """From (tokens, tags) pairs in memory."""
    data = [(t, g, 1) for t, g in sentences if t and len(t) == len(g)]
    labels = sorted({y for _, g, _ in data for y in g}) or ["O"]
    names = sorted({f for t, _, _ in data for i in range(len(t)) for f in features(t, i, similar)})
    if not data:
        return Crf(labels, {}, np.zeros((0, len(labels))), np.zeros((len(labels),) * 2), similar)
    block = Block(*Block.of(data, {y: i for i, y in enumerate(labels)}, {f: i for i, f in enumerate(names)}, similar))
    return trained(block.sums, labels, names, similar, l1, l2, steps, tolerance)


def fit(
    sentences: DataFrame, tokens: str = "tokens", tags: str = "gold", similar: dict[str, list[float]] | None = None, least: int = 1, l1: float = L1, l2: float = L2, steps: int = STEPS, tolerance: float = TOLERANCE
) -> Crf:
    """Learnt from all sentences. Features of fewer than `least` distinct sentences are left out; the driver holds the others' names and weights, as the model does."""
    spark = sentences.sparkSession
    each = sentences.select(F.col(tokens).alias("t"), F.col(tags).alias("g")).where("size(t) > 0 and size(t) = size(g) and not exists(t, x -> x is null) and not exists(g, x -> x is null)")
    folder = new_folder(spark, "crf")
    each.groupBy("t", "g").agg(F.count("*").alias("n")).write.parquet(f"{folder}/sentences")
    counted = spark.read.parquet(f"{folder}/sentences")

    def met(frames):
        for frame in frames:
            found = pd.Series([f for t in frame["t"] for f in {f for i in range(len(t)) for f in features(list(t), i, similar)}], dtype=object)
            yield found.value_counts().rename_axis("feature").reset_index(name="n")

    found = counted.select("t").mapInPandas(met, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    names = sorted(r["feature"] for r in found.select("feature").collect())
    labels = sorted(r["y"] for r in counted.select(F.explode("g").alias("y")).distinct().collect()) or ["O"]
    if not names:
        return learn([], similar)
    known = spark.sparkContext.broadcast({f: i for i, f in enumerate(names)})
    number = {y: i for i, y in enumerate(labels)}

    def packed(data):
        return pd.DataFrame([[x.tobytes() for x in Block.of(data, number, known.value, similar)]], columns=[c.split()[0] for c in BLOCKS.split(", ")])

    def blocks(frames):
        for frame in frames:
            data = []
            for t, g, n in zip(frame["t"], frame["g"], frame["n"], strict=True):
                if data and (len(data) + 1) * len(t) > BLOCK:  # they come from the shortest to the longest
                    yield packed(data)
                    data = []
                data.append((list(t), list(g), n))
            if data:
                yield packed(data)

    counted.sortWithinPartitions(F.size("t")).mapInPandas(blocks, BLOCKS).write.parquet(f"{folder}/blocks")
    stored = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    tasks = stored.rdd.getNumPartitions()
    size = 1 + len(names) * len(labels) + len(labels) ** 2

    def total(w: np.ndarray, t: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast((w, t))

        def part(batches):
            out = np.zeros(size)
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    out += Block(*(np.frombuffer(x, np.int32) for x in row)).sums(*shared.value)
            return out

        out = summed(stored, part, tasks)
        shared.unpersist()
        return out

    return trained(total, labels, names, similar, l1, l2, steps, tolerance)


def tag(sentences: DataFrame, model: Crf, tokens: str = "tokens", out: str = "pred") -> DataFrame:
    """Adds the tags of each sentence."""
    shared = sentences.sparkSession.sparkContext.broadcast(model.dump())
    schema = StructType([*sentences.schema.fields, StructField(out, ArrayType(StringType()))])

    def run(frames):
        own = Crf.load(shared.value)
        for frame in frames:
            yield frame.assign(**{out: pd.Series([own.tag(list(t)) if t is not None else None for t in frame[tokens]], index=frame.index, dtype=object)})

    return sentences.mapInPandas(run, schema)


def top_weights(spark: SparkSession, model: Crf, most: int = 20) -> DataFrame:
    """label, feature, weight: the `most` largest of each label."""
    names = list(model.known)
    rows = [(y, names[i], float(model.weights[i, k])) for k, y in enumerate(model.labels) for i in np.argsort(-model.weights[:, k], kind="stable")[:most]]
    return spark.createDataFrame(rows, "label string, feature string, weight double")


def save(spark: SparkSession, model: Crf, path: str) -> None:
    spark.createDataFrame([(model.dump(),)], "model string").write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> Crf:
    return Crf.load(spark.read.parquet(path).first()["model"])
