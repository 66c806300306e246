"""Ranked lexical search by a hierarchical tree of maxima over document ranges.

Of every text the terms are counted once; what is stored of a document is its length and the counts of the terms that are asked
for. From the whole corpus' counts follow the terms' weights and each document's impact for a term. A shard
of documents in memory holds, for each term, a tree over ranges of documents (32 documents, 32 ranges, ...) whose nodes carry the largest
impact below them. A search opens the node with the highest sum of weighted maxima; a document's sum is its score. Nodes whose sum equals the last score
kept are opened as well, since a smaller id may be in them; the rest is never looked at. A task takes its shards one after another and starts
each with the scores that it has; the tasks' lists are merged in a tree.

Defined results: null texts have no term; documents without a term count nowhere; documents without an id count in the
statistics and are not ranked; each repeated row is a document of its own. Of an item id's rows the least text is the item, rows without
an id and null texts ask for nothing. An item whose terms no document holds has no row, nor has any item on an empty table. Very long texts are read whole, and further columns, whatever their names, are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, parts, slices, table, union_all
from .vectors import merge_top

TOP = 10
SHIFT, SHARD_DOCS, SHARD_POSTINGS, ITEM_BYTES = 5, 1 << 15, 1 << 20, 16 << 20
# What isn't a letter, a digit or beyond ASCII separates terms; A-Z are lower-cased.
FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()
POSTINGS = "doc_id long, n long, ids binary, times binary"
FOUND = "query_id long, vec_id long, score long, tile long"


def terms(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


# -- one shard ----------------------------------------------------------------------------------


class MaxTree:
    """Trees of maxima, one for each term, over the documents 0, 1, ... of a shard."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray):
        order = np.lexsort((doc, term))
        term, node, most = term[order], doc[order].astype(np.int64), impact[order]
        self.nodes, self.most, self.begin = [node], [most], [None]
        while len(node) and node.max() > 0:
            node = node >> SHIFT
            at = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(node, prepend=-1) != 0))
            self.begin.append(np.append(at, len(node)))
            term, node, most = term[at], node[at], np.maximum.reduceat(most, at)
            self.nodes.append(node)
            self.most.append(most)
        self.root = term  # the terms that the shard has, ascending; one entry each

    def below(self, level: int, entries: np.ndarray, weight: np.ndarray):
        """What the children of a node sum up to: their numbers, sums, and their own entries and weights with where each child's begin."""
        lo, hi = self.begin[level][entries], self.begin[level][entries + 1]
        n = hi - lo
        flat = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        node, weight = self.nodes[level - 1][flat], np.repeat(weight, n)
        order = np.argsort(node, kind="stable")
        flat, node, weight = flat[order], node[order], weight[order]
        at = np.flatnonzero(np.diff(node, prepend=-1))
        return node[at], np.add.reduceat(self.most[level - 1][flat] * weight, at), flat, weight, np.append(at, len(flat))

    def search(self, term: np.ndarray, weight: np.ndarray, ids: np.ndarray, k: int, best: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The k best of `best` and this shard, as (-score, id) ascending."""
        if not len(self.root):
            return best
        at = np.minimum(np.searchsorted(self.root, term), len(self.root) - 1)
        here = self.root[at] == term
        top = len(self.nodes) - 1
        entries, weight = at[here], weight[here]
        if not len(entries):
            return best
        if not top:  # a shard of one document
            score = int((self.most[0][entries] * weight).sum())
            return sorted([*best, (-score, int(ids[0]))])[:k] if score > 0 else best
        count, heap = 0, [(-int((self.most[top][entries] * weight).sum()), 0, top, entries, weight)]
        while heap:
            least = -best[-1][0] if len(best) == k else 1
            bound, _, level, entries, weight = heapq.heappop(heap)
            if -bound < least:
                break
            node, total, flat, weight, begin = self.below(level, entries, weight)
            good = np.flatnonzero(total >= least)
            if level == 1:
                best = sorted([*best, *((-s, i) for s, i in zip(total[good].tolist(), ids[node[good]].tolist(), strict=True))])[:k] if len(good) else best
                continue
            for i, s in zip(good.tolist(), total[good].tolist(), strict=True):
                count += 1
                heapq.heappush(heap, (-s, count, level - 1, flat[begin[i] : begin[i + 1]], weight[begin[i] : begin[i + 1]]))
        return best


# -- Spark --------------------------------------------------------------------------------------


class Items:
    """Items of one block and the numbers of their terms."""

    def __init__(self, rows):
        counted = {r["item_id"]: Counter(terms(bytes(r["text"]))) for r in rows}
        self.vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counted.values())))}
        self.asked = {
            q: (np.array(sorted(own), np.int64), np.array([own[i] for i in sorted(own)], np.int64))
            for q, c in sorted(counted.items())
            if (own := {self.vocabulary[t]: n for t, n in c.items()})
        }


def count_terms(vocabulary):
    """(doc_id, text) -> documents with a term: their lengths, and which of the vocabulary's terms they have how often."""

    def run(batches):
        known = vocabulary.value
        for whole in batches:
            for batch in slices(whole, 1):
                out = ([], [], [], [])
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    found = terms(text.as_py()) if text.is_valid else []
                    if not found:
                        continue
                    own = sorted((known[t], n) for t, n in Counter(found).items() if t in known)
                    out[0].append(doc)
                    out[1].append(len(found))
                    out[2].append(np.array([i for i, _ in own], np.int32).tobytes())
                    out[3].append(np.array([n for _, n in own], np.int32).tobytes())
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], ["doc_id", "n", "ids", "times"])

    return run


def spread(size: int):
    """(ids) -> a row for each term that a task met: in how many documents."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int32), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["term", "df"])

    return run


def search_shards(asked, weights: np.ndarray, docs: int, length: int, k: int, shard_docs: int, shard_postings: int):
    """(doc_id, n, ids, times) -> the k best of the task's documents for each item."""

    def run(batches):
        from pyspark import TaskContext

        tile, items = TaskContext.get().partitionId(), asked.value
        best: dict[int, list] = {q: [] for q in items}
        held, size = [], 0

        def shard():
            ids = np.array([r[0] for r in held], np.int64)
            counts = np.array([len(r[2]) // 4 for r in held])
            term, times = (np.frombuffer(b"".join(r[i] for r in held), np.int32).astype(np.int64) for i in (2, 3))
            doc = np.repeat(np.arange(len(held)), counts)
            m = 25 + (75 * np.array([r[1] for r in held], np.int64) * docs) // length
            tree = MaxTree(term, doc, (10**9 * times) // (1000 * times + 8 * m[doc]))
            for q, (of, often) in items.items():
                best[q] = tree.search(of, weights[of] * often, ids, k, best[q])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not row[2]:
                    continue
                if held and (len(held) == shard_docs or size + len(row[2]) // 4 > shard_postings):
                    shard()
                    held, size = [], 0
                held.append(row)
                size += len(row[2]) // 4
        if held:
            shard()
        rows = [(q, i, -s, tile) for q, found in best.items() for s, i in found]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(4)], ["query_id", "vec_id", "score", "tile"])

    return run


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def rank(docs: DataFrame, items: DataFrame, k: int = TOP, shard_docs: int = SHARD_DOCS, shard_postings: int = SHARD_POSTINGS, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item. docs (doc_id, text), items (item_id, text).

    Items are asked in blocks of about `item_bytes` of text, which bounds what the driver gathers and sends; each block reads all documents.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    wanted = items.where("item_id is not null and text is not null").groupBy(F.col("item_id").cast("long").alias("item_id")).agg(F.min(F.col("text").cast("string")).cast("binary").alias("text"))
    blocks = parts(wanted.agg(F.sum(F.length("text"))).first()[0] or 0, item_bytes, 1)
    out = []
    for block in range(blocks):
        asked = Items(wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect())
        if not asked.asked:
            continue
        known = spark.sparkContext.broadcast(asked.vocabulary)
        postings = scratch.keep(texts.mapInArrow(count_terms(known), POSTINGS), f"postings-{block}")
        known.unpersist()
        n, length = postings.agg(F.count("*"), F.sum("n")).first()
        if not n:
            continue
        met = postings.select("ids").mapInArrow(spread(len(asked.vocabulary)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
        weights = np.zeros(len(asked.vocabulary), np.int64)
        for r in met.collect():
            weights[r["term"]] = weight(n, r["df"])
        shared = spark.sparkContext.broadcast(asked.asked)
        ranked = postings.where("doc_id is not null").mapInArrow(search_shards(shared, weights, n, length, k, shard_docs, shard_postings), FOUND)
        found = scratch.keep(ranked, f"found-{block}")
        scratch.drop(f"postings-{block}")
        tiles = found.agg(F.max("tile")).first()[0]
        out.append(merge_top(found, k, (tiles or 0) + 1))
    if not out:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return union_all(out).select(F.col("query_id").alias("item_id"), "rank", F.col("vec_id").alias("doc_id"), "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {TERMS} AS t FROM documents WHERE text IS NOT NULL
), s AS (
  SELECT count(*) AS docs, sum(len(t)) AS length FROM d WHERE len(t) > 0
), q AS (
  SELECT item_id, term, count(*) AS often FROM (
    SELECT item_id, unnest({TERMS}) AS term
    FROM (SELECT item_id, min(text) AS text FROM benchmark WHERE item_id IS NOT NULL GROUP BY 1)
  ) GROUP BY 1, 2
), p AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY 1, 2
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term
), m AS (
  SELECT r, doc_id, 25 + CAST((75 * CAST(len(t) AS BIGINT) * docs) // length AS BIGINT) AS m FROM d, s WHERE len(t) > 0
), f AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id, CAST(sum(often * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (r) GROUP BY 1, 2
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM f WHERE score > 0
) WHERE rank <= {TOP}
"""
