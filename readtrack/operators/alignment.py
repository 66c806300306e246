"""Words cut into subword pieces, and the words' labels moved to the pieces.

A word is cut greedily: always the longest piece of the vocabulary that fits, "##" ahead of pieces that don't begin a word. A word
that can't be cut to its end is one unknown piece. The vocabulary is a trie on every worker (its size is a tokenizer's, bounded).
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN, BEGIN, END, IGNORED, LONGEST = "[UNK]", "[CLS]", "[SEP]", -100, 100
OUT = "pieces array<string>, words array<int>, labels array<int>"


class Trie:
    def __init__(self, pieces: Iterable[str]):
        self.root: dict = {}
        for p in pieces:
            at = self.root
            for c in p:
                at = at.setdefault(c, {})
            at[""] = True
        self.inner: dict = self.root
        for c in "##":
            self.inner = self.inner.get(c, {})

    def cut(self, word: str) -> list[str]:
        out, at = [], 0
        if len(word) > LONGEST:
            return [UNKNOWN]
        while at < len(word):
            node, end = self.inner if at else self.root, at
            for i in range(at, len(word)):
                node = node.get(word[i])
                if node is None:
                    break
                if "" in node:
                    end = i + 1
            if end == at:
                return [UNKNOWN]
            out.append(("##" if at else "") + word[at:end])
            at = end
        return out


def align(df: DataFrame, tokens: str, tags: str, vocabulary: list[str], names: list[str], most: int = 512) -> DataFrame:
    """`df` with pieces, each piece's word (null for the marks at both ends) and its label: the tag's number in `names` on a word's first piece, -100 elsewhere.

    Sequences end after `most` pieces, marks among them. Empty words have no piece. Null tokens or tags give null; a tag that `names` hasn't is
    -100, as is one that is missing where there are fewer tags than tokens.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    number = {n: i for i, n in enumerate(names)}

    def run(batches):
        trie, known = Trie(shared.value), {}
        for batch in batches:
            out = ([], [], [])
            for words, own in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                if words is None or own is None:
                    for x in out:
                        x.append(None)
                    continue
                found = [(BEGIN, None, IGNORED)]
                for i, w in enumerate(words):
                    if w not in known:
                        known[w] = trie.cut(w or "")
                    label = number.get(own[i], IGNORED) if i < len(own) else IGNORED
                    found += [(p, i, IGNORED if j else label) for j, p in enumerate(known[w])]
                found = [*found[: most - 1], (END, None, IGNORED)]
                for x, part in zip(out, zip(*found, strict=True), strict=True):
                    x.append(list(part))
            kinds = (pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()))
            new = [pa.array(x, k) for x, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *new], [*batch.schema.names[:-2], "pieces", "words", "labels"])

    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), OUT])
    return df.select(*[F.col(f"`{c}`") for c in df.columns], F.col(tokens).alias("_tokens"), F.col(tags).alias("_tags")).mapInArrow(run, fields)
