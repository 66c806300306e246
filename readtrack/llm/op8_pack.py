"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

A document's ids (its tokens, then an end id) are cut into pieces. A piece that k of fit in a
sequence belongs to class k; each class fills its sequences with k pieces. A rest that would waste
more than a sixteenth of its slot first gives a piece of exactly the next class's slot, so little is
padded; short pieces (k of FINE and more) are whole and waste less than one of them a sequence. Every worker
packs its own documents as they stream by and holds fewer than k pieces of a class; those left at its end meet
in a tree, FAN_IN workers' at a time by class, and the few left then are packed largest first.
Only the pieces' measures are shuffled, never texts or ids.

Null texts are empty: one id, the end id. Empty tables give empty results. Repeated rows are
documents of their own; a null doc_id is an ordinary value. Texts of any length stream through. Further
columns, whatever their names, are not read. A tokenizer whose rules aren't those of the word BPE encodes each text whole.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import defaultdict
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, parts, table, union_all

CAPACITY, END_ID, TOKENIZER = 2048, 1, "word_bpe_49k.json"
FINE, SLACK, FAN_IN = 32, 16, 16
RUNS_KEPT, WORDS_KEPT = 150_000, 250_000
#: Marks that the tokenizer never joins to letters (the apostrophe is not one), and plain words, lower-cased as it does.
MARKS, PLAIN = ".,;:!?()\"-", re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, k int, sequence_id long, offset long"
NAMES = [c.split()[0] for c in PIECE.split(", ")]
NOT_SPACE_FOR_ALL = "\x1c\x1d\x1e\x1f"  # str.split() takes them for spaces, the tokenizer doesn't
AS_WRITTEN = ("\u03a3", "<|")  # a sigma's lower case depends on what follows; marks of added tokens are never lower-cased
#: The rules of the word BPE that allow its runs without white space to be encoded one by one.
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
    "truncation": None,
    "padding": None,
}


def by_runs(path: str) -> bool:
    """Whether a tokenizer file has those rules, and added tokens without white space."""
    with open(path, encoding="utf-8") as f:
        own = json.load(f)
    return all(own.get(k) == v for k, v in RULES.items()) and not any(x["lstrip"] or x["rstrip"] or x["content"].split() != [x["content"]] for x in own["added_tokens"])


class Words(dict):
    """lower-cased plain word -> ids, straight from the merges."""

    def __init__(self, tok):
        from tokenizers import pre_tokenizers

        super().__init__()
        self.merges = tok.model.tokenize
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORDS_KEPT:
            self.clear()
        ids = self[word] = array("I", [t.id for t in self.merges(word if word.isascii() else word.translate(self.letters))]).tobytes()
        return ids


class Runs(dict):
    """A run of text without white space -> ids, put together from its word and the marks around it where it is so plain."""

    def __init__(self, tok):
        super().__init__()
        self.tok, self.words = tok, Words(tok)

    def __missing__(self, run: str) -> bytes:
        if len(self) >= RUNS_KEPT:
            self.clear()
        word = run.strip(MARKS)
        if word not in self.words and not PLAIN(word):
            ids = array("I", self.tok.encode(run, add_special_tokens=False).ids).tobytes()
        else:
            ids = self.words[word]
            if len(word) < len(run):
                before, _, after = run.partition(word)
                ids = (self[before] if before else b"") + ids + (self[after] if after else b"")
        self[run] = ids
        return ids


class Encoder:
    """Ids of a text as little-endian 32-bit bytes. No token crosses white space, so runs without it are encoded once and kept."""

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tok, self.end, self.by_runs = Tokenizer.from_file(path), end_id.to_bytes(4, "little"), by_runs(path)
        self.runs = Runs(self.tok)

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return self.end
        if not self.by_runs or any(c in text for c in NOT_SPACE_FOR_ALL):
            return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes() + self.end
        if not any(x in text for x in AS_WRITTEN):
            text = text.lower()
        return b"".join(map(self.runs.__getitem__, text.split())) + self.end


@lru_cache(1)
def encoder(path: str | None, end_id: int) -> Encoder:
    """One encoder a worker process: later tasks find what earlier ones kept. path None: the public word BPE."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    return Encoder(path, end_id)


def class_of(length: int, capacity: int) -> int:
    return capacity // length


def cuts(n: int, capacity: int):
    """Lengths of the pieces of a document of n ids."""
    while n > capacity:
        yield capacity
        n -= capacity
    while n:
        k = class_of(n, capacity)
        slot = capacity // k
        if k >= FINE or (slot - n) * SLACK <= slot:
            yield n
            return
        part = capacity // (k + 1)
        yield part
        n -= part


class Packer:
    """Fills each class's sequences with its fixed count; holds fewer than k pieces of a class."""

    def __init__(self, first_id: int):
        self.next, self.held, self.rows = first_id, defaultdict(list), []

    def add(self, piece: tuple) -> None:
        k = piece[5]
        held = self.held[k]
        held.append(piece)
        if len(held) == k:
            self.close(held)
            self.held[k] = []

    def close(self, pieces: list) -> None:
        at = 0
        for p in pieces:
            self.rows.append((*p[:6], self.next, at))
            at += p[2]
        self.next += 1

    def left(self) -> list:
        return [(*p[:6], None, None) for held in self.held.values() for p in held]


def batch_of(rows: list) -> pa.RecordBatch:
    types = [pa.int64()] * 5 + [pa.int32(), pa.int64(), pa.int64()]
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 8
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], NAMES)


def tokenise_and_pack(tokenizer_path: str | None, capacity: int, end_id: int):
    def run(batches):
        from pyspark import TaskContext

        encode, packer = encoder(tokenizer_path, end_id), Packer(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = memoryview(encode(text.as_py()))
                n, at = len(ids) // 4, 0
                for length in cuts(n, capacity):
                    packer.add((doc, at, length, zlib.crc32(ids[4 * at : 4 * (at + length)]), n, class_of(length, capacity)))
                    at += length
                if len(packer.rows) > 20_000:
                    yield batch_of(packer.rows)
                    packer.rows = []
        yield batch_of(packer.rows + packer.left())

    return run


def pack_again(level: int):
    """A level of the tree: pieces that workers of the level below left, sorted by class and group of workers."""

    def run(batches):
        from pyspark import TaskContext

        packer, last, rows = Packer((level << 56) + (TaskContext.get().partitionId() << 32)), None, []

        def taken() -> None:
            rows.extend((*r, last[1]) for r in packer.rows)
            packer.rows = []

        def left() -> None:
            taken()
            rows.extend((*r, last[1]) for r in packer.left())
            packer.held.clear()

        for batch in batches:
            for *row, group in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (row[5], group) != last:
                    if last:
                        left()
                    last = row[5], group
                packer.add(tuple(row))
            if last:
                taken()
            if rows:
                yield grouped_batch(rows)
                rows.clear()
        if last:
            left()
        if rows:
            yield grouped_batch(rows)

    return run


def grouped_batch(rows: list) -> pa.RecordBatch:
    *_, groups = zip(*rows, strict=True)
    own = batch_of([r[:-1] for r in rows])
    return pa.RecordBatch.from_arrays([*own.columns, pa.array(groups, pa.int64())], [*NAMES, "worker"])


def pack_last(capacity: int):
    """Fewer than k pieces of each class: first fit, largest first."""

    def run(batches):
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        bins: list[list] = []
        room: list[int] = []
        for row in sorted(rows, key=lambda r: (-r[2], r[0] is None, r[0] or 0, r[1])):
            at = next((i for i, x in enumerate(room) if x >= row[2]), None)
            if at is None:
                at = len(bins)
                bins.append([])
                room.append(capacity)
            bins[at].append(row)
            room[at] -= row[2]
        packer = Packer(1 << 62)
        for pieces in bins:
            packer.close(pieces)
        yield batch_of(packer.rows)

    return run


def pack(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, k, sequence_id, offset. tokenizer_path None: the public word BPE."""
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tokenised = texts.mapInArrow(tokenise_and_pack(tokenizer_path, capacity, end_id), PIECE)
    now = scratch.keep(tokenised.withColumn("worker", F.spark_partition_id()), "first")
    done, level, workers = [now.where("sequence_id is not null").drop("worker")], 0, (now.agg(F.max("worker")).first()[0] or 0) + 1
    rest = now.where("sequence_id is null")
    while workers > 1:
        level, workers = level + 1, parts(workers, FAN_IN)
        grouped = rest.withColumn("worker", F.expr(f"worker div {FAN_IN}"))
        dealt = grouped.repartition("k", "worker").sortWithinPartitions("k", "worker", "doc_id", "start", "length", "ids_crc32")
        packed = dealt.select(*NAMES, "worker").mapInArrow(pack_again(level), f"{PIECE}, worker long")
        now = scratch.keep(packed, f"level-{level}")
        done.append(now.where("sequence_id is not null").drop("worker"))
        rest = now.where("sequence_id is null")
    last = rest.drop("worker").repartition(1).mapInArrow(pack_last(capacity), PIECE)
    return union_all([*done, last])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
