"""Exact removal of repeated substrings, by column-wise suffix sorting of many short strings.

Every byte covered by a `LENGTH`-byte string that also starts elsewhere, in another document or the
same one, is removed; overlaps count, and strings are judged on the input. In steps, each lossless:

1. Every window of LENGTH bytes names the least of its hashed GRAM-byte grams (the leftmost of
   equals): its anchor. Equal windows have equal anchors at equal offsets, so windows whose anchor's hash
   occurs once are unique. A document's windows with one anchor are a fragment of it; equal fragments are
   folded, with their number.
2. A fragment's windows fall into blocks of BLOCK offsets from the anchor. All windows of a block share
   its core; blocks with equal cores (by 128-bit hash) form a collection of strings: up to BLOCK - 1
   bytes, the core as one symbol, up to BLOCK - 1 bytes. Equal strings are folded, with their number.
3. Each collection's Burrows-Wheeler transform and common prefixes are built column by column, from
   the strings' ends: each round inserts one symbol of every string (op9_columns). Windows whose suffix
   shares LENGTH bytes with a neighbour's are repeated. A folded string is marked as a neighbour of its own, which saves inserting it twice;
   inserted twice (`twice`), it is found by the common prefixes, with the same result.
4. What is found goes back to all fragments that are equal.

A core with more than MOST strings doesn't meet in one task: its strings are blocked again at half the
block, under longer cores, until none is larger (a block of one offset leaves one string a core).
Columns beyond op9_columns.RESIDENT bytes are sequential files in the shared folder. Documents meet
their findings by (doc_id, hash of text).

Null texts are empty; texts shorter than LENGTH lose nothing. Repeated rows repeat each other, so long
ones lose all. A null doc_id is an ordinary value. Long texts are read in chunks. An empty table gives an empty result.
Further columns stay, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, fresh, slices, table
from .op9_columns import CORE, repeats

LENGTH, GRAM, BLOCK = 200, 32, 32
CHUNK = 1 << 19
BATCH, MOST = 1 << 14, 1 << 12
OUT_ROWS = 1 << 15
#: What becomes of a string that occurs more than once: it is marked as its own neighbour, both are inserted in the transform, or it counts as one.
MARKED, INSERTED, ONCE = "marked", "inserted", "once"
ODD = 0x9E3779B97F4A7C15
ANCHOR = "h long, fh long, k1 long, k2 int, a int, s int, n int"
PIECE = "g1 long, g2 long, cid long, lead binary, tail binary, h long, fh long, s int, times int"
FOUND = "g1 long, g2 long, cid long, b int, e int"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def names_of(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


# -- 1: anchors --------------------------------------------------------------------------------


@lru_cache(1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    n = CHUNK + 2 * LENGTH
    up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, ODD, np.uint64)]), dtype=np.uint64)
    down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, pow(ODD, -1, 2**64), np.uint64)]), dtype=np.uint64)
    return up, down


def gram_hashes(a: np.ndarray, gram: int) -> np.ndarray:
    up, down = powers()
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[: len(a)], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[: len(a) - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    n = len(v)
    rows = -(-n // width)
    grid = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    grid[:n] = v
    grid = grid.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def fragments(text: bytes, length: int = LENGTH, gram: int = GRAM):
    """(h, a, s, n) arrays: anchor hash and place, first window and number of windows of each fragment."""
    data = np.frombuffer(text, np.uint8)
    out = []
    low = np.uint64((1 << 20) - 1)
    for at in range(0, len(data) - length + 1, CHUNK):
        part = data[at : at + CHUNK + length - 1]
        h = gram_hashes(part, gram)
        ranked = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        place = (sliding_least(ranked, length - gram + 1) & low).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        out.append((h[place[first]].view(np.int64), place[first] + at, first + at, np.diff(np.append(first, len(place)))))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 4


def anchor_rows(length: int, gram: int):
    types = [pa.int64()] * 3 + [pa.int32()] * 4

    def frame(cols):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(t.to_pandas_dtype())) for c, t in zip(cols, types, strict=True)], names_of(ANCHOR))

    def run(batches):
        cols: list[list] = [[] for _ in types]
        rows = 0
        for batch in batches:
            for k1, k2, text in zip(*batch.columns, strict=True):
                text = text.as_py()
                if len(text) < length:
                    continue
                h, a, s, n = fragments(text, length, gram)
                view = memoryview(text)
                fh = np.array([xxhash.xxh64_intdigest(view[i : i + k + length - 1]) for i, k in zip(s.tolist(), n.tolist(), strict=True)], np.uint64).view(np.int64)
                for col, x in zip(cols, (h, fh, np.full(len(h), k1.as_py()), np.full(len(h), k2.as_py()), a, s, n), strict=True):
                    col.append(x)
                rows += len(h)
                if rows >= OUT_ROWS:
                    yield frame(cols)
                    cols, rows = [[] for _ in types], 0
        if rows:
            yield frame(cols)

    return run


# -- 2: blocks ---------------------------------------------------------------------------------


def pieces(text: bytes, a: int, s: int, n: int, length: int = LENGTH, block: int = BLOCK):
    """(core, lead, tail, first window) of each block of a fragment's windows."""
    for b in range((a - s - n + 1) // block, (a - s) // block + 1):
        last, first = a - b * block, a - b * block - block + 1
        lo, hi = max(s, first), min(s + n - 1, last)
        yield text[last : first + length], text[lo:last], text[first + length : hi + length], lo


def piece_rows(length: int, block: int):
    """The blocks of the fragments asked of each text. Repeated rows of one key lie side by side and are asked once a task."""
    types = [pa.int64()] * 3 + [pa.binary()] * 2 + [pa.int64(), pa.int64(), pa.int32(), pa.int32()]

    def frame(cols):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names_of(PIECE))

    def run(batches):
        cols, last = [[] for _ in types], None
        g1s, g2s, cids, leads, tails, hs, fhs, starts, times = cols
        for batch in batches:
            for k1, k2, text, asked in zip(*batch.columns, strict=True):
                if (key := (k1.as_py(), k2.as_py())) == last:
                    continue
                last, text = key, text.as_py()
                for f in asked.as_py():
                    h, fh, n, s = f["h"], f["fh"], f["times"], f["s"]
                    for core, lead, tail, at in pieces(text, f["a"], s, f["n"], length, block):
                        g1, g2 = struct.unpack(">qq", xxhash.xxh3_128_digest(core))
                        g1s.append(g1)
                        g2s.append(g2)
                        cids.append(struct.unpack(">q", xxhash.xxh64_digest(lead + b"|" + tail, len(lead)))[0])
                        leads.append(lead)
                        tails.append(tail)
                        hs.append(h)
                        fhs.append(fh)
                        starts.append(at - s)
                        times.append(n)
                if len(g1s) >= OUT_ROWS:
                    yield frame(cols)
                    for c in cols:
                        c.clear()
        if g1s:
            yield frame(cols)

    return run


# -- 3: collections ----------------------------------------------------------------------------


def parts_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins, lengths and bytes of a binary column."""
    ends = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)
    return ends[:-1], np.diff(ends), data


def symbol_rows(leads: pa.Array, tails: pa.Array, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the strings picked: a row of symbols for each round, their lengths and their tails' lengths."""
    sides = [parts_of(x) for x in (leads, tails)]
    nl, nt = sides[0][1][pick], sides[1][1][pick]
    lengths = nl + nt + 1
    out = np.zeros((int(lengths.max()), len(pick)), np.uint16)
    out[nt, np.arange(len(pick))] = CORE
    for (begins, _, data), sizes, last in ((sides[0], nl, lengths - 1), (sides[1], nt, nt - 1)):
        which = np.repeat(np.arange(len(pick)), sizes)
        k = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[last[which] - k, which] = data[begins[pick][which] + k].astype(np.uint16) + 1
    return out, lengths, nt


def collection_rows(length: int, block: int, folder: str | None, twice: str = MARKED):
    """Rows (g1, g2, cid, lead, tail, times) sorted by core: runs of repeated windows (first, end) of each distinct string."""
    core = length - block + 1

    def flush(t: pa.Table):
        g1, g2, times = (t.column(i).to_numpy() for i in (0, 1, 5))
        group = np.cumsum(np.append(True, (g1[1:] != g1[:-1]) | (g2[1:] != g2[:-1]))) - 1
        pick = np.flatnonzero(np.bincount(group, times)[group] > 1)
        if not len(pick):
            return
        if twice == INSERTED:
            pick = np.repeat(pick, times[pick])
        symbols, lengths, tails = symbol_rows(t.column(3).combine_chunks(), t.column(4).combine_chunks(), pick)
        string, place = repeats(group[pick], symbols, lengths, tails, (times[pick] > 1) & (twice == MARKED), core, length, folder)
        at = np.unique(pick[string] << 9 | place)
        first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        if not len(first):
            return
        ends = at[np.append(first[1:], len(at)) - 1]
        row, b, e = at[first] >> 9, at[first] & 511, (ends & 511) + 1
        cols = [pa.array(t.column(i).to_numpy()[row]) for i in range(3)]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(b.astype(np.int32)), pa.array(e.astype(np.int32))], names_of(FOUND))

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows < BATCH:
                continue
            t = pa.Table.from_batches(held)
            g1, g2 = (t.column(i).to_numpy() for i in (0, 1))
            starts = np.flatnonzero((g1[1:] != g1[:-1]) | (g2[1:] != g2[:-1])) + 1
            for lo, hi in zip([0, *(cuts := bounds(starts, BATCH))][:-1], cuts, strict=True):
                yield from flush(t.slice(lo, hi - lo))
            t = t.slice(cuts[-1] if cuts else 0)
            held, rows = t.to_batches(), len(t)
        if rows:
            yield from flush(pa.Table.from_batches(held))

    return run


def bounds(starts: np.ndarray, rows: int) -> list[int]:
    """Of the places where groups start, those that end batches of about `rows` rows; the last group stays for what follows."""
    out, at = [], 0
    for x in starts.tolist():
        if x - at >= rows or x == starts[-1]:
            out.append(x)
            at = x
    return out


# -- Spark -------------------------------------------------------------------------------------


def keyed(docs: DataFrame, k1: str, k2: str) -> DataFrame:
    """Adds the row's key: its doc_id and a hash of its text. Rows that share it are alike."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumns({k1: F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)), k2: F.hash(text)})


def halves(strings: DataFrame, block: int) -> DataFrame:
    """(o1, o2, oid, g1, g2, cid, lead, tail, times, shift): strings blocked at half the block, the string each comes from, and how far in it starts."""
    b = block // 2
    nl, nt = F.octet_length("lead"), F.octet_length("tail")

    def half(core, lead, tail, shift):
        hashed = lambda seed: F.xxhash64(F.lit(seed), F.lit(block), "g1", "g2", core)
        return F.struct(hashed(1).alias("g1"), hashed(2).alias("g2"), F.xxhash64(lead, F.lit("|"), tail).alias("cid"), lead.alias("lead"), tail.alias("tail"), shift.cast("int").alias("shift"))

    part = lambda x, at, n: F.substring(F.col(x), at, n)
    left = F.when(nl >= b, half(F.concat(F.lit(b"<"), F.expr(f"substring(lead, -{b}, {b})")), F.expr(f"substring(lead, 1, octet_length(lead) - {b})"), part("tail", 1, b - 1), F.lit(0)))
    keep = F.expr(f"substring(lead, greatest(1, octet_length(lead) - {b - 2}), {b})") if b > 1 else F.lit(b"")
    right = F.when(nt >= b, half(F.concat(F.lit(b">"), part("tail", 1, b)), keep, F.expr(f"substring(tail, {b + 1}, {block})"), F.greatest(F.lit(0), nl - (b - 1))))
    out = strings.withColumn("half", F.explode(F.array_compact(F.array(left, right))))
    return out.select(F.col("g1").alias("o1"), F.col("g2").alias("o2"), F.col("cid").alias("oid"), "half.*", "times")


def repeated_windows(cut: DataFrame, scratch: Scratch, length: int, block: int, most: int = MOST, level: int = 0, twice: str = MARKED) -> DataFrame:
    """Strings (g1, g2, cid, lead, tail, times), repeated or not -> (g1, g2, cid, b, e): runs of repeated windows of each."""

    def built(rows: DataFrame) -> DataFrame:
        # Under a block of one, equal cores are equal strings, which are counted before they meet.
        dealt = rows.select(*STRING) if block == 1 else rows.select(*STRING).repartition("g1", "g2")
        met = folded(dealt).sortWithinPartitions("g1", "g2", "cid")
        return met.mapInArrow(collection_rows(length, block, scratch.folder(f"columns-{level}"), twice), FOUND)

    sizes = cut.groupBy("g1", "g2").agg(F.count("*").alias("n")).where(F.col("n") > most).select("g1", "g2")
    hot = scratch.keep(sizes, f"hot-{level}")
    if block == 1 or not hot.count():
        return scratch.keep(built(cut), f"found-{level}")
    cool = scratch.keep(built(cut.join(hot, ["g1", "g2"], "left_anti")), f"found-{level}")
    split = scratch.keep(halves(folded(cut.join(hot, ["g1", "g2"], "left_semi")), block), f"halves-{level}")
    inner = repeated_windows(split, scratch, length, block // 2, most, level + 1, twice)
    back = split.select("o1", "o2", "oid", "shift", "g1", "g2", "cid").join(inner, ["g1", "g2", "cid"])
    shifted = back.select(F.col("o1").alias("g1"), F.col("o2").alias("g2"), F.col("oid").alias("cid"), (F.col("b") + F.col("shift")).alias("b"), (F.col("e") + F.col("shift")).alias("e"))
    return cool.unionByName(shifted)


STRING = names_of("g1 long, g2 long, cid long, lead binary, tail binary, times int")


def folded(strings: DataFrame) -> DataFrame:
    """Distinct strings with their number (two stand for more)."""
    return strings.groupBy("g1", "g2", "cid").agg(F.first("lead").alias("lead"), F.first("tail").alias("tail"), F.least(F.sum("times"), F.lit(2)).cast("int").alias("times"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK, most: int = MOST, twice: str = MARKED) -> DataFrame:
    """(k1, k2, spans): from and to (excluded) of repeated strings, unmerged, of the rows that have any."""
    scratch = Scratch(docs.sparkSession)
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    texts = keyed(docs.select("doc_id", "text"), "k1", "k2").select("k1", "k2", body.alias("body"))
    anchors = scratch.keep(texts.mapInArrow(anchor_rows(length, gram), ANCHOR), "anchors")
    often = scratch.keep(anchors.groupBy("h").count().where("count > 1").select("h"), "often")
    met = scratch.keep(anchors.join(often, "h"), "met")
    del anchors, often
    scratch.drop("anchors")
    one = F.min(F.struct("k1", "k2", "a", "s", "n")).alias("one")
    kinds = met.groupBy("h", "fh").agg(F.least(F.count("*"), F.lit(2)).cast("int").alias("times"), one)
    asked = kinds.groupBy("one.k1", "one.k2").agg(F.collect_list(F.struct("one.a", "one.s", "one.n", "h", "fh", "times")).alias("asked"))
    cut = texts.join(asked, ["k1", "k2"]).select("k1", "k2", "body", "asked").mapInArrow(piece_rows(length, block), PIECE)
    cut = scratch.keep(cut, "pieces")
    scratch.release()
    found = repeated_windows(cut, scratch, length, block, most, twice=twice)
    scratch.release()
    runs = cut.select("g1", "g2", "cid", "h", "fh", "s").join(found, ["g1", "g2", "cid"])
    own = F.collect_set(F.struct((F.col("s") + F.col("b")).alias("b"), (F.col("s") + F.col("e") - 1 + length).alias("e"))).alias("own")
    kind_spans = scratch.keep(runs.groupBy("h", "fh").agg(own), "kind-spans")
    scratch.drop("pieces")
    placed = met.select("k1", "k2", "h", "fh", "s").join(kind_spans, ["h", "fh"])
    moved = F.transform("own", lambda x: F.struct((x["b"] + F.col("s")).alias("b"), (x["e"] + F.col("s")).alias("e")))
    spans = placed.groupBy("k1", "k2").agg(F.flatten(F.collect_set(moved)).alias("spans"))
    return scratch.keep(spans, "spans")


def merged(spans, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the maximal runs."""
    b, e = spans
    order = np.argsort(b, kind="stable")
    b, e = b[order], np.maximum.accumulate(e[order])
    first = np.flatnonzero(np.append(True, b[1:] > e[:-1])) if len(b) else np.empty(0, np.int64)
    return b[first], e[np.append(first[1:] - 1, len(b) - 1)] if len(b) else e


def kept_of(text: bytes, b: np.ndarray, e: np.ndarray) -> bytes:
    ends = np.concatenate([[0], np.stack([b, e], 1).ravel(), [len(text)]]).tolist()
    return b"".join(text[x:y] for x, y in zip(ends[::2], ends[1::2], strict=True))


def each_kept(texts: pa.Array, spans: pa.Array):
    """(text's bytes, runs' begins, runs' ends) of each row."""
    flat = spans.flatten()
    b, e = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
    sizes = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    at = 0
    for text, n in zip(texts, sizes.tolist(), strict=True):
        text = (text.as_py() or "").encode()
        yield text, *merged((b[at : at + n], e[at : at + n]), len(text))
        at += n


def digest_rows(batches):
    for batch in batches:
        for part in slices(batch, 1):
            rows = []
            for text, b, e in each_kept(part.column(1), part.column(2)):
                rows.append((len(text), int((e - b).sum()), len(b), hashlib.sha256(kept_of(text, b, e)).hexdigest()))
            types = [pa.int64()] * 3 + [pa.string()]
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names_of(RESULT))


def with_spans(docs: DataFrame, length: int = LENGTH, spans: str = "spans", **how) -> DataFrame:
    """The documents' columns and `spans` (null where none)."""
    k1, k2, s1, s2 = (fresh(x, [*docs.columns, spans]) for x in ("k1", "k2", "s1", "s2"))
    found = repeated_spans(docs, length, **how).select(F.col("k1").alias(s1), F.col("k2").alias(s2), F.col("spans").alias(spans))
    d = keyed(docs, k1, k2)
    return d.join(found, (F.col(k1) == F.col(s1)) & (F.col(k2) == F.col(s2)), "left").drop(k1, k2, s1, s2)


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with the repeated bytes gone; what is left of a cut character goes too, and n_chars is counted anew."""
    names, spans = docs.columns, fresh("spans", docs.columns)
    at, n = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def cut(part):
        texts, counts = [], []
        for text, b, e in each_kept(part.column(at), part.column(len(names))):
            kept = kept_of(text, b, e).decode("utf-8", "ignore")
            texts.append(kept)
            counts.append(len(kept))
        cols = list(part.columns[: len(names)])
        cols[at] = pa.array(texts, cols[at].type)
        if n is not None:
            cols[n] = pa.array(counts, cols[n].type)
        return pa.RecordBatch.from_arrays(cols, names)

    def run(batches):
        for batch in batches:
            for part in slices(batch, at):
                hit = part.column(len(names)).is_valid()
                if hit.false_count:
                    yield part.filter(pc.invert(hit)).select(names)
                if hit.true_count:
                    yield cut(part.filter(hit))

    return with_spans(docs, length, spans).select(*[f"`{x}`" for x in names], spans).mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_spans(docs).select("doc_id", "text", "spans").mapInArrow(digest_rows, RESULT)
