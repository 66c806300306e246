"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint's 64 bits are three segments of 22, 21 and 21 bits, words of the binary Golay code of
length 23. A word decodes to the codewords within four bits of it: one, where its nearest is within
two, else six. Two words that differ in at most two bits share such a codeword always. Two
fingerprints that differ in at most two bits have one segment of the three without an error
(pigeonhole), and at most two errors in the next: so they meet under the exact value of the one
with a codeword index of the other. Each fingerprint has 3 to 18 such keys. Rows that meet are
verified by counting bits, and only links that join a key's rows into components are kept, so no
group's pairs are ever listed. Equal fingerprints are folded first. `near_copies` finds texts of Jaccard similarity
SIMILAR and more by shingles of five words: fingerprints and min-hash bands name candidates, whole shingle sets decide.

Null and empty texts have no word and fingerprint zero, linked like any other. Fewer words than a
shingle make one shingle. A null doc_id is never a component's name unless all its members lack an
id. Repeated rows each come out. An empty table gives an empty result. Very long texts are hashed in chunks; further
columns, whatever their names, are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, connected_components, fresh, slices, table, union_all

WORDS, SEED, DISTANCE = 3, 42, 2
WIDE_WORDS, SIMILAR = 5, 0.8
BANDS, BAND_ROWS = 20, 5  # a pair at 0.8 shares no band in one of 2,800 cases
HOT_ROWS = 1000
GROUP, LEADERS = 512, 64  # documents compared in one task; of larger groups, those that go ahead
SEGMENTS = ((42, 22), (21, 21), (0, 21))  # lowest bit and width
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, of the (23, 12) code
CHUNK = 1 << 16
DENSE = 2048


# -- fingerprints ------------------------------------------------------------------------------


def fingerprint(text: bytes | None, n: int = WORDS, seed: int = SEED) -> int:
    """Majority bits of the XXH64 values of all shingles of the ASCII-lower-cased words."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    total = max(1, len(words) - n + 1)
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, CHUNK):
        part = words[at : at + CHUNK + n - 1]
        shingles = zip(*(part[k:] for k in range(n)), strict=False) if len(words) >= n else [part]
        h = np.array([digest(x, seed) for x in map(b" ".join, shingles)], ">u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    bits = (2 * votes > total).astype(np.uint8)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(docs: DataFrame, n: int = WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): fp the fingerprint's 64 bits as a long."""

    def run(batches):
        for batch in batches:
            found = [fingerprint(t.as_py(), n, seed) for t in batch.column(1)]
            fp = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["doc_id", "fp"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return texts.mapInArrow(run, "doc_id long, fp long")


def shingle_set(text: bytes | None, n: int = WIDE_WORDS) -> np.ndarray:
    """Sorted distinct XXH64 values of all shingles; fewer words than a shingle make one, no words none."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    shingles = zip(*(words[k:] for k in range(n)), strict=False) if len(words) >= n else [words]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in map(b" ".join, shingles)), np.uint64))


@lru_cache(1)
def mixers() -> np.ndarray:
    return np.random.default_rng(SEED).integers(1, 1 << 63, (2, BANDS * BAND_ROWS), np.uint64) | np.uint64(1)


def band_keys(found: np.ndarray) -> np.ndarray:
    """A key for each band of min-hashes of a shingle set; none for an empty set."""
    if not len(found):
        return np.empty(0, np.int64)
    flip, times = mixers()
    low = np.full(BANDS * BAND_ROWS, ~np.uint64(0))
    for at in range(0, len(found), 1024):
        low = np.minimum(low, ((found[at : at + 1024, None] ^ flip) * times).min(0))
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(low.reshape(BANDS, BAND_ROWS))], np.uint64).view(np.int64)


def name_of_set(found: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(found.tobytes(), SEED)


def set_prints(texts: DataFrame) -> DataFrame:
    """(row_id, hash, text) -> (row_id, hash, fp, one, keys): the fingerprint, the shingle set's name and its band keys."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 2):
                texts = part.column(2).to_pylist()
                sets = [shingle_set(t) for t in texts]
                fp, one = (pa.array(np.array(x, np.uint64).view(np.int64)) for x in ([fingerprint(t) for t in texts], [name_of_set(x) for x in sets]))
                keys = pa.array([band_keys(x) for x in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), fp, one, keys], ["row_id", "hash", "fp", "one", "keys"])

    return texts.mapInArrow(run, "row_id long, hash long, fp long, one long, keys array<long>")


def whole_sets(texts: DataFrame) -> DataFrame:
    """(one, root, least, text) -> (one, root, least, hashes): the shingle set itself."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 3):
                sets = [shingle_set(t.as_py()).tobytes() for t in part.column(3)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(sets, pa.binary())], ["one", "root", "least", "hashes"])

    return texts.mapInArrow(run, "one long, root long, least long, hashes binary")


def row_texts(docs: DataFrame) -> DataFrame:
    """(row_id, hash, text): what names a row, its doc_id (the largest long where it is null) and a hash of its text, beside the text's bytes."""
    text = F.col("text").cast("string")
    return docs.select(row_id().alias("row_id"), F.xxhash64(text).alias("hash"), text.cast("binary").alias("text"))


def row_id():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))


# -- the Golay code ----------------------------------------------------------------------------


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words modulo the generator."""
    r = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        r ^= np.where(r >> bit & 1, GENERATOR << (bit - 11), 0)
    return r


@lru_cache(1)
def errors() -> np.ndarray:
    """For each syndrome, the error patterns of weight up to 4 that lead to a codeword: one (five times over nothing, -1), or six."""
    from itertools import combinations

    out = np.full((2048, 6), -1, np.int64)
    count = np.zeros(2048, np.int64)
    for weight in (0, 1, 2, 3, 4):
        masks = np.array([sum(1 << i for i in c) for c in combinations(range(23), weight)], np.int64)
        for s, mask in zip(syndrome(masks).tolist(), masks.tolist(), strict=True):
            if weight < 4 or count[s] and bin(out[s, 0]).count("1") == 3:
                out[s, count[s]] = mask
                count[s] += 1
    return out


def keys_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every fuzzy key of unsigned fingerprints; a key is unique to its kind of segment."""
    rows, keys = [], []
    cut = [(fp >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.int64) for low, width in SEGMENTS]
    for kind in range(3):
        word = cut[(kind + 1) % 3]
        near = errors()[syndrome(word)]
        row, col = np.nonzero(near >= 0)
        index = (word[row] ^ near[row, col]) >> 11  # the information bits name the codeword
        rows.append(row)
        keys.append((np.int64(kind) << 60) | (cut[kind][row] << 12) | index)
    return np.concatenate(rows), np.concatenate(keys)


def fuzzy_keys(batches):
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False)
        row, key = keys_of(fp.view(np.uint64))
        yield pa.RecordBatch.from_pydict({"key": pa.array(key), "fp": pa.array(fp[row])})


# -- links -------------------------------------------------------------------------------------


@lru_cache(1)
def near_masks() -> np.ndarray:
    one = [1 << i for i in range(64)]
    return np.array(one + [a | b for i, a in enumerate(one) for b in one[:i]], np.uint64)


def forest(fp: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Links that join distinct fingerprints within `distance` bits into their components, a spanning forest of them.

    Few rows are compared with one another; of many, each looks up its neighbours' values.
    """
    up = np.arange(len(fp))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    out = []

    def join(a, b):
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            x, y = root(i), root(j)
            if x != y:
                up[max(x, y)] = min(x, y)
                out.append((i, j))

    if len(fp) <= DENSE:
        for at in range(0, len(fp), 256):
            far = np.bitwise_count(fp[at : at + 256, None] ^ fp[None, :])
            a, b = np.nonzero(far <= distance)
            a = a + at
            join(a[a < b], b[a < b])
    else:
        order = np.argsort(fp)
        known = fp[order]
        for mask in near_masks():
            other = known ^ mask
            at = np.minimum(np.searchsorted(known, other), len(known) - 1)
            hit = np.flatnonzero((known[at] == other) & (known < other))
            join(order[hit], order[at[hit]])
    return out


def link_groups(batches):
    """Rows sorted by key: the links of each key's rows. A key may go on in the next batch."""
    held_key, held = np.empty(0, np.int64), np.empty(0, np.int64)

    def links(key, fp):
        bounds = np.flatnonzero(np.diff(key, prepend=np.nan, append=np.nan) != 0)
        a, b = [], []
        sizes = np.diff(bounds)
        two = bounds[:-1][sizes == 2]
        x, y = fp[two], fp[two + 1] if len(two) else fp[:0]
        near = np.bitwise_count((x ^ y).view(np.uint64)) <= DISTANCE
        a.append(x[near])
        b.append(y[near])
        for start, size in zip(bounds[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            own = fp[start : start + size]
            found = np.array(forest(own.view(np.uint64)), np.int64).reshape(-1, 2)
            a.append(own[found[:, 0]])
            b.append(own[found[:, 1]])
        return pa.RecordBatch.from_pydict({"a": pa.array(np.concatenate(a)), "b": pa.array(np.concatenate(b))})

    for batch in batches:
        key = np.concatenate([held_key, batch.column(0).to_numpy(zero_copy_only=False)])
        fp = np.concatenate([held, batch.column(1).to_numpy(zero_copy_only=False)])
        if not len(key):
            continue
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            yield links(key[:cut], fp[:cut])
        held_key, held = key[cut:], fp[cut:]
    if len(held_key):
        yield links(held_key, held)


class Sets:
    """Shingle sets side by side, to be compared with any one of them or another."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in sets], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.known, self.index = np.unique(np.concatenate(sets), return_inverse=True)

    def near(self, other: np.ndarray, similar: float) -> np.ndarray:
        """Which sets have a Jaccard similarity of `similar` and more with `other`."""
        hit = np.zeros(len(self.known) + 1, np.int64)
        at = np.searchsorted(self.known, other)
        at = at[self.known[np.minimum(at, len(self.known) - 1)] == other] if len(self.known) else at[:0]
        hit[at] = 1
        total = np.append(0, np.cumsum(hit[self.index]))
        both = total[self.ends] - total[self.ends - self.sizes]
        return (both > 0) & (both >= similar * (self.sizes + len(other) - both) - 1e-9)


def hashes_of(batch, i: int) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), np.uint64) for x in batch.column(i)]


def thinned(similar: float):
    """Rows (root, one, hashes) sorted by root and least: `gone` where an earlier one that stays is near."""

    def judge(ids, sets):
        own, gone = Sets(sets), np.zeros(len(sets), bool)
        for i in range(len(sets)):
            if not gone[i]:
                near = own.near(sets[i], similar)
                near[: i + 1] = False
                gone |= near
        return pa.RecordBatch.from_pydict({"one": pa.array(ids, pa.int64()), "gone": pa.array(gone)})

    def run(batches):
        root, ids, sets = None, [], []
        for batch in batches:
            for r, i, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), hashes_of(batch, 2), strict=True):
                if r != root and ids:
                    yield judge(ids, sets)
                    ids, sets = [], []
                root = r
                ids.append(i)
                sets.append(found)
        if ids:
            yield judge(ids, sets)

    return run


def beside_leaders(similar: float):
    """Rows (root, part, follows, one, hashes), each part's leaders first: `gone` of each follower that a leader is near to."""

    def run(batches):
        at, leaders, own = None, [], None
        for batch in batches:
            ids, gone = [], []
            for r, part, follows, i, found in zip(*(batch.column(k).to_pylist() for k in range(4)), hashes_of(batch, 4), strict=True):
                if (r, part) != at:
                    at, leaders, own = (r, part), [], None
                if not follows:
                    leaders.append(found)
                    continue
                own = own or Sets(leaders)
                ids.append(i)
                gone.append(bool(own.near(found, similar).any()))
            yield pa.RecordBatch.from_pydict({"one": pa.array(ids, pa.int64()), "gone": pa.array(gone, pa.bool_())})

    return run


def near_components(prints: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, fp) -> (fp, component_id): components of distinct fingerprints, each named by its least doc_id."""
    distinct = scratch.keep(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    keyed = scratch.keep(distinct.select("fp").mapInArrow(fuzzy_keys, "key long, fp long"), "keys")
    shared = keyed.groupBy("key").count().where("count > 1").select("key")
    met = keyed.join(shared, "key").repartition("key").sortWithinPartitions("key", "fp")
    edges = scratch.keep(met.mapInArrow(link_groups, "a long, b long").distinct(), "edges")
    root = connected_components(edges, scratch)
    named = distinct.join(root, distinct["fp"] == root["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    best = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.select("fp", "root").join(best, "root").select("fp", "component_id")


def classify(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """(doc_id, fp, component_id) of each row."""
    scratch = Scratch(docs.sparkSession)
    prints = scratch.keep(fingerprints(docs, n), "prints")
    classes = scratch.keep(near_components(prints, scratch), "classes")
    return prints.join(classes.withColumnRenamed("fp", "c_fp"), F.col("fp") == F.col("c_fp")).select("doc_id", "fp", "component_id")


def near_copies(docs: DataFrame, similar: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """(row_id, hash) of the rows that stay: none is near another, by the shingles of their whole texts. And those of HOT_ROWS rows each, and a thousandth of all.

    Taken by ascending id (null last), a text goes where one that stays has a similarity of `similar` and more: none goes for a chain of
    others. Texts of equal shingle sets are one: its row of the least id, and hash of text, stands for it. Candidates
    share a band of min-hashes or a component of fingerprints; each one's set travels to its candidates' group. A
    group over GROUP is thinned by its first LEADERS first, in as many parts as its size takes, and what stays is parted by its rarest
    shingles, until it is small; the outcome is the same.
    """
    scratch = Scratch(docs.sparkSession)
    prints = scratch.keep(set_prints(row_texts(docs)), "prints")
    first_row = F.min(F.struct("row_id", "hash"))
    sets = scratch.keep(prints.groupBy("one").agg(first_row.alias("first"), F.any_value("keys").alias("keys")).select("one", F.col("first.row_id").alias("least"), "first.hash", "keys"), "sets")
    classes = near_components(prints.select(F.col("row_id").alias("doc_id"), "fp"), scratch).withColumnRenamed("fp", "c_fp")
    by_print = prints.select("fp", "one").distinct().join(classes, F.col("fp") == F.col("c_fp")).select(F.col("component_id").alias("key"), "one")
    keyed = scratch.keep(sets.select(F.explode("keys").alias("key"), "one").unionByName(by_print), "keyed")
    heads = keyed.groupBy("key").agg(F.min("one").alias("a"), F.count("*").alias("n")).where("n > 1").select("key", "a")
    edges = scratch.keep(keyed.withColumnRenamed("one", "b").join(heads, "key").where("a <> b").select("a", "b").distinct(), "stars")
    scratch.drop("keyed")
    root = connected_components(edges, scratch, "near")
    members = scratch.keep(root.join(sets, F.col("node") == F.col("one")).select("one", "root", "least", "hash"), "members")
    asked = members.withColumnRenamed("hash", "m_hash").hint("merge")  # it grows with the documents
    texts = row_texts(docs).join(asked, (F.col("row_id") == F.col("least")) & (F.col("hash") == F.col("m_hash")))
    left = whole_sets(texts.select("one", "root", "least", "text")).dropDuplicates(["one"])
    left = scratch.keep(left.select("root", "least", "one", "hashes"), "left-0")
    del texts, asked
    scratch.release()
    judged, step = [], 0
    while True:
        sizes = scratch.keep(left.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") > GROUP).select(F.col("root").alias("g_root"), "n"), f"sizes-{step}")
        on = F.col("root") == F.col("g_root")
        small = left.join(sizes, on, "left_anti").select("root", "least", "one", "hashes")
        judged.append(scratch.keep(thin(small, similar), f"small-{step}"))
        if not sizes.count():
            break
        large = left.join(sizes, on)
        first = large.select("root", "least", "one").withColumn("k", F.row_number().over(Window.partitionBy("root").orderBy("least", "one"))).where(F.col("k") <= LEADERS)
        ahead = scratch.keep(first.select(F.col("one").alias("f_one")), f"ahead-{step}")
        is_first = F.col("one") == F.col("f_one")
        leaders = scratch.keep(large.join(ahead, is_first, "left_semi"), f"leaders-{step}")
        tried = scratch.keep(thin(leaders, similar), f"tried-{step}")
        judged.append(tried)
        stay = leaders.join(tried.where("not gone").select(F.col("one").alias("t_one")), F.col("one") == F.col("t_one"), "left_semi")
        count = F.ceil(F.col("n") / GROUP).cast("int")
        spread = stay.select("root", F.explode(F.sequence(F.lit(0), count - 1)).alias("part"), F.lit(False).alias("follows"), "one", "hashes")
        rest = scratch.keep(large.join(ahead, is_first, "left_anti"), f"rest-{step}")
        dealt = rest.select("root", F.pmod(F.xxhash64("one"), count).cast("int").alias("part"), F.lit(True).alias("follows"), "one", "hashes").unionByName(spread)
        met = dealt.repartition("root", "part").sortWithinPartitions("root", "part", "follows")
        beside = scratch.keep(met.mapInArrow(beside_leaders(similar), "one long, gone boolean"), f"beside-{step}")
        judged.append(beside)
        stays = beside.where("not gone").select(F.col("one").alias("b_one"))
        left = scratch.keep(rest.join(stays, F.col("one") == F.col("b_one"), "left_semi").select("root", "least", "one", "hashes"), f"after-{step}")
        step += 1
        left = scratch.keep(parted(left, similar, scratch, step), f"left-{step}")
        scratch.drop(f"after-{step - 1}", f"rest-{step - 1}", f"leaders-{step - 1}", f"left-{step - 1}", release=False)
    gone = union_all(judged).where("gone").select("one")
    stay = scratch.keep(sets.join(gone, "one", "left_anti").select(F.col("least").alias("row_id"), "hash"), "stay")
    most = max(HOT_ROWS, prints.count() // 1000)
    return stay, scratch.keep(prints.groupBy("row_id", "hash").count().where(F.col("count") > most).select("row_id", "hash"), "hot")


def tokens_of(batches):
    """(one, hashes) -> (one, token, size): the hashes one by one."""
    for batch in batches:
        for part in slices(batch, 1, 1 << 20):
            sets = hashes_of(part, 1)
            sizes = np.array([len(x) for x in sets], np.int64)
            one = np.repeat(part.column(0).to_numpy(), sizes)
            if len(one):
                yield pa.RecordBatch.from_pydict({"one": pa.array(one), "token": pa.array(np.concatenate(sets).view(np.int64)), "size": pa.array(np.repeat(sizes, sizes).astype(np.int32))})


def parted(rows: DataFrame, similar: float, scratch: Scratch, step: int) -> DataFrame:
    """Groups still over GROUP, parted by what near sets must share: one of the rarest shingles, as many of them as the similarity
    lets two sets differ in, and one. Sets that share none of theirs with another are near to none, and leave."""
    sizes = rows.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") > GROUP).select(F.col("root").alias("g_root"))
    sizes = scratch.keep(sizes, f"large-{step}")
    if not sizes.count():
        return rows
    on = F.col("root") == F.col("g_root")
    large = scratch.keep(rows.join(sizes, on, "left_semi"), f"whole-{step}")
    tokens = scratch.keep(large.select("one", "hashes").mapInArrow(tokens_of, "one long, token long, size int"), f"tokens-{step}")
    often = tokens.groupBy("token").agg(F.count("*").alias("often"))
    rare = tokens.join(often.where("often > 1").hint("merge"), "token", "left").groupBy("one", "size").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("often", F.lit(1)).alias("often"), "token"))).alias("t"))
    prefix = F.slice("t", F.lit(1), (F.col("size") - F.ceil(F.lit(similar) * F.col("size") - 1e-9) + 1).cast("int"))
    keyed = scratch.keep(rare.select("one", F.explode(F.transform(prefix, lambda x: F.when(x["often"] > 1, x["token"]))).alias("key")).where("key is not null"), f"rare-{step}")
    heads = keyed.groupBy("key").agg(F.min("one").alias("a"), F.count("*").alias("n")).where("n > 1").select("key", "a")
    edges = keyed.withColumnRenamed("one", "b").join(heads, "key").where("a <> b").select("a", "b").distinct()
    again = connected_components(edges, scratch, f"again-{step}").select(F.col("root").alias("root"), F.col("node").alias("a_one"))
    scratch.drop(f"tokens-{step}", release=False)
    own = large.drop("root").join(again, F.col("one") == F.col("a_one")).select("root", "least", "one", "hashes")
    return rows.join(sizes, on, "left_anti").select("root", "least", "one", "hashes").unionByName(own)


def thin(rows: DataFrame, similar: float) -> DataFrame:
    dealt = rows.select("root", "one", "hashes", "least").repartition("root").sortWithinPartitions("root", "least", "one")
    return dealt.mapInArrow(thinned(similar), "one long, gone boolean")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents' rows, one of each set of near copies: whatever isn't near to a row that stays, stays.

    Rows are told apart by id and text, so an id's other texts don't go with it. Rows without an id come last. Null and empty texts
    are alike. Where a row of the same id and text occurs again, that of the least hash of all columns stays.
    """
    names = docs.columns
    ident, text_hash, s_id, s_hash = (fresh(x, names) for x in ("row_id", "row_hash", "stay_id", "stay_hash"))
    stay, hot = (x.select(F.col("row_id").alias(s_id), F.col("hash").alias(s_hash)) for x in near_copies(docs))
    stay = stay.hint("merge")  # it grows with the documents
    named = docs.withColumns({ident: row_id(), text_hash: F.xxhash64(F.col("text").cast("string"))})
    same = (F.col(ident) == F.col(s_id)) & (F.col(text_hash) == F.col(s_hash))
    whole, order = F.struct(*[F.col(f"`{x}`") for x in names]), F.xxhash64(*[F.col(f"`{x}`") for x in names])

    def one_row(rows: DataFrame) -> DataFrame:
        return rows.groupBy(ident, text_hash).agg(F.min_by(whole, order).alias("row"))

    if not hot.count():
        return one_row(named.join(stay, same, "left_semi")).select("row.*")
    # Fewer than a thousand keys are hot; their rows are folded before they meet.
    few = one_row(named.join(F.broadcast(hot), same, "left_semi")).join(stay, same, "left_semi")
    return one_row(named.join(F.broadcast(hot), same, "left_anti").join(stay, same, "left_semi")).unionByName(few).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
