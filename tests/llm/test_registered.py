"""The registered queries without SQL, run as they are on the smallest tables, against brute force."""

import hashlib
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from readtrack.llm import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()


def ran(spark, name):
    return registry.queries()[name](spark, SF).collect()


def words(text):
    return (text or "").encode().split()


def test_mix(spark, documents):
    got = ran(spark, "op1_mix_sources")
    sizes = {r["doc_id"]: len(words(r["text"])) for r in documents}
    assert {r["doc_id"]: r["size"] for r in got} == sizes and len(got) == len(documents)
    source = {r["doc_id"]: r["source"] for r in documents}
    total, taken, target = Counter(), Counter(), {}
    for i, n in sizes.items():
        total[source[i]] += n
    for r in got:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert r["source_size"] == total[s] and 0 <= r["taken"] <= 2 * r["size"]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(total, key=lambda s: (s is None, s or "")))}
    capped, level = set(), 0.0
    while True:
        open_ = [s for s in total if s not in capped]
        if not open_:
            break
        level = (1.5 * sum(total.values()) - sum(2 * total[s] for s in capped)) / sum(weight[s] for s in open_)
        more = {s for s in open_ if level * weight[s] >= 2 * total[s]}
        if not more:
            break
        capped |= more
    for s in total:
        want = 2 * total[s] if s in capped else level * weight[s]
        assert abs(target[s] - want) <= 1e-6 * want and abs(taken[s] - want) <= 1
    assert sorted(map(tuple, ran(spark, "op1_mix_sources"))) == sorted(map(tuple, got))


def test_forest(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    known = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in rows if r["embedding"] is not None and None not in r["embedding"]}
    known = {i: v for i, v in known.items() if np.isfinite(v).all() and v.any()}
    got = defaultdict(list)
    for r in ran(spark, "op3_hash_prefix_forest"):
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    ids, x = np.array(sorted(known)), np.array([known[i] for i in sorted(known)])
    hit = total = 0
    assert sorted(got) == [i for i in ids.tolist() if i % 20 == 0]
    for q, found in got.items():
        score = np.zeros(len(ids))
        for k in range(x.shape[1]):
            score += known[q][k] * x[:, k]
        exact = dict(zip(ids.tolist(), score.tolist(), strict=True))
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21)) and all(exact[i] == s for _, i, s in found)
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        best = sorted((-s, i) for i, s in exact.items() if i != q)[:20]
        hit += len({i for _, i in best} & {i for _, i, _ in found})
        total += 20
    assert hit / total >= 0.9


def test_simhash(spark, documents):
    want = {}
    for r in documents:
        w = [x.lower() for x in words(r["text"])]
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
        want[r["doc_id"]] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in ran(spark, "op4_golay_simhash")}
    assert {i: f for i, (f, _) in got.items()} == {i: f"{p:016x}" for i, p in want.items()}
    left, name = sorted(want), {}
    while left:
        group, todo = {left[0]}, [left[0]]
        while todo:
            at = todo.pop()
            near = [i for i in left if i not in group and (want[i] ^ want[at]).bit_count() <= 2]
            group |= set(near)
            todo += near
        name |= dict.fromkeys(group, min(group))
        left = [i for i in left if i not in group]
    assert {i: c for i, (_, c) in got.items()} == name


def test_toxicity(spark, documents):
    got = ran(spark, "op5_pu_toxicity")
    assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in documents)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [r for r in got if r["held_out"] and labels.get(r["doc_id"]) == 0]
    assert sum(r["predicted"] for r in clean) <= 0.05 * len(clean)


def test_packing(spark, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in ran(spark, "op8_harmonic_packing"):
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert len(pieces) == len(documents)
    for d in documents:
        ids = np.array([*tok.encode(d["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces[d["doc_id"]], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and zlib.crc32(ids[at : at + r["length"]].tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    used = padded = 0
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 2048
        used += at
        padded += 0 if at & (at - 1) == 0 else 2048 - at
    assert padded < 0.05 * used


def test_repeats(spark, documents):
    texts = [(r["doc_id"], (r["text"] or "").encode()) for r in documents]
    seen = Counter(hash(b[i : i + 200]) for _, b in texts for i in range(len(b) - 199))
    want = []
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        for at in range(len(b) - 199):
            if seen[hash(b[at : at + 200])] > 1:
                gone[at : at + 200] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        want.append((i, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    assert sorted(map(tuple, ran(spark, "op9_column_suffixes"))) == sorted(want)
