"""The pipeline's stages on planted documents."""

import random

import corpus_pipeline
from readtrack.llm import registry


def words(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(3, 9))) for _ in range(n))


def test_stages(spark, tmp_path):
    passage = words(60, 10**6)
    rows = [(i, words(80, i), "en", f"s{i % 3}") for i in range(300)]
    rows += [(1000 + i, " ".join(("vilename rotter scumbag " if k % 20 == 0 else "") + w for k, w in enumerate(words(80, 5000 + i).split())), "en", "s0") for i in range(60)]
    copy = rows[5][1].split()
    rows += [(2000, rows[5][1], "en", "s1"), (2001, " ".join([*copy[:40], "other", *copy[41:]]), "en", "s1"), (2002, words(50, 9001) + " " + passage, "en", "s2"), (2003, passage + " " + words(50, 9002), "en", "s2"), (2004, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(*r, r[1] and len(r[1])) for r in rows], schema).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(r[0], 0, int(1000 <= r[0] < 1060)) for r in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"stage{k}"))
        out = spark.read.parquet(str(tmp_path / f"stage{k}"))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            seen[name] = {r["doc_id"]: r["text"] for r in out.collect()}
        docs = out
    clean = set(range(300))
    assert clean <= set(seen["toxicity"]) and len([i for i in seen["toxicity"] if 1000 <= i < 1060]) <= 3
    assert clean <= set(seen["simhash_near_dedup"]) and not {2000, 2001} & set(seen["simhash_near_dedup"])
    left = seen["suffix_array_dedup"]
    assert set(left) == set(seen["simhash_near_dedup"]) and passage[5:-5] not in left[2002] + left[2003] and all(left[i] == rows[i][1] for i in range(300))
    assert set(seen["mix_sources"]) <= set(left)
    assert docs.where("length <= 0 or offset < 0").count() == 0 and docs.count() > 0


EXTRA = "row_id int, spans string, u_doc int, K1 int, stay_hash string, row string, u_words int, least int, s1 int"


def through(spark, tmp_path, rows, labels):
    """What each stage keeps of rows (doc_id, text, lang, source) with further columns."""
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
    spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), 1, "x", 2, 3, "y", "z", 4, 5, 6) for r in rows], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, out = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        kept = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert kept.dtypes == docs.dtypes
        kept.write.parquet(str(tmp_path / f"stage{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{k}"))
        out.append(docs.collect())
    return out


def test_odd_rows(spark, tmp_path):
    long_, passage = words(20_000, 3), words(60, 4)
    rows = [(1, None, None, None), (2, "", "en", "a"), (None, words(50, 5), "en", "a"), (None, words(50, 6), None, "b"), (3, long_, "en", "a"), (4, words(80, 7), "en", "b")]
    rows += [(4, words(80, 7), "en", "b"), (4, words(80, 8), "en", "b"), (5, f"{words(30, 9)} {passage}", "en", "a"), (6, f"{passage} {words(30, 10)}", "en", None), (7, " \n ", "en", "a")]
    toxic, single, unrepeated, mixed, packed = through(spark, tmp_path, rows, [(4, 1, 0)])
    ids = lambda found: sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in found)
    assert ids(toxic) == sorted([-1, -1, 1, 2, 3, 4, 4, 4, 5, 6, 7])  # nothing is known to be toxic
    assert ids(single) == [-1, -1, 1, 3, 4, 4, 5, 6]  # no words: one of 1, 2 and 7; the repeated row once, the id's other text too
    assert ids(unrepeated) == ids(single) and {r["text"] for r in unrepeated if r["doc_id"] == 3} == {long_}
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in unrepeated) and not [r for r in unrepeated if passage[1:-1] in (r["text"] or "")]
    assert {3, 4, 5, 6} & set(ids(mixed)) and set(ids(mixed)) <= set(ids(single))
    assert set(ids(packed)) == set(ids(mixed))


def test_empty_tables(spark, tmp_path):
    assert through(spark, tmp_path, [], []) == [[]] * 5


def test_names():
    assert sorted(registry.oracle_sql()) and set(registry.oracle_sql()) <= set(registry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries()) == list(range(1, 14))
