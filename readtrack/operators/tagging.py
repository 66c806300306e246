"""Token tags: spans from BIO tags, offsets, features, and what a tagger gets wrong."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.patterns import is_noisy, shape_of
from ..functions.text import shape
from .grammar import parse_refs


def bio_spans(tokens: Column, tags: Column) -> Column:
    """array<struct<first,last,text>> of token indexes: B opens a span, so does I without one before; O closes."""
    inside = lambda i: F.coalesce(F.get(tags, i) != "O", F.lit(False)) & (i >= 0)
    starts = F.filter(F.sequence(F.lit(0), F.size(tokens) - 1), lambda i: inside(i) & (F.startswith(F.get(tags, i), F.lit("B-")) | ~inside(i - 1)))
    ends = F.filter(F.sequence(F.lit(0), F.size(tokens) - 1), lambda i: inside(i) & (~inside(i + 1) | F.startswith(F.coalesce(F.get(tags, i + 1), F.lit("O")), F.lit("B-"))))
    pairs = F.arrays_zip(starts.alias("first"), ends.alias("last"))
    return F.when(F.size(tokens) > 0, F.transform(pairs, lambda p: F.struct(p["first"].alias("first"), p["last"].alias("last"), F.array_join(F.slice(tokens, p["first"] + 1, p["last"] - p["first"] + 1), " ").alias("text"))))


def token_offsets(tokens: Column) -> Column:
    """Start of each token where single spaces part them."""
    step = lambda acc, t: F.struct((acc["at"] + F.length(t) + 1).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
    return F.aggregate(tokens, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), step)["out"]


def char_spans(tokens: Column, tags: Column) -> Column:
    """array<struct<start,end,label,text>> in characters of the text joined by single spaces."""
    at = token_offsets(tokens)
    return F.transform(
        bio_spans(tokens, tags),
        lambda s: F.struct(F.get(at, s["first"]).alias("start"), (F.get(at, s["last"]) + F.length(F.get(tokens, s["last"]))).alias("end"), F.lit("BIBLE_REF").alias("label"), s["text"].alias("text")),
    )


def structures(tokens: Column, tags: Column) -> Column:
    """Raw references of a sentence's spans; spans that parse to nothing give their first token as a book."""
    texts = F.transform(bio_spans(tokens, tags), lambda s: s["text"])
    parsed = parse_refs(texts)
    bare = F.transform(texts, lambda t: F.struct(F.get(F.split(t, " "), F.lit(0)).alias("book_start"), F.lit(None).cast("int").alias("start_chapter"), F.lit(None).cast("string").alias("book_end"), F.lit(None).cast("int").alias("end_chapter")))
    return F.when(F.size(parsed) > 0, parsed).otherwise(bare)


def token_features(sentences: DataFrame, *keys: str) -> DataFrame:
    """A row a token: its shape and its neighbours' (null at the ends)."""
    t = sentences.select(*keys, F.posexplode("tokens").alias("pos", "token"))
    w = Window.partitionBy(*keys).orderBy("pos")
    near = lambda c: F.struct(F.lower(c).alias("lower"), c.rlike(r"^\d+$").alias("is_digit"), c.rlike(r"^\p{Lu}\p{Ll}*$").alias("is_title"))
    before, after = F.lag("token").over(w), F.lead("token").over(w)
    return t.select("*", before.alias("before"), after.alias("after")).select(
        *keys, "pos", "token", shape(F.col("token")).alias("shape"), near(F.col("before")).alias("prev"), near(F.col("after")).alias("next"),
        F.col("before").isNull().alias("bos"), F.col("after").isNull().alias("eos"),
    )


def seed_similarity(tokens: DataFrame, vectors: DataFrame, seeds: list[str]) -> DataFrame:
    """word, similarity: mean cosine of each word's vector (word, vector) with the seeds', to 2 places; 0 where unknown."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    norm = lambda a: F.sqrt(dot(a, a))
    s = F.broadcast(vectors.where(F.col("word").isin(seeds)).select(F.collect_list("vector").alias("seeds")))
    known = vectors.join(s, F.size("seeds") >= 0)
    mean = F.aggregate(F.transform("seeds", lambda v: dot(F.col("vector"), v) / (norm(F.col("vector")) * norm(v))), F.lit(0.0), lambda a, x: a + x) / F.size("seeds")
    sims = known.select("word", F.round(mean, 2).alias("similarity"))
    return tokens.select("word").distinct().join(sims, "word", "left").fillna({"similarity": 0.0})


def pattern_of_tags(text: Column, tokens: Column, tags: Column) -> Column:
    """The message class by tagged spans."""
    texts = F.transform(bio_spans(tokens, tags), lambda s: s["text"])
    n = F.coalesce(F.size(texts), F.lit(0))
    return F.when(is_noisy(text), "noisy").when(n <= 0, "none").when(n >= 2, "multi").otherwise(shape_of(F.get(texts, F.lit(0))))


def token_confusion(sentences: DataFrame, gold: str, pred: str, *by: str) -> DataFrame:
    """By pattern: total, correct, accuracy, false positives, false negatives, wrong tags."""
    t = sentences.select(*by, F.explode(F.arrays_zip(F.col(gold).alias("g"), F.col(pred).alias("p"))).alias("z")).select(*by, "z.g", "z.p")
    g, p = F.col("g"), F.col("p")
    return t.groupBy(*by).agg(
        F.count("*").alias("total"), F.count_if(g == p).alias("correct"), F.round(F.avg((g == p).cast("int")), 4).alias("accuracy"),
        F.count_if((g == "O") & (p != "O")).alias("false_pos"), F.count_if((g != "O") & (p == "O")).alias("false_neg"),
        F.count_if((g != "O") & (p != "O") & (g != p)).alias("wrong_tag"),
    )


def tag_messages(messages: DataFrame, text: str, make_tagger: Callable[[], Callable[[list[str]], list[list[dict]]]], batch: int = 32) -> DataFrame:
    """Adds hits (entity_group, word, score, start, end) of a token tagger. make_tagger loads it once a worker; it gets `batch` texts at a time."""
    from pyspark.sql.types import ArrayType, StructField, StructType, _parse_datatype_string

    hit = _parse_datatype_string("entity_group string, word string, score double, start int, end int")
    schema = StructType([*messages.schema.fields, StructField("hits", ArrayType(hit))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = make_tagger()
        for frame in frames:
            texts = frame[text].tolist()
            frame["hits"] = [h for i in range(0, len(texts), batch) for h in tagger(texts[i : i + batch])]
            yield frame

    return messages.mapInPandas(run, schema)


def train_vectors(sentences: DataFrame, size: int = 50, window: int = 3, passes: int = 100, seed: int = 42) -> DataFrame:
    """(word, vector) learnt from the sentences' lower-case tokens."""
    from pyspark.ml.feature import Word2Vec
    from pyspark.ml.functions import vector_to_array

    lower = sentences.select(F.transform("tokens", lambda t: F.lower(t)).alias("tokens"))
    model = Word2Vec(vectorSize=size, windowSize=window, minCount=1, maxIter=passes, seed=seed, inputCol="tokens", outputCol="v").fit(lower)
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))
