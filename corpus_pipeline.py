"""From raw documents to packed sequences: each stage takes what its predecessor kept.

Toxic documents go; one document of each near-duplicate group stays; repeated passages go; sources are
mixed to their targets; what is left is packed. All but the last stage return the columns of documents, whatever
further columns there are and whatever they are called. An empty table passes through all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from readtrack.llm import op1_mix, op4_simhash, op5_toxic, op8_pack, op9_suffix
from readtrack.llm.common import Scratch, ended_after, small_batches, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold by the classifier learnt from the training rows' labels.

    Each row is judged by its text alone: repeated rows fare alike, ties of ids don't matter, null and empty texts
    have no feature and stay, very long texts are scored whole. Rows without an id are judged like others and not learnt from. Without
    a confirmed toxic document every row stays.
    """
    small_batches(spark)
    return op5_toxic.without_toxic(docs, op5_toxic.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents but those to which one that stays is near: whole texts of five-word shingles, similarity 0.8 and more.

    Ids decide in ascending order, rows without an id come last, and of one id's texts that of the least hash is first. Null and empty texts
    are copies of one another. A repeated row stays once (of rows alike in id and text that of the least hash of all columns); an
    id's other texts are documents of their own. Very long texts count whole.
    """
    small_batches(spark)
    return op4_simhash.one_of_each(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of 200-byte strings that repeat, in another document or the same; every row stays, n_chars follows its text.

    Null texts stay null, empty ones empty. Repeated rows repeat each other's bytes and lose them all; ids, equal or null, don't matter. Very
    long texts are judged whole.
    """
    small_batches(spark)
    return op9_suffix.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy that the mix takes, as a row; of one document a source, the leading words alone.

    Null and empty texts have no words and are copied as often as their source's share rounds to. A null source is a source, a null id an ordinary one; repeated rows take the same
    number of copies each. Ties are drawn by a seeded hash, so reruns agree. Very long texts are taken whole like others.
    """
    small_batches(spark)
    return op1_mix.mixed_rows(docs, op1_mix.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences: each row's ids lie in exactly one piece each.

    Null and empty texts give their end id alone. Repeated rows and null or equal ids are documents of their own; long ones are cut.
    """
    small_batches(spark)
    return op8_pack.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", drop_repeats),
    ("mix_sources", mix_sources),
    ("harmonic_packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's output is written; then what the stage kept for itself and its predecessor's output go."""
    scratch = Scratch(spark)
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with ended_after():
            docs = scratch.keep(stage(spark, docs, sf_dir), name)
        scratch.drop(*before)
        before = [name]
    return STAGES[-1][1](spark, docs, sf_dir)
