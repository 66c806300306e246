"""Queries in SQL alone, files through a data source, and a stream in several runs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..catalog import name_of
from ..functions import sql
from ..operators import progress
from ..plans import reading_plan
from ..sources import conll, files, store
from ..sources.shared import kept, new_folder
from ..streaming import ingest
from .domain import SPELT, messages, plan
from .learning import ambiguous
from .reading import SQL as READING
from .reading import refs, ups
from .texts import SPANS


def view(df):
    name = f"readtrack_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    return name


def sql_read_refs(s, d):
    """What every message refers to, by functions in SQL."""
    sql.register(s)
    return s.sql(f"SELECT m.seq, r.book_start, r.start_chapter, r.book_end, r.end_chapter FROM (SELECT seq, span_tokens(clean_text(message)) AS spelt FROM {view(messages(s, d))}) m, LATERAL read_refs(m.spelt) r")


def sql_fill_gaps(s, d):
    """Every member's gaps filled, by a table function in SQL."""
    sql.register(s)
    return s.sql(f"SELECT sender, seq, start_chapter, end_chapter, filled FROM fill_gaps(TABLE({view(ups(s, d))}) PARTITION BY sender ORDER BY (seq, ord))")


def conll_files(s, d):
    """Tagged messages written as CoNLL files and read back in ranges: each sentence with its number."""
    conll.register(s)
    folder = new_folder(s, "conll")
    ambiguous(s, d).select("tokens", F.col("gold").alias("tags")).write.format("conll").mode("append").save(folder)
    read = s.read.format("conll").option("range", 1 << 20).load(folder)
    return read.groupBy(F.array_join("tokens", " ").alias("said"), F.array_join("tags", " ").alias("tags")).agg(F.count("*").alias("n"))


def stream_fill_gaps(s, d, waves: int = 3):
    """Members' gaps filled as messages arrive: in waves by time, each a run of one streaming query that goes on where the last one ended."""
    folder = new_folder(s, "stream")
    r = progress.new_messages(refs(s, d))
    edges = [x for x in r.agg(F.percentile_approx("timestamp", [i / waves for i in range(1, waves)], 1000).cast("array<string>").alias("e")).first()["e"] or []]
    wave = F.size(F.filter(F.array(*[F.lit(e).cast("timestamp_ntz") for e in edges]), lambda e: e <= F.col("timestamp"))) if edges else F.lit(0)
    placed = r.withColumn("seq", F.unix_micros(F.col("timestamp").cast("timestamp"))).withColumn("wave", wave)
    before = {k: s.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass")}
    s.conf.set("spark.sql.shuffle.partitions", str(min(int(s.conf.get("spark.sql.shuffle.partitions")), 2 * s.sparkContext.defaultParallelism)))
    s.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for w in range(len(edges) + 1):
            placed.where(F.col("wave") == w).drop("wave").write.mode("append").parquet(f"{folder}/in")
            rows = s.readStream.schema(placed.drop("wave").schema).parquet(f"{folder}/in")
            out = ingest.stream_persist(ingest.resume_once(rows, "7 days"))
            out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            s.conf.set(k, v) if v is not None else s.conf.unset(k)
    return s.read.schema(ingest.PERSISTED).parquet(f"{folder}/out").select("sender", "timestamp", "start_id", "start_chapter", "end_chapter", "is_valid", "filled")


def plan_file(s, d):
    """The plan written as CSV and read back, its chapters expanded."""
    folder = new_folder(s, "plan")
    files.write_csv(plan(s, d).select("day", F.col("date").cast("string").alias("date"), "book_start", "start_chapter", "book_end", "end_chapter", "emoji"), folder)
    return reading_plan.expand_plan(files.read_plan(s, folder)).select("date", "day", "book_id", "book_name", "chapter")


def labelled_files(s, d):
    """All messages written as labelled CSV, with quotes and line ends in them, and read back: messages and reports by day."""
    folder = new_folder(s, "labelled")
    m = messages(s, d)
    label = F.when(F.col("seq") % 4 == 0, F.lit(" Report ")).when(F.col("seq") % 4 == 1, F.lit("chat")).otherwise(F.lit("REPORT"))
    said = F.concat(F.lit('"'), "message", F.lit('",\n'), F.col("seq"))
    files.write_csv(m.select(F.date_trunc("SECOND", "timestamp").cast("string").alias("timestamp"), "sender", said.alias("message"), label.alias("category")), folder, mark=False)
    got = files.read_labelled(s, folder)
    return got.groupBy(F.to_date("timestamp").alias("day")).agg(F.count("*").alias("n"), F.count_if("is_report").alias("reports"), F.sum(F.length("message")).alias("chars"))


def pool_files(s, d):
    """Messages in a folder for each kind, of which some are read alone."""
    folder = new_folder(s, "pools")
    m = messages(s, d).select("seq", F.concat(F.lit("b"), F.col("book_id") % 5).alias("pool"))
    files.write_pools(m, folder, "pool")
    return files.read_pools(s, folder, "pool", ["b1", "b3"]).select("seq", "pool")


def stored_batches(s, d):
    """Progress kept in tables in two batches, the second with messages of the first once more: as the table then has it."""
    name = f"readtrack_{uuid.uuid4().hex}"
    s.sql(f"CREATE DATABASE {name} LOCATION '{new_folder(s, 'store')}'")
    store.create_tables(s, name)
    m = messages(s, d).select("seq", "sender", "timestamp", "message")
    r = kept(progress.persist(refs(s, d)), "persisted").withColumns({"book_start": name_of(F.col("start_id")), "book_end": name_of(F.col("end_id"))})
    half = m.agg(F.percentile_approx("seq", 0.5)).first()[0] or 0
    for part in (F.col("seq") <= half, F.lit(True)):
        store.store_batch(name, m.where(part), r.where(part))
    return store.stored(s, name, "reading_progress").select("sender", "book_id", "chapter", "date_read")


QUERIES = {"plan_file": plan_file, "labelled_files": labelled_files, "pool_files": pool_files, "stored_batches": stored_batches, "sql_read_refs": sql_read_refs, "sql_fill_gaps": sql_fill_gaps, "conll_files": conll_files, "stream_fill_gaps": stream_fill_gaps}

SQL = {
    "sql_read_refs": f"{SPANS} SELECT seq, {SPELT} AS book_start, first AS start_chapter, CAST(NULL AS VARCHAR) AS book_end, CASE WHEN last > first THEN last END AS end_chapter FROM msgs",
    "sql_fill_gaps": READING["gap_fill"],
}
