"""Readers and writers of the other files: catalogue, plan, labelled messages, CoNLL, gold items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PLAN = "day int, date string, book_start string, start_chapter int, book_end string, end_chapter int, emoji string"
GOLD = (
    "text string, spans array<struct<start:int,end:int,label:string,text:string>>, "
    "structures array<struct<book_start:string,start_chapter:int,book_end:string,end_chapter:int>>, "
    "norms array<struct<book_start:string,start_chapter:int,book_end:string,end_chapter:int>>"
)
CATALOG = "books array<struct<id:int,name:string,aliases:array<string>,testament:string,chapters:int>>"


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """One row a book of a catalogue in JSON; a missing file is an error."""
    return spark.read.schema(CATALOG).json(path, multiLine=True).select(F.explode("books").alias("b")).select(
        F.col("b.id").alias("book_id"), "b.name", "b.aliases", "b.testament", "b.chapters"
    )


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """The reading plan with row_no, the order of rows within their file."""
    raw = spark.read.schema(PLAN).csv(path, header=True)
    return raw.withColumn("date", F.try_to_date("date")).withColumn("row_no", F.monotonically_increasing_id())


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """timestamp, sender, message, is_report."""
    raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    return raw.select(F.try_to_timestamp("timestamp").cast("timestamp_ntz").alias("timestamp"), "sender", "message", (F.lower(F.trim("category")) == "report").alias("is_report"))


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(GOLD).json(path, multiLine=True)


def conll_sentences(files: DataFrame) -> DataFrame:
    """(file, content) -> file, sent, tokens, tags, text: blank lines end sentences, -DOCSTART- lines don't count."""
    lines = files.select("file", F.posexplode(F.split("content", "\n")).alias("pos", "raw")).withColumn("line", F.trim("raw"))
    lines = lines.where(~F.col("line").startswith("-DOCSTART-"))
    sent = F.sum((F.col("line") == "").cast("int")).over(Window.partitionBy("file").orderBy("pos"))
    words = lines.withColumn("sent", sent).where("line <> ''").withColumn("f", F.split("line", r"\s+"))
    rows = F.array_sort(F.collect_list(F.struct("pos", F.get("f", F.lit(0)).alias("token"), F.get("f", F.size("f") - 1).alias("tag"))))
    return words.groupBy("file", "sent").agg(rows.alias("r")).select("file", "sent", F.col("r.token").alias("tokens"), F.col("r.tag").alias("tags"), F.array_join("r.token", " ").alias("text"))


def read_conll(spark: SparkSession, path: str) -> DataFrame:
    return conll_sentences(spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("content")))


def write_pools(df: DataFrame, path: str, pool: str) -> None:
    """Rows in a folder for each pool, so that one pool is read alone."""
    df.write.mode("overwrite").partitionBy(pool).parquet(path)


def read_pools(spark: SparkSession, path: str, pool: str, names: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if names is None else df.where(F.col(pool).isin(names))


def write_csv(df: DataFrame, path: str, *by: str, mark: bool = True) -> None:
    """CSV with a header, quotes doubled; with a byte-order mark ahead of it, for spreadsheets."""
    first = next(c for c in df.columns if c not in by)
    named = df.withColumnRenamed(first, f"\ufeff{first}") if mark else df
    w = named.write.option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "")
    (w.partitionBy(*by) if by else w).csv(path)
