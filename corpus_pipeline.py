"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

1. toxicity: rejected documents go;
2. near_duplicates: one document of each class of the Jaccard join stays;
3. suffix_dedup: byte strings of 50 or more that an earlier document has are cut out of the texts;
4. decontamination: documents that share ten words in a row with the benchmark go;
5. packing: the rest is packed into sequences of 2048 tokens; its rows are the pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry_analytics.llm import decontaminate, near_dup, packing, suffix_dedup, toxicity
from registry_analytics.llm.queries import table, tokenizer_path
from registry_analytics.session import new_work_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Rows of whole texts that pass to a Python worker at a time. Each stage sets it in the session and leaves it
#: there, since its frame may be written by the caller: Spark's 10,000 rows of long texts are over 60 MB in the
#: JVM and again in the worker.
BATCH_ROWS = 1000
#: Bytes of rows that pass at a time, if fewer: compressed records of a bucket are 50 KB a row.
BATCH_BYTES = 8_000_000


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return near_dup.keep_one(docs).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    kept = suffix_dedup.remove_repeats(docs, carry=("lang", "source"), decode=True)
    return kept.select("doc_id", F.col("kept").alias("text"), "row.lang", "row.source", F.length("kept").cast("long").alias("n_chars"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    pieces = packing.pack(docs, tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: SQL expresses neither the lexicon nor the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents`` and return the last one's rows."""
    folder = new_work_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
