"""Preparing a corpus for training: toxic documents go, one of each group of near
copies stays, repeated passages are cut out, and the rest is packed.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import packing, simhash_similar, suffix_dedup
from corvane.llm import toxicity as tox
from corvane.llm.common import remove_path, shared_path, small_batches

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: One application runs all stages, so each leaves room for what the others hold: rows that travel to Python at a time, and bytes of words that packing remembers.
BATCH, MEMORY = 1000, 24 << 20


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by a machine fitted to the labels of documents that aren't held out.

    Null and empty texts have the score of a text without words; a null id, language or source is kept as it is; repeated
    rows score alike and all stay or go; a score of exactly the threshold goes; a text of any length is scored whole; other
    columns than those of ``documents`` are left out; an empty table gives an empty result.
    """
    small_batches(spark, BATCH)
    docs = docs.select(*COLUMNS)
    machine = tox.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return tox.score(docs, machine, keep=COLUMNS).filter(F.col("score") < tox.THRESHOLD).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies: SimHash signatures of five-word shingles, similarity 0.8 or more.

    Texts without words, null ones too, are one group; rows that repeat id and text are kept once; a row without an id stays
    unless it is a near copy of one with an id; texts of any length are compared whole; other columns than those of
    ``documents`` are left out; an empty table gives an empty result.
    """
    small_batches(spark, BATCH)
    return simhash_similar.deduplicate(docs.select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 50 bytes that a document with a smaller id holds too; a character that loses a byte goes whole.

    Null texts become empty; rows that share an id don't take from one another; a row without an id counts as the last; a
    document stays even if nothing is left of its text; ``n_chars`` is counted anew; other columns than those of
    ``documents`` are left out; an empty table gives an empty result.
    """
    small_batches(spark, BATCH)
    out = suffix_dedup.remove_repeats(docs.select(*COLUMNS), keep=("lang", "source"), as_text=True)
    return out.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length with their ids.

    A null or empty text is a piece of the end id alone; repeated rows and rows without an id are packed each for itself;
    texts of any length are split whole; an empty table gives an empty result.
    """
    small_batches(spark, BATCH)
    return packing.pack(docs, memory=MEMORY)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("packing", pack)]

#: No stage is expressible in SQL; tests/llm/test_pipeline.py holds each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written to the shared folder, read again, and removed when the next is written."""
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if read is not None:
            remove_path(spark, read)
        docs, read = spark.read.parquet(path), path
    return docs
