"""Cleaning a corpus: toxic documents, near copies, repeated passages and benchmark text go; the rest is packed.

Each stage takes (session, documents, folder of tables) and returns a table that the next one gets.  An
empty table passes all stages; nulls are allowed in any column.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lamella.llm.decontaminate import remove_benchmark
from lamella.llm.entry import tokenizer_path
from lamella.llm.jaccard_join import removed_copies
from lamella.llm.packing import pack
from lamella.llm.storage import shared_folder
from lamella.llm.suffix_dedup import remove_repeats
from lamella.llm.toxicity import score_toxicity, training_rows

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs``, with their text hash th, whose id (null too) and text aren't in (doc_id, th)."""
    hashed = docs.withColumn("th", F.xxhash64("text"))
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("th").alias("gone_th"))
    return hashed.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("th") == F.col("gone_th")), "left_anti")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.3 or more go.  Rows of one id and text have one score; other texts of the id have their own."""
    scores = score_toxicity(docs, training_rows(spark.read.parquet(f"{sf_dir}/labels.parquet")), text_hash=True)
    return _without(docs, scores.where("score >= 0.3").select("doc_id", "th").distinct()).select(COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of smallest doc_id of each group of near copies stays, once if it repeats; a null id is the largest."""
    return _without(docs, removed_copies(docs)).dropDuplicates(["doc_id", "th"]).select(COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut; a character that is cut in part goes as a whole.  Null texts stay, repeated long rows are emptied."""
    out = remove_repeats(docs.select(COLUMNS), characters=True)
    text = F.when(F.size("spans") == 0, F.col("text")).otherwise(F.col("kept").cast("string"))
    return out.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts until none is left.  Null texts and repeated rows stay."""
    clean = remove_benchmark(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, with their token ids, in sequences of 2048 tokens, neighbours being similar.  Null texts are empty ones."""
    return pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("near_copies", near_copies), ("repeats", repeats), ("benchmark", benchmark), ("packing", packing)]

#: Trees, hashes and a tokenizer aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
