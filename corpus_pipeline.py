"""From raw documents to token ids: one operator after the other over the whole corpus.

Each stage takes (spark, docs, sf_dir), keeps the columns of ``documents`` and works on
all rows that its predecessor kept. Between stages the rows are written as Parquet to
the shared folder and read again, so a lost executor costs one stage's tasks.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparksales.llm import byte_bpe, phrase_index, quality, recompression, simhash
from sparksales.llm.queries import VOCABULARY, remainder
from sparksales.llm.tables import table
from sparksales.operators.staging import hadoop_path, new_folder, staging_scope

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    labels = table(spark, sf_dir, "labels")
    return quality.accepted(docs, labels, learn=remainder(5) != 0).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs, words_each=4, distance=4).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 20 words and more that stand earlier.

    A text that loses words keeps the others, joined by single spaces; any other text
    stays as it is. A document that loses all its words stays with an empty text.
    """
    found = recompression.remove_repeats(docs, window=20, keep=COLUMNS)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text").cast("string")).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_removed") > 0, F.char_length(text)).otherwise(F.col("n_chars"))
    return found.select("doc_id", text.alias("text"), "lang", "source", n_chars.cast("bigint").alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a phrase of the benchmark."""
    return phrase_index.clean(docs, table(spark, sf_dir, "benchmark"), size=10).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding them."""
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    ids = byte_bpe.encode(docs, path, pattern, keep=("doc_id", "lang", "source"), decoded="decoded")
    return ids.select(
        "doc_id",
        "lang",
        "source",
        "token_ids",
        (F.octet_length("token_ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", quality_filter),
    ("near-duplicates", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", encode),
]

# Scores, fingerprints and token ids cannot be expressed in SQL; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of what the stages keep of ``documents``; only the last stage's input stays staged."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, apply in STAGES[:-1]:
        written = new_folder(spark)
        # What a stage stages for itself goes when its rows are written, and so does its input.
        with staging_scope(spark):
            apply(spark, docs, sf_dir).write.parquet(written)
        if before is not None:
            fs, folder = hadoop_path(spark, before)
            fs.delete(folder, True)
        docs, before = spark.read.parquet(written), written
    return STAGES[-1][1](spark, docs, sf_dir)
